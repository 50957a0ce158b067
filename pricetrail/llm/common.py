"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.session import scratch_dir

# Words are separated by the ASCII white space of the contracts and by nothing else.
WORD_GAP = r"[\x20\x09-\x0D]+"

# Bytes that Arrow hands to a Python worker at a time; one longer row still goes whole.
BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the cluster's shared folder and read back.

    It cuts lineage in a place that survives lost executors, gives the next plan true sizes,
    and makes what is nondeterministic (partition numbers) final.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by_batches(df: DataFrame, label: str) -> DataFrame:
    """``stored`` for a plan that gives whole texts to Python, in batches of about ``BATCH_BYTES``.

    A batch lies in the JVM and in its worker at once, and an executor's JVM keeps most of what
    its batches took beside the heap.  The session's own limit holds again afterwards.
    """
    conf = df.sparkSession.conf
    before = conf.get(BATCH_SETTING, None)
    conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        return stored(df, label)
    finally:
        if before is None:
            conf.unset(BATCH_SETTING)
        else:
            conf.set(BATCH_SETTING, before)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1), lambda w: w != "")


def shingles_of(words: Column, width: int) -> Column:
    """All runs of ``width`` words, joined by one space, repeats included."""
    last = F.size(words) - F.lit(width - 1)
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(width))))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<string>"))


def held_out(doc_id: Column) -> Column:
    """The test fold of the classifiers: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def text_slices(texts: pd.Series, max_bytes: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts as UTF-8, each of about ``max_bytes`` or of one longer text."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if run and size + len(data) > max_bytes:
            yield first, run
            first, size, run = i, 0, []
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def text_runs(texts: Iterable[str | None], max_chars: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts, each of about ``max_chars`` or of one longer text, with the place of the first; null is empty."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        text = text or ""
        if run and size + len(text) > max_chars:
            yield first, run
            first, size, run = i, 0, []
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def arrow_runs(texts: pa.Array, max_chars: int, rows: int = 256) -> Iterator[tuple[int, list[str]]]:
    """``text_runs`` of an Arrow column, of which ``rows`` at a time become strings, so a batch is never held twice."""
    for low in range(0, len(texts), rows):
        for first, run in text_runs(texts.slice(low, rows).to_pylist(), max_chars):
            yield low + first, run


def give_back() -> None:
    """Return freed memory to the system: an idle Python worker lies beside all stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def components(edges: DataFrame, label: str) -> DataFrame:
    """The smallest node id that each linked node can reach.

    ``edges`` has long columns ``a`` and ``b``; the result has ``node`` and ``component`` for
    every node of an edge.  Each round takes the smallest label of the neighbours, then the
    label of that label, so long chains halve.  Labels are stored between rounds; hubs are
    split, because every join has plain exchanges on both sides.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{label}-edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), f"{label}-0"
    )
    turn = 0
    while True:
        turn += 1
        told = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "component")
        best = labels.select("node", "component", F.col("component").alias("was")).unionByName(
            told.withColumn("was", F.lit(None).cast("long"))
        )
        best = best.groupBy("node").agg(F.min("component").alias("component"), F.min("was").alias("was"))
        best = stored(best, f"{label}-{turn}a")
        if best.filter(F.col("component") != F.col("was")).isEmpty():
            return best.select("node", "component")
        up = best.select(F.col("node").alias("component"), F.col("component").alias("upper"))
        jumped = best.join(up, "component").select("node", F.col("upper").alias("component"))
        labels = stored(jumped, f"{label}-{turn}b")


def crc32_fold(doc_id) -> int:
    """``held_out`` for one id, for tests."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))
