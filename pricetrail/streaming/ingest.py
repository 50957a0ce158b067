"""Continuous loads from a stage.

Spark's checkpoint remembers the files already read.  Late or repeated data needs no
watermark: the target table is the state, and both merges are idempotent.  With
``available_now`` the same query is the scheduled load: it takes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pricetrail.operators.conform import split_rejects
from pricetrail.operators.merge import PRICE_KEY
from pricetrail.plans.loads import merge_files, merge_item_rows
from pricetrail.plans.maintained import Maintained
from pricetrail.schemas import PRICES
from pricetrail.sources.landing import Stage, path_exists, written_by_stream
from pricetrail.sources.ledger import known_files, listed_files, read_ledger, record_files
from pricetrail.sources.versions import VersionedTable


MAX_FILES = 1000


def read_arrivals(spark: SparkSession, stage: Stage, max_files: int | None = MAX_FILES) -> DataFrame:
    """Files of a stage as they arrive; ``max_files`` bounds one batch of a long backlog."""
    reader = spark.readStream.format(stage.fmt).schema(stage.schema).options(**stage.options())
    reader = reader.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(stage.path)


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append_stream(
    spark: SparkSession, stage: Stage, sink: str, checkpoint: str,
    available_now: bool = True, max_files: int | None = MAX_FILES,
) -> StreamingQuery:
    """Plain load into a table of its own: every clean row of every new file, once.

    Readers of such a table see what this stream wrote and nothing else, so a table that
    other loads write is refused; those share ``merge_stream`` and ``load_prices``.
    """
    if path_exists(spark, sink) and not written_by_stream(spark, sink):
        raise ValueError(f"{sink} has other writers; load it by merge_stream")
    clean, _ = split_rejects(read_arrivals(spark, stage, max_files), PRICES, required=PRICE_KEY)
    writer = clean.writeStream.format("parquet").partitionBy("pull_date").option("path", sink)
    return _start(writer, checkpoint, available_now)


def reject_stream(
    spark: SparkSession, stage: Stage, sink: str, checkpoint: str,
    available_now: bool = True, max_files: int | None = MAX_FILES,
) -> StreamingQuery:
    """The rows that ``append_stream`` leaves out, with the reason; a query of its own."""
    _, bad = split_rejects(read_arrivals(spark, stage, max_files), PRICES, required=PRICE_KEY)
    return _start(bad.writeStream.format("parquet").option("path", sink), checkpoint, available_now)


def _each_batch(
    rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool
) -> StreamingQuery:
    return _start(rows.writeStream.foreachBatch(apply), checkpoint, available_now)


def merge_stream(
    spark: SparkSession, stage: Stage, target_path: str, checkpoint: str,
    rejects_path: str | None = None, available_now: bool = True, max_files: int | None = MAX_FILES,
    maintained: Maintained | None = None, ledger_path: str | None = None, table: str = "prices",
) -> StreamingQuery:
    """Insert-only merge of arriving price files; each batch keeps its rejects.

    They go below ``rejects_path``, by default a hidden folder of the target.  The stream tells
    which files are new, at most ``max_files`` at a time; they are then read as a batch load
    reads them, by their own types.  An unreadable file fails the query, unless its stage
    passes over such files.

    With ``ledger_path`` stream and batch loads share one ledger: files that it names are not read,
    and a batch enters its own files after its data.  A batch that is repeated finds its rows in
    the table, or its files in the ledger, and adds nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rejects = f"{rejects_path or f'{target_path}/_rejects'}/batch={batch_id}"
        spark = batch.sparkSession
        paths = sorted(unquote(row["file_path"]) for row in batch.distinct().collect())
        files = None
        if paths and ledger_path:
            files = listed_files(spark, paths).join(known_files(read_ledger(spark, ledger_path), table), "path", "left_anti")
            files = spark.createDataFrame(files.collect(), files.schema)  # of one batch
            paths = [row["path"] for row in files.orderBy("path").collect()]
        if paths:
            done, _, _ = merge_files(batch.sparkSession, stage, paths, target_path, rejects, maintained)
            if len(done) < len(paths) and not stage.skip_unreadable:
                raise ValueError(f"unreadable: {sorted(set(paths) - set(done))}")
            if files is not None and done:
                record_files(files.filter(F.col("path").isin(done)), table, datetime.now(), ledger_path)

    arrivals = read_arrivals(spark, stage, max_files).select("_metadata.file_path")
    return _each_batch(arrivals, apply, checkpoint, available_now)


def upsert_stream(
    spark: SparkSession, stage: Stage, items: VersionedTable, checkpoint: str,
    available_now: bool = True, max_files: int | None = MAX_FILES,
) -> StreamingQuery:
    """Newer-wins merge of arriving item files; an older snapshot changes nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_item_rows(batch, items, f"batch-{batch_id}")

    return _each_batch(read_arrivals(spark, stage, max_files), apply, checkpoint, available_now)
