"""Lines that many documents repeat stay in one document only.

Lines are exploded with their positions and hashed by their normalised form.  A hash that has
too few lines in all is done with after one combined grouping; of the others the distinct
documents are counted.  What is dropped is a set of positions per text, and the text is put
together again from the other positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import stored

# Fixed values of the contract: white space that a key loses at its ends, and letters that it lower-cases.
BLANKS = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashes(value: Column, name: str) -> list[Column]:
    """128 bits of a text, as two columns."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit("second half"), value).alias(f"{name}2")]


def _exploded(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, t1 and t2 (the text), position, h1 and h2 (the key) of every line with a long enough key."""
    lines = docs.select("doc_id", *_hashes(F.coalesce("text", F.lit("")), "t"), F.posexplode(lines_of(F.col("text"))))
    keyed = lines.select("doc_id", "t1", "t2", "pos", line_key(F.col("col")).alias("key"))
    return keyed.filter(F.length("key") >= least_chars).select("doc_id", "t1", "t2", "pos", *_hashes(F.col("key"), "h"))


def repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, t1, t2 (hash of the text) and ``dropped``: the positions of lines that go, of texts that lose any.

    Rows of one id are one document; rows without id are together one, and it comes before all others.
    """
    lines = _exploded(docs, least_chars)
    # Combined in each task first, so a line that everybody has is one row per task.
    often = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    # Both small sides are stored: beside a plain exchange Spark can split the tasks of a hot key in the join.
    often = stored(often.filter(F.col("n") >= least_docs).drop("n"), "often")
    found = stored(lines.join(often, KEY), "lines")
    ids = found.groupBy(*KEY, "doc_id").agg(F.first("keeper").alias("keeper"))
    shared = ids.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_docs).drop("n")
    shared = stored(shared, "shared")
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))).join(shared, KEY)
    # Rows of the same id and text are the same lines, so the set of positions is theirs in common.
    return gone.groupBy("doc_id", "t1", "t2").agg(F.collect_set("pos").alias("dropped"))


def without_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, and ``n_lines`` and ``n_dropped`` beside it.

    A line goes if its key (ends stripped of ASCII white space, A-Z lower-cased) has at least
    ``least_chars`` code points, at least ``least_docs`` documents hold it, and its document is not
    the one of largest id among them.  Null and empty texts are one empty line and come back empty;
    texts of any length are read whole.  Rows that repeat an id count as one document and each give
    a row; rows without id are together one document, which comes before all others.  An empty table
    gives no rows.  Of other columns those stay whose names are not ``n_lines`` or ``n_dropped``.
    """
    gone = repeated_lines(docs, least_chars, least_docs)
    whole = docs.select(F.struct("*").alias("doc"), "doc_id", *_hashes(F.coalesce("text", F.lit("")), "t"))
    same = [whole[c].eqNullSafe(gone[c]) for c in ("doc_id", "t1", "t2")]
    joined = whole.join(gone, same, "left").select("doc", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    lines = joined.withColumn("lines", lines_of(F.col("doc.text")))

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    # The lambda over one element binds the array of lines, which is else split anew for every position.
    text = F.get(F.transform(F.array(F.col("lines")), kept), 0)
    text = F.when(F.size("dropped") > 0, text).otherwise(F.coalesce(F.col("doc.text"), F.lit("")))
    names = [f.name for f in docs.schema if f.name not in ("n_lines", "n_dropped")]
    columns = [text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in names]
    counts = [F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped")]
    return lines.select(*columns, *counts)
