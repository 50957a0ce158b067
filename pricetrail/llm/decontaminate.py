"""Benchmark decontamination: size-partitioned MinHash containment, in DataFrame functions only.

An item is a set of ``q`` shingles.  A document that holds at least ``t`` of them misses at
most ``(1 - t) q``, so of any larger number of the item's shingles it holds one.  The MinHash
sketch of an item is therefore its ``k`` shingles of smallest hash, with ``k`` set per size
partition (powers of two) just above ``(1 - t) q``: however long the document, it shares a
sketch entry with every item that it contains.  Candidates are verified on the exact shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import shingles_of, stored, words_of


def _words(text: Column) -> Column:
    return words_of(F.lower(text))


def item_shingles(benchmark: DataFrame, width: int = 5) -> DataFrame:
    """item_id, width, ``q`` and the distinct shingles of every item with a word.

    An item of fewer than ``width`` words is one shingle of all its words.  Rows that repeat
    an id and its shingles count once; rows of one id with other texts are items of their own.
    """
    words = benchmark.select("item_id", _words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    short = F.size("words") < width
    shingles = F.when(short, F.array(F.concat_ws(" ", "words"))).otherwise(shingles_of(F.col("words"), width))
    return (
        words.select(
            "item_id",
            F.least(F.size("words"), F.lit(width)).alias("width"),
            F.array_sort(F.array_distinct(shingles)).alias("shingles"),
        )
        .distinct()
        .withColumn("q", F.size("shingles"))
        .withColumn("item", F.xxhash64("item_id", "shingles"))
    )


def sketches(items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """width, hash and item of every sketch entry: the ``k`` smallest hashes of each item."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2("q")) + 1) - 1  # of the item's size partition
    k = (F.floor(F.lit(1.0 - threshold) * largest + 1e-9) + 1).cast("int")
    entries = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s)))
    return items.select("item", "width", F.explode(F.slice(entries, F.lit(1), k)).alias("hash"))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Pairs (doc_id, item_id) where the document holds ``threshold`` or more of the item's shingles.

    Words are lower-cased; shingles are sets.  Columns: doc_id, item_id, n_shared, n_item
    (shingles) and containment.  Null, empty and shorter texts hold nothing; repeated ids give
    one row for each item, with the largest containment of their rows; null ids count as one id.
    Empty tables give no pairs.  Further columns are ignored.
    """
    items = stored(item_shingles(benchmark, width), "items")
    index = stored(sketches(items, threshold).distinct(), "sketches")
    widths = sorted(r["width"] for r in items.select("width").distinct().limit(width).collect())
    if not widths:
        return _pairs(docs, items).limit(0)
    body = docs.select("doc_id", _words(F.col("text")).alias("words"))

    def hashes(n: int) -> Column:
        at = lambda s: F.struct(F.lit(n).alias("width"), F.xxhash64(s).alias("hash"))
        return F.transform(shingles_of(F.col("words"), n), at)

    every = F.concat(*[hashes(n) for n in widths])
    seen = body.select("doc_id", F.explode(every).alias("at")).select("doc_id", "at.width", "at.hash")
    hits = seen.join(index, ["width", "hash"]).select("doc_id", "item").distinct()
    hits = stored(hits, "candidates")
    ids = stored(hits.select(F.col("doc_id").alias("id")).distinct(), "candidate-ids")
    held = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    # A text is known by its hash: a repeated row adds nothing, and a repeated task gives the same rows.
    held = held.select("doc_id", F.sha2("text", 256).alias("row"), _words(F.col("text")).alias("words"))
    texts = F.array_distinct(F.concat(*[shingles_of(F.col("words"), n) for n in widths]))
    known = stored(items.select(F.explode("shingles").alias("shingle")).distinct(), "shingles")
    lines = held.select(F.col("doc_id").alias("id"), "row", F.explode(texts).alias("shingle"))
    lines = lines.join(known, "shingle", "left_semi").distinct()
    # Only the shingles of a document's own candidates meet its text.
    wanted = hits.join(items.select("item", "item_id", "q", "shingles"), "item")
    wanted = wanted.select("doc_id", "item", "item_id", "q", F.explode("shingles").alias("wanted"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("wanted") == F.col("shingle"))
    shared = wanted.join(lines, same).select("doc_id", "row", "item", "item_id", "q")
    counts = shared.groupBy("doc_id", "row", "item", "item_id", "q").agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.filter(F.col("n") >= F.lit(threshold) * F.col("q") - 1e-9)
    return _pairs_of(pairs)


def _pairs_of(pairs: DataFrame) -> DataFrame:
    best = F.max(F.struct((F.col("n") / F.col("q")).alias("containment"), "n", "q"))
    return (
        pairs.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n").cast("long").alias("n_shared"),
            F.col("best.q").cast("long").alias("n_item"),
            F.col("best.containment").alias("containment"),
        )
    )


def _pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The empty result with its types."""
    none = docs.select("doc_id").limit(0).join(items.select("item_id", "q"), F.lit(False))
    return _pairs_of(none.withColumn("n", F.lit(0).cast("long")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows whose id is in a pair of ``contaminated``; all columns stay.

    Null and empty texts stay, and an empty table on either side changes nothing.
    """
    gone = contaminated(docs, benchmark, width, threshold).select(F.col("doc_id").alias("__gone")).distinct()
    gone = stored(gone, "contaminated")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]), "left_anti")
