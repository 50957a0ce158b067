"""SimHash near-duplicates by multi-index hashing.

A fingerprint has one bit for each bit that is set in over half of the shingle hashes.  Two
fingerprints that differ in at most ``d`` bits differ in at most ``d // m`` bits of one of
their ``m`` segments.  So every fingerprint looks up, for each segment, all values within
that small Hamming ball, fetches the table entries and verifies the complete distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import arrow_runs, components, give_back, stored, stored_by_batches

BITS = 64
HASHES_AT_ONCE = 1 << 16
SLICE_CHARS = 1 << 20


def fingerprint(data: bytes, width: int = 3, seed: int = 42) -> int:
    """The SimHash of one text, as an unsigned integer; a text without words has 0."""
    words = data.lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    counts = np.zeros(BITS, np.int64)
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, HASHES_AT_ONCE):
        high = min(n, low + HASHES_AT_ONCE)
        cuts = zip(starts[low:high].tolist(), ends[low + width - 1 : high + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in cuts], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(text: Column, width: int = 3) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            runs = (run for _, run in arrow_runs(texts, SLICE_CHARS))
            found = [fingerprint(text.encode(), width) for run in runs for text in run]
            yield pa.array(np.array(found, np.uint64).view(np.int64))
            del texts, runs, found
        give_back()

    return of(text)


def _segments(max_distance: int) -> tuple[list[tuple[int, int]], int]:
    """(first bit, bits) of each segment, and the radius to search in each.

    Two segments keep the keys long, so that a table entry stays selective as the corpus
    grows; beyond a radius of two there are more segments rather than larger balls.
    """
    m = max(2, -(-(max_distance + 1) // 3))
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:], strict=False)], max_distance // m


def _ball(bits: int, radius: int) -> list[int]:
    return [sum(1 << i for i in flips) for r in range(radius + 1) for flips in combinations(range(bits), r)]


def near_pairs(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """Pairs of distinct fingerprints (column ``fp``) within ``max_distance`` bits: fp_a < fp_b, each once or more."""
    segments, radius = _segments(max_distance)
    part = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1)) if bits < BITS else F.col("fp")
        for low, bits in segments
    ]
    entry = F.explode(F.array([F.struct(F.lit(i).alias("seg"), p.alias("key")) for i, p in enumerate(part)]))
    table = prints.select("fp", entry.alias("at")).select("at.seg", "at.key", F.col("fp").alias("fp_b"))
    probes = [
        F.struct(F.lit(i).alias("seg"), p.bitwiseXOR(F.lit(flip)).alias("key"))
        for i, ((_, bits), p) in enumerate(zip(segments, part, strict=True))
        for flip in _ball(bits, radius)
    ]
    probe = prints.select("fp", F.explode(F.array(*probes)).alias("at"))
    probe = probe.select("at.seg", "at.key", F.col("fp").alias("fp_a"))
    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= max_distance
    return probe.join(table, ["seg", "key"]).filter((F.col("fp_a") < F.col("fp_b")) & near).select("fp_a", "fp_b")


def simhash_groups(docs: DataFrame, width: int = 3, max_distance: int = 3) -> DataFrame:
    """doc_id, fp (signed long), component_id and ``group`` of every row of ``docs`` (doc_id, text).

    ``group`` is a fingerprint of the row's group: ids that repeat can be the smallest of two groups.  Null and empty texts have fingerprint 0 and are linked like any other.  Repeated ids and
    rows each give a row.  Rows without id link too; a group of only such rows has a null
    component.  Further columns are ignored.  An empty table gives an empty result.
    """
    found = docs.select("doc_id", fingerprints(F.col("text"), width).alias("fp"))
    found = stored_by_batches(found, "prints")
    prints = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    pairs = near_pairs(prints.select("fp"), max_distance)
    groups = components(pairs.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")), "simhash")
    joined = prints.join(groups, prints["fp"] == groups["node"], "left")
    joined = joined.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    joined = stored(joined, "labelled")
    ids = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(joined.join(ids, "component").select("fp", "component_id", F.col("component").alias("group")), "named")
    return found.join(named, "fp").select("doc_id", "fp", "component_id", "group")


def keep_one_of_each(docs: DataFrame, width: int = 3, max_distance: int = 3) -> DataFrame:
    """``docs`` with one row of each group: that of its smallest id.

    Of several rows with that id in the group one stays; an id whose rows differ can stay for
    more than one group.  Rows of a group without any id all stay.  All columns are kept as they
    are, whatever their names.
    """
    groups = stored(simhash_groups(docs, width, max_distance), "groups")
    stays = F.col("doc_id") == F.col("component_id")
    ids = groups.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
    ids = ids.agg((F.count(F.lit(1)) > 1).alias("repeats"), F.bool_or(stays).alias("stays"))
    marked = stored(ids.filter("repeats OR NOT stays"), "marked-ids")

    with_id = docs.filter(F.col("doc_id").isNotNull())
    single = with_id.join(marked, with_id["doc_id"] == marked["__id"], "left_anti")

    # Only a row's own fingerprint tells the rows of a repeated id, and those without id, apart.
    repeated = marked.filter("repeats")
    others = with_id.join(repeated, with_id["doc_id"] == repeated["__id"], "left_semi")
    others = others.union(docs.filter(F.col("doc_id").isNull()))
    others = others.select(F.struct("*").alias("doc"), fingerprints(F.col("text"), width).alias("own"))
    kept = groups.filter(stays | F.col("component_id").isNull()).distinct()
    same = F.col("doc.doc_id").eqNullSafe(kept["doc_id"]) & (F.col("own") == kept["fp"])
    others = stored_by_batches(others.join(kept, same).select("doc", "group"), "told-apart")
    once = others.filter(F.col("doc.doc_id").isNotNull()).dropDuplicates(["group"])
    nameless = others.filter(F.col("doc.doc_id").isNull())
    return single.union(once.select("doc.*")).union(nameless.select("doc.*"))
