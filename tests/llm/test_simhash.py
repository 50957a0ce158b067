from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from pricetrail.llm import queries, simhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_against_brute_force(spark, sf):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_simhash(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    groups = plain_components(prints)
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in texts}


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_every_pair_within_the_distance_is_found(spark, distance):
    rng = random.Random(distance)
    prints = {rng.getrandbits(64)}
    for _ in range(40):  # chains of neighbours, some too far
        flips = rng.sample(range(64), rng.randint(1, distance + 2))
        prints.add(rng.choice(sorted(prints)) ^ sum(1 << f for f in flips))
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed], "fp LONG")
    got = {frozenset((signed[r.fp_a], signed[r.fp_b])) for r in simhash.near_pairs(frame, distance).collect()}
    assert got == {
        frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance
    }


def test_long_chains_are_one_component(spark):
    values = [0]
    for b in range(0, 60, 3):
        values.append(values[-1] | 0b111 << b)
    frame = spark.createDataFrame([(v,) for v in values], "fp LONG")
    pairs = simhash.near_pairs(frame, 3).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))
    groups = simhash.components(pairs, "chain").collect()
    assert len(groups) == len(values) and {r.component for r in groups} == {0}


def test_odd_rows(docs, prose):
    long_text = prose(1, 20_000)
    frame = docs((5, None), (3, ""), (4, " \t\n"), (7, "One two"), (9, "one  TWO"), (9, "one two"), (8, long_text),
                 (None, "one two"), (None, None))
    got = sorted(map(tuple, simhash.simhash_groups(frame).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (4, 3), (7, 7), (9, 7), (9, 7), (8, 8), (None, 7), (None, 3)], key=str)
    kept = simhash.keep_one_of_each(frame)
    assert kept.schema == frame.schema
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]


def test_rows_without_id_stay_when_nothing_else_has_their_text(docs):
    frame = docs((None, "lone words here"), (1, "others"), (1, "others"))
    assert sorted((r.doc_id for r in simhash.keep_one_of_each(frame).collect()), key=str) == [1, None]


def test_an_id_whose_rows_differ_stays_for_each_of_its_groups(docs, prose):
    a, b, c = (prose(n) for n in (11, 12, 13))
    # Group a: its smallest id, 5, has another row in group b, where 3 is smaller; 5 alone has text c.
    frame = docs((5, a), (7, a), (5, b), (3, b), (5, c), (5, c), (None, a), (9, prose(14)))
    got = sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(frame).collect())
    assert got == sorted([(5, a), (3, b), (5, c), (9, prose(14))])


def test_empty_table(docs):
    assert simhash.simhash_groups(docs()).collect() == []
    assert simhash.keep_one_of_each(docs()).collect() == []
