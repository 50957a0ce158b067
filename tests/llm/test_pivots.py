"""Centroid clustering: plain rounds in whole numbers, the pivot table's bounds, its SQL, and odd rows."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np

from pricetrail.llm import pivots, queries
from pricetrail.llm.oracle import ORACLE


def plain(rows, size=64, clusters=40, rounds=5, seed="2"):
    """(vec_id, cluster, distance) in row order of the vectors that count, and the centroids."""
    kept = []
    for i, e in rows:
        if e is not None and len(e) == size and all(v is not None and math.isfinite(v) and abs(v) < 2**19 for v in e):
            kept.append((i, [math.floor(256 * float(v)) for v in e]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[:clusters]]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        groups = {}
        for (_, x), (k, _) in zip(kept, assign(), strict=True):
            groups.setdefault(k, []).append(x)
        for k, xs in groups.items():
            centroids[k] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    return sorted(((i, *a) for (i, _), a in zip(kept, assign(), strict=True)), key=str), centroids


def given(spark, rows):
    kind = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, cluster STRING, x STRING, pivots STRING, distance STRING"
    return spark.createDataFrame([(i, e, 0, "c", "x", "p", "d") for i, e in rows], kind)


def compared(spark, rows, **settings):
    found = pivots.cluster_vectors(given(spark, rows), **settings).collect()
    expected, centroids = plain(rows, **settings)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=str) == expected
    for r in found:
        assert r.centroid == centroids[r.cluster]


def vectors(n, size, seed=0, tight=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((7, size))
    return [(int(i), (middle[i % 7] + tight * rng.standard_normal(size)).astype(np.float32).tolist()) for i in range(n)]


def test_against_plain_rounds(spark):
    compared(spark, vectors(400, 64))
    compared(spark, vectors(300, 64, 1, 2.0))


def test_odd_rows(spark):
    """Nulls, other sizes, non-finite and huge components, copies, repeated and missing ids, a hot vector."""
    rows = vectors(60, 64, 2)
    one = rows[0][1]
    rows += [(100 + n, one) for n in range(150)]
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1]), (200, None), (201, []), (202, one[:63]), (203, [*one, 1.0])]
    rows += [(204, [None, *one[1:]]), (205, [math.nan, *one[1:]]), (206, [math.inf, *one[1:]]), (207, [1e30, *one[1:]])]
    rows += [(208, [0.0] * 64), (209, [-1e-9] * 64), (210, [500_000.0] * 64), (2**60 + 1, [-500_000.0] * 64)]
    compared(spark, rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    compared(spark, vectors(5, 64) + [(9, vectors(1, 64)[0][1])])
    found = pivots.with_inertia(pivots.cluster_vectors(given(spark, [(1, None)])))
    assert found.collect() == []


def test_bounds_leave_out_centroids_but_never_the_nearest():
    rng = np.random.default_rng(5)
    middle = rng.integers(-3000, 3000, (12, 64))
    x = middle[rng.integers(12, size=2000)] + rng.integers(-40, 40, (2000, 64))
    centroids = np.vstack([middle, middle[:3], rng.integers(-3000, 3000, (25, 64))])
    fixed = pivots.choose_pivots(centroids, 8)
    table, to_pivots = pivots.pivot_distances(x, fixed), pivots.pivot_distances(centroids, fixed)
    cluster, best, measured = pivots.nearest(x, table, centroids, to_pivots)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < 0.3 * every.size


def test_query_against_sql(spark, sf):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    theirs = duck.execute(ORACLE["op13_centroids"]).fetchall()
    assert sorted(tuple(r) for r in queries.QUERIES["op13_centroids"](spark, sf).collect()) == sorted(theirs)
