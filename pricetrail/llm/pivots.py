"""Centroid clustering of integer vectors by a table of pivot distances (LAESA).

The distances of every vector to a few fixed pivots are stored once.  In each round the
centroids' distances to the same pivots bound, by the triangle inequality, how near a centroid can
be to a vector.  The centroid of the least bound is measured first; after it only centroids
whose bound does not exceed the best distance so far are measured, in integers, which are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import stored

PIVOTS = 8
SCALE = 256
WIDEST = 1 << 27  # of a scaled component: squared distances of 64 such components fit 63 bits
AT_ONCE = 4096
SLACK = 1e-9  # relative error of a root and a difference, many times over


def scaled(vectors: DataFrame, size: int, scale: int = SCALE) -> DataFrame:
    """vec_id and ``x``, the floors of the scaled components, of the vectors that count."""
    doubles = F.transform("embedding", lambda v: v.cast("double"))
    most = float(WIDEST) / scale
    fit = (F.size("embedding") == size) & F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < most))
    kept = vectors.filter(F.coalesce(fit, F.lit(False)))
    return kept.select("vec_id", F.transform(doubles, lambda v: F.floor(v * F.lit(float(scale))).cast("int")).alias("x"))


def first_centroids(points: DataFrame, n: int, seed: str) -> np.ndarray:
    """The vectors of the ``n`` smallest hashes; rows without id come last, ties go by the vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = points.orderBy(F.asc_nulls_last(digest), "x").limit(n).select("x").collect()
    return np.array([row["x"] for row in chosen], np.int64)


def choose_pivots(centroids: np.ndarray, n: int) -> np.ndarray:
    """Starting centroids that lie far from each other: each next one is furthest from those chosen."""
    chosen = [0]
    nearest = ((centroids - centroids[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(centroids)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((centroids - centroids[chosen[-1]]) ** 2).sum(axis=1))
    return centroids[chosen]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to one vector or to the same row of ``y``."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1).astype(np.float64))


def nearest(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector, its squared distance, and how many distances were measured.

    ``table`` and ``to_pivots`` have the pivot distances of the vectors and of the centroids.
    Of equally near centroids the one of smallest number counts.
    """
    bound = np.zeros((len(x), len(centroids)))
    for p in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, p : p + 1] - to_pivots[None, :, p]), out=bound)
    largest = max(float(table.max(initial=0.0)), float(to_pivots.max(initial=0.0)))
    bound = np.maximum(bound - SLACK * largest, 0.0)
    cluster = bound.argmin(axis=1)
    best = squared(x, centroids[cluster])
    measured = len(x)
    start = cluster.copy()
    for k in np.argsort(bound.mean(axis=0), kind="stable"):
        # The root is rounded up, so that a centroid at exactly the best distance is measured.
        rows = np.flatnonzero((bound[:, k] <= np.sqrt(best.astype(np.float64)) * (1 + SLACK)) & (start != k))
        if not len(rows):
            continue
        d = squared(x[rows], centroids[k])
        measured += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (k < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = d[better], k
    return cluster, best, measured


def _assigned(frames: Iterator[pd.DataFrame], centroids: np.ndarray, pivots: np.ndarray):
    """Each frame in pieces with its vectors, clusters and distances."""
    to_pivots = pivot_distances(centroids, pivots)
    for frame in frames:
        for low in range(0, len(frame), AT_ONCE):
            part = frame.iloc[low : low + AT_ONCE]
            x, table = np.stack(part["x"].to_list()).astype(np.int64), np.stack(part["pivots"].to_list())
            yield (part, x, *nearest(x, table, centroids, to_pivots))


def sums_by_cluster(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """cluster, n and ``sums`` by component, one row per cluster and task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, size = centroids.shape
        n, sums = np.zeros(k, np.int64), np.zeros((k, size), object)
        for _, x, cluster, _, _ in _assigned(frames, centroids, pivots):
            n += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            some, at = np.unique(cluster[order], return_index=True)
            sums[some] += np.add.reduceat(x[order], at, axis=0).astype(object)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": some, "n": n[some], "sums": [[str(v) for v in sums[c]] for c in some]})

    return points.select("x", "pivots").mapInPandas(run, "cluster int, n long, sums array<string>")


def moved(parts: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floors of the exact means; those without vectors stay."""
    each = parts.select("cluster", "n", F.posexplode("sums").alias("i", "part"))
    total = each.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    new = centroids.copy()
    for row in total.collect():  # components of centroids, however many vectors there are
        new[row["cluster"], row["i"]] = int(row["total"]) // row["n"]
    return new


def cluster_vectors(
    vectors: DataFrame, clusters: int = 40, rounds: int = 5, size: int = 64, seed: str = "2", pivots: int = PIVOTS
) -> DataFrame:
    """vec_id, cluster, ``distance`` (squared) and ``centroid`` of every vector of ``size`` components.

    Components count as floor(256 x).  Vectors that are null, of another size, or hold null,
    non-finite or huge components (524,288 or more, whose squared distances exceed a long) are left
    out.  Rows that repeat an id, and rows without id, are vectors of their own; a row without id
    starts no centroid while others can.  With fewer vectors than ``clusters`` there are as
    many centroids as vectors; equal ones leave the larger number empty.  An empty table gives no
    rows.  Further columns are ignored.
    """
    points = stored(scaled(vectors, size), "points")
    start = first_centroids(points, clusters, seed)
    schema = "vec_id long, cluster int, distance long, centroid array<int>"
    if not len(start):
        return points.sparkSession.createDataFrame([], schema)
    fixed = choose_pivots(start, pivots)

    @F.pandas_udf("array<double>")
    def to_pivots(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype=object)
        return pd.Series(list(pivot_distances(np.stack(column.to_list()).astype(np.int64), fixed)))

    points = stored(points.withColumn("pivots", to_pivots("x")), "pivot-table")
    centroids = start
    for _ in range(rounds):
        centroids = moved(sums_by_cluster(points, centroids, fixed), centroids)

    @F.pandas_udf("struct<cluster int, distance long>")
    def last(x: pd.Series, table: pd.Series) -> pd.DataFrame:
        found = [
            pd.DataFrame({"cluster": cluster, "distance": best})
            for _, _, cluster, best, _ in _assigned(iter([pd.DataFrame({"x": x, "pivots": table})]), centroids, fixed)
        ]
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"cluster": [], "distance": []})

    # Ids stay outside the function: beside a null pandas would round them to doubles.
    done = stored(points.select("vec_id", last("x", "pivots").alias("found")).select("vec_id", "found.*"), "assigned")
    named = [(int(k), [int(v) for v in c]) for k, c in enumerate(centroids)]
    named = points.sparkSession.createDataFrame(named, "cluster int, centroid array<int>")
    return done.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "centroid")


def with_inertia(assigned: DataFrame) -> DataFrame:
    """``assigned`` with its distances summed over the cluster and over all."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = assigned.groupBy("cluster").agg(total.alias("total"))
    every = by_cluster.agg(F.sum("total").cast("long")).scalar()
    by_cluster = by_cluster.select("cluster", F.col("total").cast("long").alias("cluster_inertia"), every.alias("inertia"))
    # One row per centroid, and the number of centroids is a parameter.
    return assigned.join(F.broadcast(by_cluster), "cluster")
