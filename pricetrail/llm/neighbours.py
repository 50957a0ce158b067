"""Near-duplicate vectors by NN-descent over balls of vectors.

Vectors that lie close together are first collapsed into balls: a centre, a radius and a
weight.  The radius stays below half the linking angle, so any two vectors of a ball are
linked, and a group of copies of any size is one node.  NN-descent then refines a neighbour
graph of the balls: lists start from sorted random projections, whose number grows with the
number of balls, and neighbours of neighbours are compared until the lists stop changing.
Lists keep their nearest entries, and more of them in every further round.  The entries that can hold a
link join balls into clusters; inside a cluster links are counted exactly, by products of tiles
of balls, so a dense group costs no row per pair.  Two balls are linked as a whole, not at
all, or, in between, vector by vector.  A sample compared by brute force audits recall; should
every round miss the target, all balls are counted as one cluster.
"""

from __future__ import annotations

import functools
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import components, stored

BITS = 40  # of a projection key
BLOCK = 512  # neighbours in the sorted order that are compared
NEAREST = 12  # entries of a list in the first round; each further round doubles them
MISSED = 0.002  # of the pairs at the linking angle, by the signs' chance, that no projection brings together
AT_ONCE = 6  # projections whose entries are put into the lists together
JOINED = 48  # entries of a list, with those that list it, that meet in one refinement
TILE = 256  # vectors
BALLS = 1024  # of a tile of balls
ENOUGH = 100  # audited vectors with a partner outside their ball
AUDITED = 32_768  # vectors that the audit compares at most, where partners are rare
AUDIT_VALUES = 1 << 21  # vector components that are compared at once
MARGIN = 1e-7  # radians around the linking angle that are compared exactly

BALL = "ball long, center array<double>, radius double, weight long"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _unit(x) -> np.ndarray | None:
    """A vector in double precision scaled to length one; None where it has no direction."""
    if x is None:
        return None
    v = np.array([np.nan if y is None else y for y in x], np.float64)
    if not len(v) or not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()  # so that no square overflows or vanishes
    return v / np.sqrt((v * v).sum())


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, ``vector`` (null where the embedding has no direction) and its hash."""

    @F.pandas_udf("array<double>")  # ids stay outside: beside a null pandas would round them to doubles
    def unit(column: pd.Series) -> pd.Series:
        return pd.Series([_unit(x) for x in column], dtype=object)

    found = vectors.select("vec_id", unit("embedding").alias("vector"))
    return found.withColumn("hash", F.xxhash64("vector"))


def _projected(centers: Column, table: int) -> Column:
    """The signs of random projections, as a number to sort by."""

    @F.pandas_udf("long")
    def key(column: pd.Series) -> pd.Series:
        out = np.empty(len(column), np.int64)
        sizes = np.array([len(x) for x in column])
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            planes = np.random.default_rng([table, int(d)]).standard_normal((int(d), BITS))
            signs = _matrix(column.iloc[at]) @ planes > 0
            out[at] = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)) + (int(d) << BITS)
        return pd.Series(out)

    return key(centers)


def _in_order(balls: DataFrame, table: int) -> DataFrame:
    keyed = balls.withColumn("key", _projected(F.col("center"), table))
    return keyed.repartitionByRange("key", "ball").sortWithinPartitions("key", "ball")


def _blocks(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Runs of ``size`` rows of one dimension, in order."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        while rest is not None and len(rest) >= size:
            yield from _even(rest.iloc[:size].reset_index(drop=True))
            rest = rest.iloc[size:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield from _even(rest)


def _even(block: pd.DataFrame) -> Iterator[pd.DataFrame]:
    sizes = block["center"].map(len)
    for d in sizes.unique():
        yield block[sizes == d].reset_index(drop=True)


def _collapsed(block: pd.DataFrame, most: float) -> pd.DataFrame:
    """Each ball of a block with the ball that takes it up; a ball that stays takes up itself."""
    center, radius = _matrix(block["center"]), block["radius"].to_numpy(copy=True)
    weight, ball = block["weight"].to_numpy(), block["ball"].to_numpy()
    taken = np.arange(len(block))
    angle = _angles(center, center)
    np.fill_diagonal(angle, 0.0)
    free = np.ones(len(block), bool)
    new = {}
    near = (angle + radius[None, :] <= most).sum(axis=1)
    for i in np.lexsort((ball, -weight)).tolist():
        if not free[i] or near[i] < 2:
            continue
        members = np.flatnonzero(free & (angle[i] + radius <= 1.5 * most))
        middle = (center[members] * weight[members, None]).sum(axis=0)
        middle /= np.linalg.norm(middle)
        reach = _angles(middle[None, :], center[members])[0] + radius[members] + 1e-8
        inside = members[reach <= most]
        if i not in inside:
            middle, reach = center[i], angle[i] + radius + 1e-8
            inside = np.flatnonzero(free & (reach <= most))
            reach = reach[inside]
        else:
            reach = reach[reach <= most]
        free[i] = False
        if len(inside) < 2:
            continue
        free[inside] = False
        top = inside[np.argmin(ball[inside])]
        taken[inside] = top
        new[top] = (middle, float(reach.max()), int(weight[inside].sum()))
    out = pd.DataFrame({"was": ball, "ball": ball[taken]})
    stays = taken == np.arange(len(block))
    rows = [new.get(i, (center[i], radius[i], weight[i])) for i in range(len(block))]
    for name, k in (("center", 0), ("radius", 1), ("weight", 2)):
        out[name] = pd.Series([row[k] if s else None for row, s in zip(rows, stays, strict=True)], dtype=object)
    return out


def collapse(balls: DataFrame, most: float, table: int) -> tuple[DataFrame, DataFrame]:
    """The balls after one pass, and which ball each old one went to (was, ball)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(frames, BLOCK):
            yield _collapsed(block, most)

    found = _in_order(balls, table).drop("key").mapInPandas(run, f"was long, {BALL}")
    found = stored(found, f"collapse-{table}")
    fields = [f.split()[0] for f in BALL.split(", ")]
    return found.filter("was = ball").select(fields), found.select("was", "ball")


def _entries(ids: np.ndarray, center: np.ndarray, radius: np.ndarray, k: int, worst: np.ndarray | None = None) -> pd.DataFrame:
    """Pairs a < b of a block for the lists: the ``k`` nearest of each.

    ``worst`` is the reach of the furthest entry of each full list; others beyond it change nothing.
    """
    angle = _angles(center, center)
    reach = angle - radius[:, None] - radius[None, :]
    np.fill_diagonal(reach, np.inf)
    most = min(k, len(ids) - 1)
    nearest = np.argpartition(reach, most, axis=1)[:, :most] if most else np.zeros((len(ids), 0), int)
    rows = np.arange(len(ids))[:, None]
    limit = np.inf if worst is None else worst[:, None]
    keep = np.zeros_like(reach, bool)
    keep[rows, nearest] = reach[rows, nearest] < limit
    a, b = np.nonzero(keep | keep.T)
    once = ids[a] < ids[b]
    a, b = a[once], b[once]
    return pd.DataFrame({"a": ids[a], "b": ids[b], "angle": angle[a, b], "reach": reach[a, b]})


EDGE = "a long, b long, angle double, reach double"


def sorted_neighbours(balls: DataFrame, table: int, k: int) -> DataFrame:
    """List entries among neighbours in the order of one projection."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(frames, BLOCK):
            yield _entries(block["ball"].to_numpy(), _matrix(block["center"]), block["radius"].to_numpy(), k)

    ordered = _in_order(balls, table).select("ball", "center", "radius")
    return ordered.mapInPandas(run, EDGE)


def projections(n: int, theta: float, least: int) -> int:
    """Orders after which a pair at the angle ``theta`` shared a block in all but ``MISSED`` of cases.

    The pair shares a block if its first signs agree, down to runs of half a block.
    """
    bits = max(0.0, np.log2(max(1, n) / BLOCK) + 1)
    together = (1 - theta / np.pi) ** bits
    return least if together >= 1 else max(least, int(np.ceil(np.log(MISSED) / np.log1p(-together))))


def _both_ways(edges: DataFrame, *columns: str) -> DataFrame:
    there = edges.select(F.col("a").alias("pivot"), F.col("b").alias("ball"), *columns)
    return there.union(edges.select("b", "a", *columns))


def _ranked(edges: DataFrame, k: int) -> DataFrame:
    """pivot, ball, the other columns and ``place``: the ``k`` nearest entries of each list."""
    place = F.row_number().over(Window.partitionBy("pivot").orderBy("reach", "ball"))
    return _both_ways(edges, "angle", "reach", "fresh").withColumn("place", place).filter(F.col("place") <= k)


def _lists(entries: DataFrame, k: int) -> DataFrame:
    """Entries (with ``fresh``: 1 if new) as edges a < b, which are in the list of one end or of both."""
    least = [F.min(c).alias(c) for c in ("angle", "reach", "fresh")]
    edges = entries.groupBy("a", "b").agg(*least)
    ends = [F.least("pivot", "ball").alias("a"), F.greatest("pivot", "ball").alias("b")]
    return _ranked(edges, k).select(*ends, "angle", "reach", "fresh").distinct()


def refine(edges: DataFrame, balls: DataFrame, k: int, turn: int) -> DataFrame:
    """One step of NN-descent: the entries of every list, forward and reverse, are compared with each other.

    Of a longer list another choice of ``JOINED`` entries meets in each turn; in a shorter one, pairs
    of entries that were there the turn before have met, so lists without a new entry rest.
    """
    place = Window.partitionBy("pivot").orderBy(F.xxhash64(F.col("ball") + F.lit(turn)))
    lists = _both_ways(edges, "fresh").withColumn("place", F.row_number().over(place)).filter(F.col("place") <= JOINED)
    worst = _ranked(edges, k).filter(F.col("place") == k).select(F.col("pivot").alias("ball"), F.col("reach").alias("worst"))
    ends = balls.select("ball", "center", "radius").join(worst, "ball", "left")
    lists = lists.join(ends.fillna(float("inf"), ["worst"]), "ball")
    lists = lists.groupBy("pivot").agg(
        F.collect_list(F.struct("ball", "center", "radius", "worst")).alias("entries"), F.max("fresh").alias("fresh")
    )
    lists = lists.filter((F.size("entries") > 1) & ((F.col("fresh") == 1) | (F.size("entries") == JOINED)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for entries in frame["entries"]:
                of: dict[int, list] = {}
                for e in entries:
                    of.setdefault(len(e["center"]), []).append(e)
                for same in of.values():
                    if len(same) > 1:
                        ids = np.array([e["ball"] for e in same], np.int64)
                        center = np.stack([np.asarray(e["center"], np.float64) for e in same])
                        radius, worst = (np.array([e[c] for e in same]) for c in ("radius", "worst"))
                        yield _entries(ids, center, radius, k, worst)

    return lists.select("entries").mapInPandas(run, EDGE)


def neighbour_graph(balls: DataFrame, tables: list[int], seen: DataFrame | None, k: int) -> DataFrame:
    """Edges a < b of the refined graph, with the angle of their centres: at most ``k`` for each ball."""
    label = f"graph-{tables[0]}"
    edges = seen
    for low in range(0, len(tables), AT_ONCE):
        parts = [sorted_neighbours(balls, t, k).withColumn("fresh", F.lit(1)) for t in tables[low : low + AT_ONCE]]
        parts += [edges] if edges is not None else []
        edges = stored(_lists(functools.reduce(DataFrame.unionByName, parts), k), f"{label}-from-{low}")
    edges = edges.withColumn("fresh", F.lit(1))
    turn = 0
    while True:
        new = refine(edges, balls, k, turn).withColumn("fresh", F.lit(1))
        edges = stored(_lists(edges.withColumn("fresh", F.lit(0)).unionByName(new), k), f"{label}-{turn}")
        n, fresh = edges.agg(F.count(F.lit(1)), F.sum("fresh")).first()
        if (fresh or 0) * 1000 <= n:
            return edges
        turn += 1


def _first_of_each(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches by symmetric links."""
    label = ids.copy()
    while True:
        new = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(new, label)
        if (new == label).all():
            return label
        label = new


def _ball_counts(met: DataFrame, theta: float) -> DataFrame:
    """Of pairs of tiles of balls: what each ball has there, and pairs of balls that must be compared by vector.

    ball, ``n`` (vectors of other balls that it is linked to as a whole) and ``first`` (the smallest ball that it reaches
    by such links); or a and b.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for same, x, y in zip(frame["same"], frame["x"], frame["y"], strict=True):
                both = list(x) if same else [*x, *y]
                ids = np.array([e["ball"] for e in both], np.int64)
                center = np.stack([np.asarray(e["center"], np.float64) for e in both])
                radius, weight = np.array([e["radius"] for e in both]), np.array([e["weight"] for e in both], np.int64)
                angle, apart = _angles(center, center), radius[:, None] + radius[None, :]
                across = ~np.eye(len(ids), dtype=bool)
                if not same:
                    side = np.arange(len(ids)) < len(x)
                    across &= side[:, None] != side[None, :]
                sure = (angle + apart <= theta - MARGIN) & across
                n = sure @ weight
                some = n > 0
                yield pd.DataFrame(
                    {"ball": ids[some], "n": n[some], "first": _first_of_each(sure, ids)[some], "a": None, "b": None}
                ).astype({"a": "Int64", "b": "Int64"})
                a, b = np.nonzero((angle - apart <= theta + MARGIN) & ~sure & across & (ids[:, None] < ids[None, :]))
                yield pd.DataFrame({"ball": None, "n": None, "first": None, "a": ids[a], "b": ids[b]}).astype(
                    {"ball": "Int64", "n": "Int64", "first": "Int64"}
                )

    return met.mapInPandas(run, "ball long, n long, first long, a long, b long")


def _counted_balls(balls: DataFrame, edges: DataFrame | None, theta: float, label: str) -> DataFrame:
    """``_ball_counts`` inside every cluster of balls; without ``edges`` all balls of a dimension are one."""
    dealt = balls.withColumn("d", F.size("center"))
    if edges is None:
        dealt = dealt.withColumn("cluster", F.lit(0).cast("long"))
    else:
        near = edges.filter(F.col("reach") <= theta + MARGIN).select("a", "b")
        dealt = dealt.join(components(near, f"clusters-{label}"), F.col("ball") == F.col("node")).withColumnRenamed(
            "component", "cluster"
        )
    dealt = stored(dealt.select("ball", "center", "radius", "weight", "d", "cluster"), f"clustered-{label}")
    sizes = dealt.groupBy("cluster", "d").agg(F.ceil(F.count(F.lit(1)) / BALLS).cast("int").alias("tiles"))
    sizes = stored(sizes, f"sizes-{label}")
    tile = F.pmod(F.xxhash64("ball"), F.col("tiles")).cast("int")
    rows = F.collect_list(F.struct("ball", "center", "radius", "weight")).alias("rows")
    tiles = stored(dealt.join(sizes, ["cluster", "d"]).groupBy("cluster", "d", tile.alias("tile")).agg(rows), f"ball-tiles-{label}")
    # Pairs of tiles, not of balls: with m balls in a cluster (m / BALLS) squared.
    pairs = sizes.select("cluster", "d", "tiles", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"))
    pairs = pairs.select("cluster", "d", "i", F.explode(F.sequence(F.col("i"), F.col("tiles") - 1)).alias("j"))
    left = tiles.select("cluster", "d", F.col("tile").alias("i"), F.col("rows").alias("x"))
    right = tiles.select("cluster", "d", F.col("tile").alias("j"), F.col("rows").alias("y"))
    met = pairs.join(left, ["cluster", "d", "i"]).join(right, ["cluster", "d", "j"])
    # Each pair is a task's work of its own; pairs of one tile are not dealt by its key.
    met = met.select((F.col("i") == F.col("j")).alias("same"), "x", "y").hint("rebalance")
    return stored(_ball_counts(met, theta), f"ball-counts-{label}")


def _tile_counts(pairs: DataFrame, cosine: float) -> DataFrame:
    """For pairs of tiles: each vector with linked rows in the other tile, their number, and the two balls."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b, x, y in zip(frame["a"], frame["b"], frame["x"], frame["y"], strict=True):
                u, v = (np.stack([np.asarray(e["vector"], np.float64) for e in side]) for side in (x, y))
                linked = u @ v.T >= cosine
                wu, wv = (np.array([e["weight"] for e in side], np.int64) for side in (x, y))
                for side, n in ((x, linked @ wv), (y, wu @ linked)):
                    nodes = np.array([e["node"] for e in side], np.int64)
                    yield pd.DataFrame({"node": nodes[n > 0], "n": n[n > 0], "a": a, "b": b})

    return pairs.mapInPandas(run, "node long, n long, a long, b long")


def _links(
    nodes: DataFrame, node_ball: DataFrame, balls: DataFrame, edges: DataFrame | None, theta: float, cosine: float, label: str
) -> DataFrame:
    """node, n_links, of these ``inside`` its own ball, and component (smallest id) of every node.

    ``edges`` say which balls are counted with each other; without them all are.
    """
    told = _counted_balls(balls, edges, theta, label)
    whole = told.filter(F.col("ball").isNotNull()).groupBy("ball").agg(F.sum("n").alias("beside"))
    weights = balls.select(F.col("ball").alias("w_ball"), "weight")
    check = told.filter(F.col("a").isNotNull()).select("a", "b")
    check = check.join(weights, F.col("a") == F.col("w_ball")).select("a", "b", F.col("weight").alias("wa"))
    check = check.join(weights, F.col("b") == F.col("w_ball")).select("a", "b", "wa", F.col("weight").alias("wb"))
    check = stored(check, f"pairs-{label}")
    wanted = check.select(F.col("a").alias("ball"), F.col("wa").alias("w")).union(check.select("b", "wb")).distinct()
    tiles = node_ball.join(wanted, "ball").join(nodes.select("node", "vector", "weight"), "node")
    tile = F.pmod(F.xxhash64("node"), F.ceil(F.col("w") / TILE))
    tiles = tiles.groupBy("ball", tile.alias("tile")).agg(
        F.collect_list(F.struct("node", "weight", "vector")).alias("rows")
    )
    tiles = stored(tiles, f"tiles-{label}")
    met = check.join(tiles.select(F.col("ball").alias("a"), F.col("rows").alias("x")), "a")
    met = met.join(tiles.select(F.col("ball").alias("b"), F.col("rows").alias("y")), "b")
    counted = stored(_tile_counts(met.select("a", "b", "x", "y"), cosine), f"counts-{label}")
    single = counted.groupBy("node").agg(F.sum("n").alias("single"))

    reached = told.filter(F.col("first") < F.col("ball")).select(F.col("first").alias("a"), F.col("ball").alias("b"))
    joined = reached.union(counted.select("a", "b")).distinct()
    groups = components(joined, f"balls-{label}")
    firsts = node_ball.join(nodes.select("node", "first"), "node").groupBy("ball").agg(F.min("first").alias("first"))
    named = balls.select("ball", "weight").join(firsts, "ball").join(groups, F.col("ball") == F.col("node"), "left")
    named = named.select("ball", "weight", "first", F.coalesce("component", "ball").alias("component"))
    named = stored(named.join(whole, "ball", "left"), f"named-{label}")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(named.join(least, "component").select("ball", "weight", "beside", "component_id"), f"least-{label}")
    found = node_ball.join(named, "ball").join(single, "node", "left")
    count = F.col("weight") - 1 + F.coalesce("beside", F.lit(0)) + F.coalesce("single", F.lit(0))
    inside = (F.col("weight") - 1).alias("inside")
    return stored(found.select("node", count.alias("n_links"), inside, "component_id"), f"links-{label}")


def _compared(nodes: DataFrame, rows: list, cosine: float) -> DataFrame:
    """node and n, the rows within ``cosine``, of the nodes in ``rows``, by brute force."""
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(r["vector"]) for r in rows}:
        same = [r for r in rows if len(r["vector"]) == d]
        by_size[d] = np.array([r["node"] for r in same], np.int64), np.array([r["vector"] for r in same])

    def brute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {d: np.zeros(len(ids), np.int64) for d, (ids, _) in by_size.items()}
        for frame in frames:
            sizes = frame["vector"].map(len)
            for d, (_, queries) in by_size.items():
                some = frame[sizes == d]
                for low in range(0, len(some), TILE):
                    tile = some.iloc[low : low + TILE]
                    i, j = np.nonzero(queries @ _matrix(tile["vector"]).T >= cosine)
                    np.add.at(total[d], i, tile["weight"].to_numpy()[j])
        for d, (ids, _) in by_size.items():
            some = total[d] > 0
            yield pd.DataFrame({"node": ids[some], "n": total[d][some]})

    found = nodes.select("vector", "weight").mapInPandas(brute, "node long, n long")
    return found.groupBy("node").agg(F.sum("n").alias("n"))


def audited_recall(
    nodes: DataFrame, links: DataFrame, cosine: float, sample: int, enough: int = ENOUGH, most: int = AUDITED
) -> tuple[float, int, bool]:
    """The mean share of its links to other balls that a vector with such links has, of how many, and if they suffice.

    Nodes of smallest hash are compared with all vectors, ``sample`` of them, then more, until
    ``enough`` have a partner outside their own ball, about ``most`` are compared, or all are.
    Links inside a ball hold by construction, so they are left out.  What the driver and
    each task hold is bounded by ``AUDIT_VALUES``.
    """
    n, wide = nodes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    shares, seen, compared = 0.0, 0, 0.0
    while n and compared < min(n, most) and seen < enough:
        more = min(compared + min(max(sample, 3 * compared), max(1, AUDIT_VALUES // wide)), max(most, sample))
        # The last stretch reaches over all places, so that a small table is compared whole.
        upper = more / n if more < n else 2.0
        rows = nodes.filter((place >= compared / n) & (place < upper)).select("node", "vector").collect()
        compared = more
        if not rows:
            continue
        outside = F.col("n") - 1 - F.col("inside")
        exact = _compared(nodes, rows, cosine).join(links, "node").filter(outside > 0)
        share = F.least((F.col("n_links") - F.col("inside")) / outside, F.lit(1.0))
        own = exact.agg(F.sum(share).alias("shares"), F.count(F.lit(1)).alias("seen")).first()
        shares, seen = shares + (own["shares"] or 0.0), seen + own["seen"]
    return (shares / seen if seen else 1.0), seen, seen >= enough or compared >= n


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.9,
    tables: int = 6,
    passes: int = 3,
    audit: int = 512,
    recall: float = 0.97,
    rounds: int = 4,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    Two rows link at a cosine of at least ``cosine`` in double precision.  Null, empty and zero
    vectors and those with null or non-finite components link with nothing, and vectors link
    only with those of their own length.  Equal vectors are linked without being paired; rows
    that repeat an id count as vectors of their own.  A row without id links, but names no
    component.  Lists start from ``tables`` projections, or more in large tables.  While the audited
    recall of links between balls, of ``audit`` vectors or more, is below ``recall``, they grow from as
    many more as there were, to twice the length; after ``rounds`` times below it all balls are counted with
    each other, which is exact.  Where partners are so
    rare that the audit saw fewer than ``ENOUGH``, a warning says so.  Further columns are ignored.
    """
    theta = float(np.arccos(cosine))
    every = stored(unit_vectors(vectors), "units")
    units = every.filter(F.col("vector").isNotNull())
    nodes = units.groupBy("hash", "vector").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").cast("long").alias("first"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    balls = nodes.select(
        F.col("node").alias("ball"),
        F.col("vector").alias("center"),
        F.lit(0.0).alias("radius"),
        "weight",
    )
    node_ball = nodes.select("node", F.col("node").alias("ball"))
    for t in range(passes):
        balls, went = collapse(balls, theta / 2 - MARGIN, t)
        node_ball = node_ball.join(went, node_ball["ball"] == went["was"]).select("node", went["ball"])
        node_ball = stored(node_ball, f"node-ball-{t}")

    edges, used = None, 0
    tables = projections(balls.count(), theta, tables)
    for n in range(rounds):
        own = list(range(passes + used, passes + used + tables))
        edges = neighbour_graph(balls, own, edges, NEAREST << n)
        links = _links(nodes, node_ball, balls, edges, theta, cosine, str(n))
        share, seen, sure = audited_recall(nodes, links, cosine, audit)
        if share >= recall:
            break
        used += tables
        tables = used
    else:
        warnings.warn(f"audited recall of links is {share:.4f} of {seen} vectors; all balls are counted", stacklevel=2)
        links, share, sure = _links(nodes, node_ball, balls, None, theta, cosine, "whole"), 1.0, True
    if not sure:
        warnings.warn(f"recall of links is known of {seen} vectors only: {share:.4f}", stacklevel=2)

    named = units.join(nodes.select("hash", "vector", "node"), ["hash", "vector"]).select("vec_id", "node")
    found = named.join(links, "node").select("vec_id", "n_links", "component_id")
    alone = every.filter(F.col("vector").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    rows = found.unionByName(alone)
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
