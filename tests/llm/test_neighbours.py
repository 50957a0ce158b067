from __future__ import annotations

import numpy as np
import pytest

from pricetrail.llm import neighbours, queries


def plain(vectors, cosine=0.9):
    """vec_id -> links and smallest reachable id, by all pairs."""
    unit = {i: np.asarray(v, np.float64) / np.linalg.norm(v) for i, v in vectors.items()}
    ids = sorted(unit)
    close = np.array([unit[i] for i in ids]) @ np.array([unit[i] for i in ids]).T >= cosine
    label = np.array(ids)
    while True:
        new = np.array([label[close[n]].min() for n in range(len(ids))])
        if (new == label).all():
            break
        label = new
    return {i: (int(close[n].sum()) - 1, int(label[n])) for n, i in enumerate(ids)}


@pytest.fixture
def frame(spark):
    def build(rows):
        kind = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, node LONG, ball LONG, hash STRING"
        return spark.createDataFrame([(i, v, 0, 1, 1, "x") for i, v in rows], kind)

    return build


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def clouds(seed, spreads, size, d=32):
    """Vectors around random centres, with a spread each."""
    rng = np.random.default_rng(seed)
    out = []
    for spread in spreads:
        center = rng.standard_normal(d)
        center /= np.linalg.norm(center)
        out += [center + spread * rng.standard_normal(d) / np.sqrt(d) for _ in range(size)]
    return {i: v.astype(np.float32).tolist() for i, v in enumerate(out)}


def test_clouds_of_every_density(spark, frame):
    """Links inside balls, between balls, and pair by pair around the threshold."""
    vectors = clouds(1, (0.05, 0.15, 0.25, 0.3, 0.35, 0.4, 0.5), 60) | {
        1000 + i: v for i, v in clouds(2, [1.0] * 5, 60).items()}
    exact = plain(vectors)
    got = found(neighbours.near_vectors(frame(vectors.items()), audit=200))
    links = sum(n for n, _ in exact.values())
    assert all(got[i][0] <= exact[i][0] for i in exact)
    assert sum(n for n, _ in got.values()) >= 0.97 * links > 5000
    assert sum(got[i][1] == exact[i][1] for i in exact) >= 0.97 * len(exact)


def test_query_on_the_table(spark, sf):
    rows = queries.op10_embedding_dedup(spark, sf).collect()
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == plain(table)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_copies_and_odd_vectors(spark, frame):
    a, b = [1.0, 2.0, 3.0], [-3.0, 0.5, 1.0]
    rows = [(5, a), (3, a), (9, [2.0, 4.0, 6.0]), (4, b), (7, None), (8, []), (1, [0.0, 0.0, 0.0]), (2, [1.0, None, 0.0]),
            (10, [float("nan"), 1.0, 1.0]), (11, [float("inf"), 1.0, 1.0]), (12, [1e-40, 2e-40, 3e-40]), (4, b), (13, [1.0, 2.0]),
            (None, a)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in neighbours.near_vectors(frame(rows)).collect()), key=str)
    assert got == sorted(
        [(5, 4, 3, False), (3, 4, 3, True), (9, 4, 3, False), (12, 4, 3, False), (None, 4, 3, False), (4, 1, 4, True),
         (4, 1, 4, True), (13, 0, 13, True), *[(i, 0, i, True) for i in (7, 8, 1, 2, 10, 11)]], key=str)


def test_empty_table(frame):
    assert neighbours.near_vectors(frame([])).collect() == []


def test_wide_ids_come_back_whole(frame):
    """Ids over 2**53, beside a null id: no double can hold them."""
    big = 2**60 + 1
    rows = [(big + 2 * i, [1.0, 0.001 * i, 0.0]) for i in range(6)] + [(None, [0.0, 0.0, 1.0]), (big + 100, [0.0, 1.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.near_vectors(frame(rows)).collect()}
    assert got == {
        **{big + 2 * i: (5, big, i == 0) for i in range(6)}, None: (0, None, True), big + 100: (0, big + 100, True)}


def isolated_pairs(n, pairs, cosine, d=64):
    """Random vectors, the last ``2 * pairs`` of them pairs at ``cosine``; nothing else comes close."""
    rng = np.random.default_rng(11)
    v = rng.standard_normal((n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    x, y = v[n - 2 * pairs :: 2], v[n - 2 * pairs + 1 :: 2]
    side = y - (x * y).sum(axis=1, keepdims=True) * x
    y[:] = cosine * x + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    return v


def test_isolated_pairs_are_found_in_a_table_of_many_blocks(frame, monkeypatch):
    """Blocks of 16, so that 3,000 vectors are to them what 100,000 are to blocks of 512."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rows = [(i, v.tolist()) for i, v in enumerate(isolated_pairs(3000, 200, 0.905))]
    got = found(neighbours.near_vectors(frame(rows), rounds=1, recall=0.0))
    assert sum(got[i][0] for i in range(2600, 3000)) >= 0.99 * 400
    assert all(n == 0 for i, (n, _) in got.items() if i < 2600)


def test_projections_grow_with_the_table():
    theta = float(np.arccos(0.9))
    counts = [neighbours.projections(n, theta, 6) for n in (0, 500, 50_000, 1_000_000, 100_000_000)]
    assert counts == sorted(counts) and counts[:2] == [6, 6] and counts[2] > 6 and counts[4] > 2 * counts[3] > 50


def test_the_audit_sees_lost_links_between_balls(spark):
    """Pairs that are rare, and a large ball: links inside it say nothing about those that were lost."""
    vectors = isolated_pairs(3000, 60, 0.95)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    nodes = spark.createDataFrame(rows, "node LONG, vector ARRAY<DOUBLE>, weight LONG")
    all_found = [(i, int(i >= 2880), 0) for i in range(3000)]
    for lost, want in ((0, 1.0), (60, 0.5), (120, 0.0)):
        kept = [(i, n if i >= 2880 + lost else 0, inside) for i, n, inside in all_found]
        links = spark.createDataFrame(kept, "node LONG, n_links LONG, inside LONG")
        share, seen, sure = neighbours.audited_recall(nodes, links, 0.9, 16, enough=10**6)
        assert (round(share, 6), seen, sure) == (want, 120, True)
    share, seen, sure = neighbours.audited_recall(nodes, links, 0.9, 16, enough=10)
    assert share == 0.0 and 10 <= seen < 120 and sure
    assert neighbours.audited_recall(nodes, links, 0.9, 16, most=16)[2] is False
    ball = spark.createDataFrame([(i, [1.0, i * 1e-4], 1) for i in range(50)] + [(99, [0.93, 0.37], 1)], nodes.schema)
    inside = spark.createDataFrame([(i, 49, 49) for i in range(50)] + [(99, 0, 0)], links.schema)
    assert neighbours.audited_recall(ball, inside, 0.9, 512)[0] == 0.0


def test_links_are_whole_where_the_graph_finds_nothing(frame, monkeypatch):
    none = lambda balls, tables, seen, k: frame([]).selectExpr("vec_id a", "vec_id b", "0d angle", "0d reach")
    monkeypatch.setattr(neighbours, "neighbour_graph", none)
    vectors = dict(enumerate(isolated_pairs(40, 10, 0.905).tolist()))
    with pytest.warns(UserWarning, match="all balls are counted"):
        got = found(neighbours.near_vectors(frame(vectors.items()), rounds=1))
    assert got == plain(vectors) and sum(n for n, _ in got.values()) >= 20


def test_one_dense_group_is_counted_exactly_without_pair_rows(spark, frame, monkeypatch):
    """Cosines around 0.92 between all of 1,600 vectors, which no ball can hold, and a far group beside them."""
    vectors = clouds(3, [0.295], 1600, 64) | {5000 + i: v for i, v in clouds(4, [0.2, 1.0], 40, 64).items()}
    stores, real = {}, neighbours.stored

    def watched(df, label):
        out = real(df, label)
        stores[label] = out.count()
        return out

    monkeypatch.setattr(neighbours, "stored", watched)
    exact = plain(vectors)
    assert 0.1 < sum(n for n, _ in exact.values()) / 1600**2 < 0.95
    assert found(neighbours.near_vectors(frame(vectors.items()))) == exact
    # Lists, counts and all else: rows in proportion to the vectors, where the pairs are 1.28 million.
    assert max(n for label, n in stores.items()) < 1.5 * neighbours.NEAREST * 1700


def test_whole_counting_when_no_round_reaches_the_target(spark, frame):
    vectors = clouds(5, (0.1, 0.3, 0.35), 60)
    with pytest.warns(UserWarning, match="all balls are counted"):
        got = found(neighbours.near_vectors(frame(vectors.items()), recall=1.1, rounds=1))
    assert got == plain(vectors)
