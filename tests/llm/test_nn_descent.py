"""Linked vectors against brute force."""

import numpy as np
import pytest

from brindle.llm import nn_descent


def brute(rows, threshold=0.93):
    good = [(i, np.array(v, np.float64), g) for i, v, g in rows if i is not None and g is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    root = {i: i for i, _, _ in rows if i is not None}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for label in {(g, len(v)) for _, v, g in good}:
        ids = np.array([i for i, v, g in good if (g, len(v)) == label])
        unit = np.stack([v / np.linalg.norm(v) for _, v, g in good if (g, len(v)) == label])
        for k, i in enumerate(ids):
            for j in ids[unit @ unit[k] >= threshold]:
                if i != j:
                    links[i] += 1
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return {i: (links[i], find(i)) for i in root}


def around(rng, centre, n, noise):
    return [(centre + noise * rng.standard_normal(len(centre))).tolist() for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_links_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        for size in (300, 40, 12, 5, 2, 2, 2):
            rows += [(v, label) for v in around(rng, rng.standard_normal(24), size, 0.15)]
        rows += [(rng.standard_normal(24).tolist(), label) for _ in range(400)]
    rows += [(rows[0][0], 0)] * 30 + [(rows[3][0], 2)]
    rows = [(int(i), v, g) for i, (v, g) in zip(rng.permutation(len(rows)), rows, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(df).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) >= 0.97


def test_tables(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.op7_nn_descent(spark, "/root/testdata/sf0.01").collect()}
    assert got == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [1.0, 0.0], None), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1e-200, 0.0], 1), (12, [1.0, 0.0], 2)]
    df = spark.createDataFrame([*rows, (None, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nn_descent.linked(df).collect()}
    assert got.pop(None) == (0, None, True)
    assert got == {i: (2, 1, i == 1) if i in (1, 2, 11) else (0, i, True) for i, _, _ in rows}
    assert nn_descent.linked(df.limit(0)).count() == 0


def test_repeated_rows_and_ids(spark):
    """A row that stands twice is one vector; of an id's different vectors one stands for it."""
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 1), (3, [0.0, 2.0], 1), (4, [1.0, 0.0], 2), (4, [0.6, 0.8], 2), (5, [1.0, 0.0], 2), (6, [0.6, 0.8], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [(r.vec_id, r.n_links, r.component_id) for r in nn_descent.linked(df).collect()]
    assert sorted(got)[:5] == [(1, 0, 1), (1, 0, 1), (2, 1, 2), (3, 1, 2), (3, 1, 2)]
    assert sorted(got)[5:7] == [(4, 1, 4), (4, 1, 4)] and sorted(n for i, n, _ in got if i in (5, 6)) == [0, 1]


def test_an_audit_that_cannot_pass_ends_in_whole_comparison(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_start", lambda nodes, k, turn=0: nodes.selectExpr("id", "id as other", "cast(-1 as double) as sim", "true as new").where("false"))
    rng = np.random.default_rng(13)
    rows = [(i, v, i % 2) for i, v in enumerate(v for _ in range(60) for v in around(rng, rng.standard_normal(16), 4, 0.1))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(df).collect()}
    assert got == brute(rows)


def test_large_components_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "ROWS", 64)
    rng = np.random.default_rng(4)
    rows = [(i, v, 1) for i, v in enumerate(around(rng, rng.standard_normal(16), 400, 0.2))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(df).collect()}
    want = brute(rows)
    assert np.mean([got[i] == want[i] for i in want]) >= 0.97


def test_a_label_does_not_lose_links_beside_a_large_one(spark):
    rng = np.random.default_rng(8)
    pair = lambda: around(rng, rng.standard_normal(48), 2, 0.24)
    rows = [(v, 1) for _ in range(100) for v in pair()] + [(rng.standard_normal(48).tolist(), 0) for _ in range(12_000)]
    df = spark.createDataFrame([(i, v, g) for i, (v, g) in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(df, audit=0).where("vec_id < 200").collect()}
    assert got == brute([(i, v, g) for i, (v, g) in enumerate(rows[:200])])


def test_every_node_has_a_full_start_list(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(32), i % 50 == 0) for i in range(6000)]
    nodes = spark.createDataFrame([(i, int(g), (v / np.linalg.norm(v)).tobytes(), 120 if g else 5880) for i, v, g in rows], "id long, space long, vec binary, size long")
    lists = nn_descent._lists(nn_descent._start(nodes, 8), 8).selectExpr("id", "size(near) as n").collect()
    assert len(lists) == 6000 and min(r.n for r in lists) == 8


def test_a_lost_link_beside_a_dense_component_is_mended(spark, monkeypatch):
    start = nn_descent._start
    monkeypatch.setattr(nn_descent, "_start", lambda nodes, *rest: start(nodes, *rest).where("id % 3 = 0 and other % 3 = 0"))
    rng = np.random.default_rng(10)
    rows = [(v, 1) for v in around(rng, rng.standard_normal(24), 700, 0.1)]
    rows += [(v, 1) for _ in range(200) for v in around(rng, rng.standard_normal(24), 2, 0.1)]
    rows = [(i, v, g) for i, (v, g) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(df, rounds=1).collect()}
    assert got == brute(rows)


def test_search_and_audit_by_label(spark):
    rng = np.random.default_rng(12)
    rows = [(v, g) for g in range(2) for _ in range(400) for v in around(rng, rng.standard_normal(24), 3, 0.1)]
    rows = [(i, v, g) for i, (v, g) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(df).collect()}
    want = brute(rows)
    assert np.mean([got[i] == want[i] for i in want]) >= 0.97
