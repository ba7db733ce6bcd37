"""The neighbour graph on the given vectors, copies, few points, odd vectors and small blocks."""
import numpy as np

from reelkit.operators import neighbours
from reelkit.sources import proxy

SCHEMA = "id long, features array<double>, label string"


def exact(x, n):
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def test_recall_on_the_given_vectors(spark):
    v = proxy.vectors(spark, "/root/testdata/sf0.01").select("id", "features").collect()
    x = np.array([r.features for r in v])
    g = neighbours.neighbour_graph(spark.createDataFrame([(r.id, r.features, "") for r in v], SCHEMA), 10).collect()
    got = {}
    for r in g:
        got.setdefault(r.src, set()).add(r.dst)
    near = exact(x, 10)
    hits = sum(len(got[v[i].id] & {v[j].id for j in near[i]}) for i in range(len(v)))
    assert all(len(s) == 10 for s in got.values()) and hits >= 0.95 * 10 * len(v)


def test_copies_and_few_points(spark):
    rows = [(i, [0.0, 0.0], "a") for i in range(30)] + [(100 + i, [9.0, 9.0], "b") for i in range(25)] + [(3, [0.0, 0.0], "a")]
    got = neighbours.neighbour_graph(spark.createDataFrame(rows, SCHEMA), 5).collect()
    assert all((r.src < 100) == (r.dst < 100) and r.dist == 0 and r.src != r.dst for r in got) and len(got) == 55 * 5
    assert neighbours.neighbour_graph(spark.createDataFrame(rows[:1], SCHEMA), 5).count() == 0
    assert neighbours.neighbour_graph(spark.createDataFrame([], SCHEMA), 5).count() == 0


def test_small_blocks_are_exact_and_move_no_vectors_again(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PAIRS", 100)
    monkeypatch.setattr(neighbours, "SIDE_BY_SIDE", 16)
    rng = np.random.default_rng(4)
    x = np.vstack([rng.integers(0, 3, (60, 3)), rng.normal(size=(60, 3)), [[np.nan, 0, 0], [np.inf, 0, 0]]]).astype(float)
    rows = [(i * 7, v.tolist(), "a") for i, v in enumerate(x)] + [(9999, None, "a"), (None, [0.0, 0.0, 0.0], "a"), (9998, [None, 0.0, 0.0], "a")]
    got = neighbours.neighbour_graph(spark.createDataFrame(rows, SCHEMA), 6, block_rows=17)
    d = ((x[:120, None] - x[None, :120]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :6]
    assert sorted(map(tuple, got.collect())) == sorted((i * 7, int(j) * 7, d[i, j]) for i in range(120) for j in near[i])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Join Cross" in plan.replace("Join Inner", "Join Cross") and "collect_list" not in plan


def test_nearest_meets_blocks_in_any_cut():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, (300, 5)).astype(float)
    near = exact(x, 7)
    found = neighbours._Nearest(np.arange(300), x, 7)
    for at in range(0, 300, 41):
        found.meet(np.arange(300)[at:at + 41], x[at:at + 41])
    assert found.dst.reshape(300, 7).tolist() == near.tolist()
