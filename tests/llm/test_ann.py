"""Graph search: recall against brute force, copies, ties and rows that take no part."""
import numpy as np

from reelkit.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank string, score string, vec string"


def brute(rows, k):
    ok = {i: np.array(v, float) for i, v in rows if v is not None and i is not None and None not in v
          and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, v in ok.items():
        if q % 20 == 0:
            near = sorted((-float(np.dot(v, y)), i) for i, y in ok.items() if i != q and len(y) == len(v))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    got = {}
    for r in sorted(ann.nearest(df, df.filter("vec_id % 20 = 0"), **kw).collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def test_recall_on_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    got, want = run(spark, rows, shard_rows=128, query_rows=10), brute(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    by_pair = {(q, i): s for q, v in want.items() for i, s in v}
    assert all(abs(by_pair.get((q, i), s) - s) < 1e-12 for q, v in got.items() for i, s in v)


def test_norms_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32) * (1 + i % 5)]) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 700)]  # a large group of equal vectors
    rows += [(None, [1.0] * 8), (701, None), (702, [0.0] * 8), (703, [float("nan")] * 8), (704, [1.0, None] * 4),
             (705, []), (720, [float("inf")] * 8), (740, [2.0, 1.0]), (741, [1.0, 1.0]), (0, rows[0][1])]
    got, want = run(spark, rows, shard_rows=100), brute(rows, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert [i for i, _ in got[320]] == [i for i, _ in want[320]] and [i for i, _ in got[740]] == [741]


def test_few_and_none(spark):
    assert run(spark, [(20, [1.0, 0.0]), (3, [0.5, 0.5])]) == {20: [(3, 0.5)]}
    assert run(spark, [(20, [1.0, 0.0])]) == {}
    assert run(spark, []) == {}


def test_equal_scores_go_to_the_smallest_ids(spark):
    # 60 distinct vectors of one inner product with the query; the beam finds all of them
    rows = [(20, [1.0, 0.0, 0.0])] + [(100 + i, [0.5, 0.01 * i, -0.02 * i]) for i in range(60)]
    assert [i for i, _ in run(spark, rows)[20]] == list(range(100, 120))


def test_repeated_ids_whatever_the_partitions(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [0.5, 0.5]), (3, [2.0, 0.25]), (4, [1.0, 1.0]), (4, [0.25, 3.0])]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    for parts in (1, 2, 5):
        some = df.repartition(parts)
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(some, some.filter("vec_id % 20 = 0")).collect())
        assert got == [(20, 1, 4, 3.0), (20, 2, 3, 0.5)], parts
