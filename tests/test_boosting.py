"""Boosting against a plain numpy booster with the same bins, and its awkward inputs."""
import math

import numpy as np
import pytest

from reelkit.operators import boosting
from reelkit.operators.evaluate import accuracy
from reelkit.operators.mining import boosted_classifier, boosted_predictions, feature_importance

SCHEMA = "id long, label string, features array<double>"


def plain(rows, rounds, depth, rate, bins, ridge=1.0):
    """Raw scores of all rows after the last round, and the gain by feature."""
    x = np.array([r[2] for r in rows])
    n, d = x.shape
    classes = sorted({r[1] for r in rows})
    y = np.array([classes.index(r[1]) for r in rows])
    edges = []
    for j in range(d):
        s = sorted(x[:, j])
        edges.append(sorted({s[max(1, math.ceil(i / bins * n)) - 1] for i in range(1, bins)}))
    b = np.array([[sum(e < v for e in edges[j]) for j, v in enumerate(row)] for row in x])
    share = np.log(np.bincount(y) / n)
    f = np.tile(share if len(classes) > 2 else share[1:] - share[:1], (n, 1))
    gained, scale = np.zeros(d), 1 << 20
    for _ in range(rounds):
        if f.shape[1] > 1:
            e = np.exp(f - f.max(axis=1, keepdims=True))
            p, hit = e / e.sum(axis=1, keepdims=True), y[:, None] == np.arange(len(classes))
        else:
            p, hit = 1 / (1 + np.exp(-f)), (y == 1)[:, None]
        g, h = np.floor((p - hit) * scale + 0.5) / scale, np.floor(p * (1 - p) * scale + 0.5) / scale
        add = np.zeros_like(f)
        for k in range(f.shape[1]):
            def grow(rows_in, level):
                gs, hs = g[rows_in, k].sum(), h[rows_in, k].sum()
                best = (0.0, None)
                for j in range(d):
                    for t in range(len(edges[j])):
                        left = rows_in[b[rows_in, j] <= t]
                        if 0 < len(left) < len(rows_in):
                            gl, hl = g[left, k].sum(), h[left, k].sum()
                            gain = gl * gl / (hl + ridge) + (gs - gl) * (gs - gl) / (hs - hl + ridge) - gs * gs / (hs + ridge)
                            if gain > best[0]:
                                best = (gain, (j, t))
                if level == depth or best[1] is None:
                    add[rows_in, k] = -gs / (hs + ridge) * rate
                    return
                gained[best[1][0]] += best[0]
                go = b[rows_in, best[1][0]] <= best[1][1]
                grow(rows_in[go], level + 1)
                grow(rows_in[~go], level + 1)
            grow(np.arange(n), 0)
        f = f + add
    return f, gained / gained.sum()


@pytest.mark.parametrize("classes", [2, 3])
def test_against_plain_booster(spark, classes):
    rng = np.random.default_rng(classes)
    x = np.round(rng.normal(size=(90, 4)), 1)  # ties within features
    label = np.where(x[:, 0] + x[:, 1] * x[:, 2] > 0.3, "b", "a")
    if classes == 3:
        label = np.where(x[:, 3] > 0.8, "c", label)
    rows = [(i, str(v), row.tolist()) for i, (v, row) in enumerate(zip(label, x, strict=True))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = boosting.fit(df, rounds=4, depth=3, rate=0.4, bins=8)
    want, gained = plain(rows, 4, 3, 0.4, 8)
    from pyspark.sql import functions as F
    got = {r.id: r.raw for r in df.select("id", F.array(*model.raw(F.col("features"))).alias("raw")).collect()}
    assert np.allclose([got[i] for i in range(90)], want, atol=1e-9)
    assert np.allclose(model.importance(4), gained)
    p = df.select(F.array(*model.probabilities(F.col("features"))).alias("p")).collect()
    assert all(abs(sum(r.p) - 1) < 1e-12 for r in p)
    hit = accuracy(boosted_predictions(df, model)).first().accuracy
    assert hit > 0.9
    assert feature_importance(model, 4).importance.tolist() == sorted(model.importance(4), reverse=True)


def test_same_fit_whatever_the_partitions(spark):
    rows = [(i, "ab"[i * i % 7 > 3], [float(i * 37 % 101), float(i % 10)]) for i in range(300)]
    a = boosting.fit(spark.createDataFrame(rows, SCHEMA).repartition(1), rounds=3)
    b = boosting.fit(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), rounds=3)
    assert a == b


def test_one_class_no_rows_nulls(spark):
    assert boosting.fit(spark.createDataFrame([], SCHEMA)).classes == []
    one = boosting.fit(spark.createDataFrame([(1, "a", [1.0]), (2, "a", [2.0]), (3, None, [9.0])], SCHEMA))
    assert one.classes == ["a"] and not one.rounds
    rows = [(i, "ab"[i % 2], [float(i % 2) if i % 3 else None, 5.0, math.nan if i % 2 else 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = boosting.fit(df, rounds=2)
    assert [r.prediction for r in boosted_predictions(df, model).orderBy("id").collect()] == [r[1] for r in rows]
    assert boosted_predictions(df.filter("id < 0"), model).count() == 0


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 3, (3, 6))
    rows = [(i, f"c{i % 3}", (centres[i % 3] + rng.normal(size=6)).tolist()) for i in range(400)]
    pred, model = boosted_classifier(spark.createDataFrame(rows, SCHEMA), max_iter=6)
    assert accuracy(pred).first().accuracy > 0.9 and len(model.rounds) == 6
