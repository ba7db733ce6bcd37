"""The factorisation machine: its identity, held-out accuracy on the given labels, and awkward rows."""
import itertools
import zlib

import numpy as np

from reelkit.llm import quality

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.WIDTH), rng.normal(size=(quality.WIDTH, quality.FACTORS)))
    rows = [quality.features(t, ["source=a"]) for t in ("one two three", "", "THE!! THE!! ***", "é | é | ü\nx")]
    for (slots, x), got in zip(rows, m.score(rows), strict=True):
        z = m.bias + sum(m.weights[i] * a for i, a in zip(slots, x)) + sum(
            m.factors[i] @ m.factors[j] * a * b for (i, a), (j, b) in itertools.combinations(zip(slots, x), 2))
        assert abs(got - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    out = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(r.predicted == q for r, q in out) >= 0.95 * len(out)
    assert sum(r.predicted for r, q in out if q) >= 0.98 * sum(q for _, q in out)


SCHEMA = "doc_id long, text string, score string, label string, slots int"
LABELS = "doc_id long, quality int, toxic int"


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "w " * 60_000), (5, "x"), (5, "x")]
    docs = spark.createDataFrame([(i, t, "s", "l", 0) for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, 1, 0), (5, 0, 0), (None, 1, 0), (4, None, 0), (99, 1, 1)], LABELS)
    got = quality.classify(docs, labels).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3, 4, 5, 5]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = quality.classify(docs, spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert quality.classify(spark.createDataFrame([], SCHEMA), labels).count() == 0
    assert sorted(map(str, quality.classify(docs, labels).collect())) == sorted(map(str, got))
