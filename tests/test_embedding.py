"""Spectral embedding against numpy on the given vectors, two moons, few points."""
import numpy as np
from pyspark.sql import functions as F

from reelkit.operators import embedding, mining
from reelkit.operators.embedding import spectral_embedding
from reelkit.session import cut_lineage
from reelkit.sources import generators, proxy

SCHEMA = "id long, features array<double>, label string"


def test_subspace_agrees_with_numpy(spark):
    g = cut_lineage(mining.knn_graph(proxy.vectors(spark, "/root/testdata/sf0.01"), 10))
    e, values = spectral_embedding(g, 3)
    links = g.collect()
    place = {p: i for i, p in enumerate(sorted({r.src for r in links}))}
    w = np.zeros((len(place), len(place)))
    for r in links:
        w[place[r.src], place[r.dst]] += r.weight
    scale = 1 / np.sqrt(w.sum(axis=1))
    true, vecs = np.linalg.eigh(scale[:, None] * w * scale)
    assert np.allclose(values, true[::-1][:3], atol=1e-4)
    got = np.zeros((len(place), 3))
    for r in e.collect():
        got[place[r.id]] = [r.e0, r.e1, r.e2]
    assert np.allclose(got.T @ got, np.eye(3), atol=1e-6)
    assert np.linalg.svd(vecs[:, ::-1][:, :3].T @ got)[1].min() > 0.999  # cosines of the angles between both spaces


def test_small_blocks_with_weights_and_a_hub(spark, monkeypatch):
    monkeypatch.setattr(embedding, "TERMS", 8)
    rng = np.random.default_rng(3)
    w = np.triu(rng.random((40, 40)) * (rng.random((40, 40)) < 0.1), 1)
    w[0, 1:] += 0.3  # linked with all
    w += w.T
    links = [(5 * int(i) - 50, 5 * int(j) - 50, float(w[i, j])) for i, j in zip(*np.nonzero(w), strict=True)]
    links = spark.createDataFrame(links + links[:7], "src long, dst long, weight double")
    for i, j in np.argwhere(w)[:7]:
        w[i, j] *= 2
    back = spark.createDataFrame([(r.dst, r.src, r.weight) for r in links.collect()], links.schema)
    e, values = spectral_embedding(links.unionByName(back), 2, rounds=12, tolerance=1e-6, block_rows=7)
    w += w.T
    scale = 1 / np.sqrt(w.sum(axis=1))
    true, vecs = np.linalg.eigh(scale[:, None] * w * scale)
    got = np.array([[r.e0, r.e1] for r in sorted(e.collect())])
    assert got.shape == (40, 2) and np.allclose(values, true[::-1][:2], atol=1e-8)
    assert np.allclose(np.abs(got.T @ vecs[:, ::-1][:, :2]), np.eye(2), atol=1e-5)


def test_a_product_shuffles_neither_links_nor_terms(spark):
    links = cut_lineage(spark.range(60).selectExpr("id as src", "(id + 1) % 60 as dst", "1d as weight").selectExpr(
        "inline(array(struct(src, dst, weight), struct(dst as src, src as dst, weight)))"))
    points = links.groupBy(F.col("src").alias("id")).agg(F.lit(0.5).alias("scale"), F.max(F.col("src").cast("double")).alias("x0"))
    cells = embedding._cells(links, 4)
    state = cut_lineage(embedding._start(points, 4, 1))
    after = embedding._times(cells, state, lambda p, x, y: (x, y, None))
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "CartesianProduct" in plan and plan.count("Exchange hashpartitioning(blk") == 2
    got = {r.id: r.e0 for r in embedding._unpacked(after, np.eye(1), 1).collect()}
    assert got == {i: 0.25 * ((i - 1) % 60 + (i + 1) % 60) for i in range(60)}


def test_two_moons_are_parted(spark):
    moons = generators.moons(spark, 200).select("id", F.array("x", "y").alias("features"), F.col("label").cast("string").alias("label"))
    got = mining.spectral(moons, 2).join(moons.select("id", "label"), "id").groupBy("cluster", "label").count().collect()
    assert len(got) == 2 and sum(r["count"] for r in got) == 200


def test_few_points(spark):
    one = spark.createDataFrame([(7, [1.0, 2.0], "a")], SCHEMA)
    assert [(r.id, r.cluster) for r in mining.spectral(one, 2).collect()] == [(7, 2)]
    assert mining.spectral(one.limit(0), 2).count() == 0
    two = spark.createDataFrame([(7, [1.0, 2.0], "a"), (8, [1.0, 2.5], "b")], SCHEMA)
    assert {r.id for r in mining.spectral(two, 2).collect()} == {7, 8}
