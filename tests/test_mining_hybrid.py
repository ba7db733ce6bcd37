import numpy as np
from pyspark.sql import functions as F

from reelkit.operators import mining
from reelkit.operators.evaluate import insights, leaderboard, rmse
from reelkit.plans import hybrid
from reelkit.sources import generators


def _vectors(spark):
    b = generators.blobs(spark, 300, centers=3, std=0.5, seed=1)
    return b.select("id", F.array("x", "y", (F.col("x") * 0.5 + F.col("y"))).alias("features"), "label")


def test_standardize_and_centroid_functions(spark):
    v = _vectors(spark)
    pdf = v.toPandas()
    x = np.vstack(pdf.features.to_numpy())
    z = mining.standardize(v).toPandas().sort_values("id")
    want = (x - x.mean(0)) / x.std(0)
    got = np.vstack(z.features.to_numpy())
    assert np.allclose(got, want[np.argsort(pdf.id.to_numpy())])
    cs = mining.centroid_similarity(v).toPandas().set_index("id")
    r = pdf.iloc[0]
    cen = x[pdf.label.to_numpy() == r.label].mean(0)
    a = np.array(r.features)
    assert abs(cs.loc[r.id, "euclidean"] - np.linalg.norm(a - cen)) < 1e-9
    assert abs(cs.loc[r.id, "cosine"] - a @ cen / np.linalg.norm(a) / np.linalg.norm(cen)) < 1e-9
    assert abs(cs.loc[r.id, "pearson"] - np.corrcoef(a, cen)[0, 1]) < 1e-9


def test_pca_lda_kmeans(spark):
    v = _vectors(spark)
    proj, explained = mining.pca(v, 2)
    ratios = [r.ratio for r in explained.collect()]
    x = np.vstack(v.toPandas().features.to_numpy())
    z = (x - x.mean(0)) / x.std(0)
    ev = np.sort(np.linalg.eigvalsh(np.cov(z.T, bias=True)))[::-1]
    assert np.allclose(ratios, ev[:2] / ev.sum())
    assert proj.count() == 300
    assert mining.linear_discriminant(v, 2).count() == 300
    assigned, centres, cost = mining.kmeans(v, 3, seed=0)
    ct = assigned.groupBy("label", "cluster").count().collect()
    assert len(ct) == 3            # blobs recovered up to a permutation
    el = mining.elbow(v, max_k=4).orderBy("k").collect()
    assert el[0].inertia > el[2].inertia
    assert all(a.inertia >= b.inertia for a, b in zip(el, el[1:], strict=False))
    assert abs(el[0].inertia - ((x - x.mean(0)) ** 2).sum()) < 1e-6 * el[0].inertia
    assert el[2].inertia <= cost * 1.05
    assert [r.k for r in mining.elbow(v.limit(2), max_k=4).collect()] == [1, 2, 3, 4] and mining.elbow(v.limit(0)).count() == 0


def test_biased_mf_beats_constant(spark):
    rng = np.random.default_rng(0)
    p, q = rng.normal(size=(60, 3)), rng.normal(size=(40, 3))
    rows = [(f"{u}-{i}", u, i, float(np.clip(3 + p[u] @ q[i], 1, 5)))
            for u in range(60) for i in range(40) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "rating_id string, user_id long, movie_id long, rating double")
    train, test = df.filter(F.hash("rating_id") % 4 != 0), df.filter(F.hash("rating_id") % 4 == 0)
    pred = hybrid.predict_svd(train, test, rank=3, max_iter=15, reg=0.05)
    model_rmse = rmse(pred).first().rmse
    const = rmse(test.withColumn("pred", F.lit(3.0))).first().rmse
    assert model_rmse < const
    assert pred.filter((F.col("pred") < 1) | (F.col("pred") > 5)).count() == 0


def test_leaderboard_and_insights(spark):
    res = spark.createDataFrame([("Baseline", "baseline", 1.4, 10), ("SVD", "model", 1.0, 10),
                                 ("kNN Basic", "model", 1.2, 10)], "model string, family string, rmse double, n long")
    lb = {r.model: (r.position, r.is_best) for r in leaderboard(res).collect()}
    assert lb["SVD"] == (1, True) and lb["Baseline"][0] == 3
    ins = {r.insight: (r.model, r.value) for r in insights(res).collect()}
    assert ins["best_model"] == ("SVD", 1.0)
    assert abs(ins["improvement_over_baseline_pct"][1] - (0.4 / 1.4 * 100)) < 1e-9
    assert ins["svd_beats_knn"][1] == 1.0


def test_hybrid_rank(spark):
    scored = spark.createDataFrame([(1, "t", 5, 0.9, 1.0), (1, "t", 6, 0.1, 5.0), (1, "t", 7, None, 4.0)],
                                   "user_id long, title string, dst_id long, similarity double, est double")
    out = hybrid.hybrid_rank(scored, 2).orderBy("rank").collect()
    assert [r.dst_id for r in out] == [5, 6]   # 0.9+1/5 == 0.1+5/5: tie -> smaller id


def test_top_unrated_for_user(spark):
    ratings = spark.createDataFrame([(1, 10, 5), (1, 11, 1), (2, 12, 4), (2, 13, 2), (3, 13, 5)],
                                    "user_id long, movie_id long, rating int")
    cat = spark.createDataFrame([(10, "a"), (11, "b"), (12, "c"), (13, "d"), (14, "e")], "id long, title string")
    out = hybrid.top_unrated_for_user(1, ratings, cat, hybrid.movie_mean_scorer(ratings), n=2).collect()
    assert [r.movie_id for r in out] == [12, 13]      # 14 has no ratings -> NULL pred sorts last


def test_id_mapping_with_and_without_links(spark):
    meta = spark.createDataFrame([("862", "Toy Story"), ("949", "Heat"), ("tt1", "Bad")], "id string, title string")
    links = spark.createDataFrame([(1, "862.0"), (2, "949")], "movieId int, tmdbId string")
    m = {r.movieId: r.id for r in hybrid.id_mapping(meta, links).collect()}
    assert m == {1: "862", 2: "949"}
    numbered = {r.id: r.movieId for r in hybrid.id_mapping(meta).collect()}
    assert numbered == {"862": 1, "949": 2}


def test_spectral_keeps_far_points(spark):
    from reelkit.operators.mining import spectral
    rows = [(i, [float(i % 7) * 0.01 + (0.0 if i < 20 else 50.0), float(i % 3) * 0.01], "a") for i in range(40)]
    rows += [(100, [90_000.0, -70_000.0], "a")]
    df = spark.createDataFrame(rows, "id long, features array<double>, label string")
    got = {r.id: r.cluster for r in spectral(df, k=2, n_neighbors=5).collect()}
    assert set(got) == {r[0] for r in rows}


def test_top_unrated_for_all_users(spark):
    from reelkit.plans.hybrid import top_unrated
    items = [(m, f"t{m}", float(m * 7 % 5)) for m in range(12)]
    rated = [(1, m) for m in range(9)] + [(2, 3), (2, 3)] + [(3, m) for m in range(12)]
    got = top_unrated(spark.createDataFrame([(u,) for u in (1, 2, 3, 4)], "user_id long"), spark.createDataFrame(rated, "user_id long, movie_id long"),
                      spark.createDataFrame(items, "movie_id long, title string, pred double"), 4).collect()
    for u in (1, 2, 3, 4):
        own = {m for v, m in rated if v == u}
        want = [m for m, _, _ in sorted((x for x in items if x[0] not in own), key=lambda x: (-x[2], x[0]))][:4]
        assert [r.movie_id for r in sorted(got, key=lambda r: r["rank"]) if r.user_id == u] == want
