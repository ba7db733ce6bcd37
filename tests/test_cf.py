import math

import numpy as np
from pyspark.sql import functions as F

from reelkit.operators import cf

RATINGS = [  # (rating_id, user, movie, rating); (1, 10) rated twice -> averaged cell
    ("a", 1, 10, 5), ("b", 1, 11, 3), ("c", 1, 10, 4), ("d", 2, 10, 4), ("e", 2, 12, 2),
    ("f", 3, 11, 1), ("g", 3, 12, 5), ("h", 4, 13, 3), ("i", 5, 10, 2), ("j", 5, 11, 4)]
SCHEMA = "rating_id string, user_id long, movie_id long, rating int"


def _dense(rows):
    cells = {}
    for _, u, m, r in rows:
        cells.setdefault((u, m), []).append(r)
    users = sorted({u for u, _ in cells})
    movies = sorted({m for _, m in cells})
    mat = np.zeros((len(users), len(movies)))
    for (u, m), rs in cells.items():
        mat[users.index(u), movies.index(m)] = np.mean(rs)
    return users, movies, mat, cells


def test_split_invariants(spark):
    rows = [(f"r{u}-{i}", u, i, 1 + (u * i) % 5) for u in range(1, 40) for i in range(u % 7 + 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    s = cf.stratified_split(df)
    assert s.count() == df.count()
    assert s.select("rating_id").distinct().count() == df.count()
    per = s.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t"))
    for r in per.collect():
        assert r.t == math.floor(0.25 * r.n + 0.5)


def test_single_rating_users_dropped_unless_none_qualify(spark):
    df = spark.createDataFrame(RATINGS, SCHEMA)
    kept = cf.drop_single_rating_users(df)
    assert {r.user_id for r in kept.select("user_id").distinct().collect()} == {1, 2, 3, 5}
    solo = spark.createDataFrame([("x", 1, 1, 3), ("y", 2, 1, 4)], SCHEMA)
    assert cf.drop_single_rating_users(solo).count() == 2


def test_cosine_and_wmean_against_numpy(spark):
    df = spark.createDataFrame(RATINGS, SCHEMA)
    users, movies, mat, cells = _dense(RATINGS)
    norms = np.linalg.norm(mat, axis=1)
    sim = mat @ mat.T / np.outer(norms, norms)
    got = {(r.u, r.v): r.sim for r in cf.user_cosine(cf.cell_means(df)).collect()}
    for i, u in enumerate(users):
        for j, v in enumerate(users):
            if sim[i, j] > 0:
                assert abs(got[(u, v)] - sim[i, j]) < 1e-12
            else:
                assert (u, v) not in got
    pairs = spark.createDataFrame([("p1", 4, 10), ("p2", 3, 10), ("p3", 1, 99)], "rating_id string, user_id long, movie_id long")
    pred = {r.rating_id: r.pred for r in cf.predict_user_wmean(df, pairs).collect()}
    # user 4 shares no movie with anyone -> zero total weight -> 3.0
    assert pred["p1"] == 3.0
    assert pred["p3"] == 3.0          # unseen movie
    m = movies.index(10)
    raters = [k for k in range(len(users)) if mat[k, m] > 0]
    i3 = users.index(3)
    want = sum(sim[i3, k] * mat[k, m] for k in raters) / sum(sim[i3, k] for k in raters)
    assert abs(pred["p2"] - want) < 1e-12


def test_knn_against_brute_force(spark):
    df = spark.createDataFrame(RATINGS, SCHEMA)
    users, movies, mat, cells = _dense(RATINGS)
    pairs = spark.createDataFrame([("p", 3, 10), ("q", 4, 12)], "rating_id string, user_id long, movie_id long")
    pred = {r.rating_id: r.pred for r in cf.predict_knn(df, pairs, k=2).collect()}

    def msd_sim(u, v):
        common = [m for m in movies if (u, m) in cells and (v, m) in cells]
        if not common:
            return 0.0
        d = np.mean([(np.mean(cells[(u, m)]) - np.mean(cells[(v, m)])) ** 2 for m in common])
        return 1.0 / (d + 1.0)

    nb = sorted([(msd_sim(3, v), -v, np.mean(cells[(v, 10)])) for v in users if (v, 10) in cells], reverse=True)
    nb = [x for x in nb if x[0] > 0][:2]
    want = sum(s * r for s, _, r in nb) / sum(s for s, _, _ in nb)
    assert abs(pred["p"] - want) < 1e-12
    mu = np.mean([r for *_, r in RATINGS])
    assert abs(pred["q"] - mu) < 1e-12       # no co-rater -> global mean


def test_demographic_fallbacks(spark):
    df = spark.createDataFrame(RATINGS, SCHEMA)
    users = spark.createDataFrame([(1, "M", "x"), (2, "F", "y"), (3, "M", "y"), (5, "M", "x")],
                                  "user_id long, sex string, occupation string")
    pairs = spark.createDataFrame([("p", 3, 10), ("q", 2, 11), ("r", 9, 10)], "rating_id string, user_id long, movie_id long")
    g = {r.rating_id: r.pred for r in cf.predict_gender(df, pairs, users).collect()}
    assert g["p"] == (5 + 4 + 2) / 3 and g["q"] == 3.0 and g["r"] == 3.0
    go = {r.rating_id: r.pred for r in cf.predict_gender_occupation(df, pairs, users).collect()}
    assert go["p"] == g["p"]          # no (M, y) rating of movie 10 -> gender mean


def test_knn_cross_validation_equals_fold_by_fold(spark):
    from reelkit.operators.evaluate import rmse
    rng = np.random.default_rng(4)
    rows = [(f"{u}-{i}-{c}", u, i, float(rng.integers(1, 6))) for u in range(30) for i in range(20) for c in range(2)
            if rng.random() < (0.5 if c == 0 else 0.1)]
    df = spark.createDataFrame(rows, "rating_id string, user_id long, movie_id long, rating double")
    got = {r.fold: (r.n, r.rmse) for r in cf.cross_validate_knn(df, 3, k=5).collect()}
    keyed = df.withColumn("fold", cf.cell_fold(3))
    for f in range(3):
        test = keyed.filter(F.col("fold") == f).drop("fold")
        want = rmse(cf.predict_knn(keyed.filter(F.col("fold") != f).drop("fold"), test, k=5)).first()
        assert got[f][0] == want.n and abs(got[f][1] - want.rmse) < 1e-9
    assert cf.cross_validate_knn(df.limit(0), 3).count() == 0


def test_python_scorer(spark):
    from reelkit.operators.evaluate import python_scorer, score_model
    from reelkit.plans.hybrid import predict_candidates
    df = spark.createDataFrame([(f"r{i}", i % 4, i, float(i % 5 + 1)) for i in range(50)], "rating_id string, user_id long, movie_id long, rating double")
    scorer = python_scorer(lambda pdf: [None if m == 7 else 1.0 + m % 3 for m in pdf["movie_id"]])
    got = {r.rating_id: r.pred for r in scorer(df.repartition(5)).collect()}
    assert got == {f"r{i}": 3.0 if i == 7 else 1.0 + i % 3 for i in range(50)}
    assert score_model("mine", scorer(df)).first().n == 50 and scorer(df.limit(0)).count() == 0
    cands = df.select("user_id", F.col("movie_id").alias("dst_id"))
    assert {r.dst_id: r.est for r in predict_candidates(cands, scorer).collect()}[8] == 3.0


def test_predictions_from_the_pairs_asked_equal_those_from_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = [(f"{u}-{i}-{c}", u, i, float(rng.integers(0, 6))) for u in range(25) for i in range(18) for c in range(2)
            if rng.random() < (0.4 if c == 0 else 0.1) or (c == 0 and i == 0)]       # movie 0 is everyone's
    rows += [("z1", 90, 0, 0.0), ("z2", 90, 1, 0.0)]                                # a user of norm zero
    df = spark.createDataFrame(rows, "rating_id string, user_id long, movie_id long, rating double")
    asked = [(f"p{u}-{i}", u, i) for u in (2, 3, 7, 90, 555) for i in (0, 1, 5, 17, 777)]
    pairs = spark.createDataFrame(asked, "rating_id string, user_id long, movie_id long")
    users, movies, mat, cells = _dense([(k, u, m, r) for k, u, m, r in rows])
    norms = np.linalg.norm(mat, axis=1)
    got = {r.rating_id: r.pred for r in cf.predict_user_wmean(df, pairs, target=3, by="movies").collect()}
    again = {r.rating_id: r.pred for r in cf.predict_user_wmean(df, pairs, target=3, by="users", few_users=True).collect()}
    assert all(abs(got[k] - again[k]) < 1e-9 for k in got) and len(got) == len(again) == len(asked)
    for key, u, i in asked:
        raters = [v for v in users if (v, i) in cells]
        sims = {v: mat[users.index(u)] @ mat[users.index(v)] / (norms[users.index(u)] * norms[users.index(v)])
                for v in raters if u in users and norms[users.index(u)] * norms[users.index(v)] > 0}
        den = sum(sims.values())
        want = sum(s * np.mean(cells[(v, i)]) for v, s in sims.items()) / den if den else 3.0
        assert abs(got[key] - want) < 1e-9, key

    few, every = cf.user_pair_stats(cf.cell_means(df), 3, pairs.select("user_id").distinct()), cf.user_pair_stats(cf.cell_means(df))
    ask = {2, 3, 7, 90, 555}
    want = {(r.u, r.v): (r.n_common, r.dot, r.sqd) for r in every.collect() if r.u == r.v or {r.u, r.v} & ask}
    found = few.collect()
    assert {(r.u, r.v): (r.n_common, r.dot, r.sqd) for r in found}.keys() == want.keys() and len(found) == len(want)
    assert all(np.allclose(want[(r.u, r.v)], (r.n_common, r.dot, r.sqd)) for r in found)
    full = {r.rating_id: r.pred for r in cf.predict_knn(df, pairs, stats=every).collect()}
    assert all(abs(full[r.rating_id] - r.pred) < 1e-9 for r in cf.predict_knn(df, pairs, few_users=True).collect())


def test_co_rated_meets_only_the_raters_asked_for(spark):
    rng = np.random.default_rng(12)
    rows = [(f"{u}-{i}-{c}", u, i, float(rng.integers(0, 6))) for u in range(20) for i in range(15) for c in range(2)
            if rng.random() < (0.3 if c == 0 else 0.1)] + [("n", None, 3, 2.0)]
    df = spark.createDataFrame(rows, "rating_id string, user_id long, movie_id long, rating double")
    cells = cf.cell_means(df)
    pairs = spark.createDataFrame([("p", 3, 1), ("p2", 3, 1), ("q", 4, 2), ("r", 99, 2), ("s", None, 2)],
                                  "rating_id string, user_id long, movie_id long")
    r = {(x.user_id, x.movie_id): x.r for x in cells.collect()}
    stats = {(x.u, x.v): x for x in cf.user_pair_stats(cells).collect()}
    norm = {u: math.sqrt(stats[(u, u)].dot) for u in range(20) if (u, u) in stats}
    for target in (2000, 2):
        rows = cf.co_rated(cells, pairs, target=target).collect()
        got = {(x.user_id, x.movie_id, x.v): x for x in rows}
        want = {(u, m, v) for u, m in ((3, 1), (4, 2)) for v in range(20) if (v, m) in r and (u, v) in stats}
        assert got.keys() == want and len(rows) == len(want) > 4
        for (u, m, v), x in got.items():
            s = stats[(u, v)]
            assert (x.n_common, x.r_v) == (s.n_common, r[(v, m)]) and abs(x.sqd - s.sqd) < 1e-9
            assert abs((x.sim or 0.0) - (s.dot / (norm[u] * norm[v]) if norm[u] * norm[v] else 0.0)) < 1e-12


def test_pairs_of_users_are_shuffled_once_for_cosines(spark):
    df = spark.createDataFrame(RATINGS, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cf.user_cosine(cf.cell_means(df))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the sizes of movies (once a side) and the co-rating itself, but no join above the pairs' aggregate
    assert "Join" not in plan[:plan.index("Aggregate")]


def test_weighted_mean_of_null_ratings(spark):
    rows = [("a", 1, 10, 4.0), ("b", 2, 10, 4.0), ("c", 2, 11, None), ("d", 3, 11, 5.0), ("e", 2, 12, None)]
    df = spark.createDataFrame(rows, "rating_id string, user_id long, movie_id long, rating double")
    pairs = spark.createDataFrame([("p", 1, 11), ("q", 1, 12)], "rating_id string, user_id long, movie_id long")
    # user 3 weighs zero, but knows movie 11; nobody's rating of movie 12 is known
    assert {r.rating_id: r.pred for r in cf.predict_user_wmean(df, pairs, by="users").collect()} == {"p": 0.0, "q": 3.0}
