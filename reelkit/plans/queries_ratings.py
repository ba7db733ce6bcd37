"""Catalogue entries: ratings aggregates, split, predictors R7-R12/R21, V7, E3-E9."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelkit.operators import cf, evaluate
from reelkit.plans.catalog import W, r6, register
from reelkit.session import cut_lineage
from reelkit.sources import proxy

# --------------------------------------------------------------------------
# shared Spark pieces
# --------------------------------------------------------------------------


def _split(spark, sf_dir):
    return cf.stratified_split(cf.drop_single_rating_users(proxy.ratings(spark, sf_dir)))


def _train_test(spark, sf_dir):
    """The split is read by many branches (cells, norms, pair statistics, test
    pairs) and by several models, so it is written once to the checkpoint dir."""
    s = cut_lineage(_split(spark, sf_dir))
    cols = ["rating_id", "user_id", "movie_id", "rating"]
    return s.filter(~F.col("is_test")).select(*cols), s.filter(F.col("is_test")).select(*cols)


def _pred_out(df):
    return df.select("rating_id", r6("pred").alias("pred"))


# --------------------------------------------------------------------------
# shared SQL pieces
# --------------------------------------------------------------------------

SPLIT_SQL = W("ratings", "users") + """
, ucnt AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)
, kept AS (SELECT r.* FROM ratings r JOIN ucnt USING (user_id)
           WHERE ucnt.n >= 2 OR NOT EXISTS (SELECT 1 FROM ucnt WHERE n >= 2))
, ranked AS (
    SELECT kept.*,
           row_number() OVER (PARTITION BY user_id
               ORDER BY md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(movie_id AS VARCHAR),
                                      CAST(rating_id AS VARCHAR), '42')), rating_id) AS pos,
           count(*) OVER (PARTITION BY user_id) AS cnt
    FROM kept)
, split AS (SELECT rating_id, user_id, movie_id, rating, pos <= floor(0.25 * cnt + 0.5) AS is_test
            FROM ranked)
, train AS (SELECT rating_id, user_id, movie_id, rating FROM split WHERE NOT is_test)
, test AS (SELECT rating_id, user_id, movie_id, rating FROM split WHERE is_test)
, cells AS (SELECT user_id, movie_id, avg(rating) AS r FROM train GROUP BY user_id, movie_id)
, pstats AS (SELECT a.user_id AS u, b.user_id AS v, count(*) AS n_common,
                    sum(a.r * b.r) AS dot, sum((a.r - b.r) * (a.r - b.r)) AS sqd
             FROM cells a JOIN cells b ON a.movie_id = b.movie_id GROUP BY 1, 2)
, norms AS (SELECT user_id, sqrt(sum(r * r)) AS norm FROM cells GROUP BY user_id)
"""

PRED_SQL = {
    "Baseline": """
, pred{s} AS (SELECT rating_id, CAST(3.0 AS DOUBLE) AS pred FROM test)""",
    "User-based CF (Mean)": """
, mm{s} AS (SELECT movie_id, avg(r) AS movie_mean FROM cells GROUP BY movie_id)
, pred{s} AS (SELECT t.rating_id, coalesce(mm{s}.movie_mean, 3.0) AS pred
           FROM test t LEFT JOIN mm{s} USING (movie_id))""",
    "User-based CF (Weighted Mean)": """
, sims{s} AS (SELECT p.u, p.v, p.dot / (nu.norm * nv.norm) AS sim
           FROM pstats p JOIN norms nu ON nu.user_id = p.u JOIN norms nv ON nv.user_id = p.v)
, cand{s} AS (SELECT t.rating_id, coalesce(s.sim, 0.0) AS w, c.r AS r_v
           FROM test t JOIN cells c ON c.movie_id = t.movie_id
           LEFT JOIN sims{s} s ON s.u = t.user_id AND s.v = c.user_id)
, agg{s} AS (SELECT rating_id, sum(w * r_v) AS num, sum(w) AS den FROM cand{s} GROUP BY rating_id)
, pred{s} AS (SELECT t.rating_id, coalesce(CASE WHEN agg{s}.den <> 0 THEN agg{s}.num / agg{s}.den END, 3.0) AS pred
           FROM test t LEFT JOIN agg{s} USING (rating_id))""",
    "Gender-based CF": """
, prof{s} AS (SELECT t.*, u.sex, u.occupation FROM train t JOIN users u USING (user_id))
, gm{s} AS (SELECT movie_id, sex, avg(rating) AS g_mean FROM prof{s} GROUP BY movie_id, sex)
, pred{s} AS (SELECT t.rating_id, coalesce(gm{s}.g_mean, 3.0) AS pred
           FROM test t LEFT JOIN users u USING (user_id)
           LEFT JOIN gm{s} ON gm{s}.movie_id = t.movie_id AND gm{s}.sex = u.sex)""",
    "Gender and Occupation based CF": """
, prof{s} AS (SELECT t.*, u.sex, u.occupation FROM train t JOIN users u USING (user_id))
, gm{s} AS (SELECT movie_id, sex, avg(rating) AS g_mean FROM prof{s} GROUP BY movie_id, sex)
, gom{s} AS (SELECT movie_id, sex, occupation, avg(rating) AS go_mean FROM prof{s}
          GROUP BY movie_id, sex, occupation)
, pred{s} AS (SELECT t.rating_id, coalesce(gom{s}.go_mean, gm{s}.g_mean, 3.0) AS pred
           FROM test t LEFT JOIN users u USING (user_id)
           LEFT JOIN gom{s} ON gom{s}.movie_id = t.movie_id AND gom{s}.sex = u.sex AND gom{s}.occupation = u.occupation
           LEFT JOIN gm{s} ON gm{s}.movie_id = t.movie_id AND gm{s}.sex = u.sex)""",
    "kNN Basic": """
, msd{s} AS (SELECT u, v, 1.0 / (sqd / n_common + 1.0) AS sim FROM pstats)
, cand{s} AS (SELECT t.rating_id, c.user_id AS v, c.r AS r_v, m.sim
           FROM test t JOIN cells c ON c.movie_id = t.movie_id
           JOIN msd{s} m ON m.u = t.user_id AND m.v = c.user_id WHERE m.sim > 0)
, topk{s} AS (SELECT * FROM (SELECT cand{s}.*, row_number() OVER (PARTITION BY rating_id
                                 ORDER BY sim DESC, v) AS rk FROM cand{s}) WHERE rk <= 40)
, agg{s} AS (SELECT rating_id, sum(sim * r_v) AS num, sum(sim) AS den, count(*) AS k
          FROM topk{s} GROUP BY rating_id)
, mu{s} AS (SELECT avg(rating) AS mu FROM train)
, pred{s} AS (SELECT t.rating_id,
                  least(5.0, greatest(1.0, coalesce(CASE WHEN agg{s}.k >= 1 THEN agg{s}.num / agg{s}.den END,
                                                    mu{s}.mu))) AS pred
           FROM test t LEFT JOIN agg{s} USING (rating_id) CROSS JOIN mu{s})""",
}

ITEM_KNN_SQL = """
, inorm AS (SELECT movie_id, sqrt(sum(r * r)) AS norm FROM cells GROUP BY movie_id)
, istats AS (SELECT a.movie_id AS i, b.movie_id AS j, sum(a.r * b.r) AS dot
             FROM cells a JOIN cells b ON a.user_id = b.user_id GROUP BY 1, 2)
, isim AS (SELECT i, j, dot / (ni.norm * nj.norm) AS sim
           FROM istats JOIN inorm ni ON ni.movie_id = i JOIN inorm nj ON nj.movie_id = j)
, cand AS (SELECT t.rating_id, s.sim, c.r AS r_j
           FROM test t JOIN cells c ON c.user_id = t.user_id
           JOIN isim s ON s.i = t.movie_id AND s.j = c.movie_id)
, agg AS (SELECT rating_id, sum(sim * r_j) AS num, sum(sim) AS den FROM cand GROUP BY rating_id)
, pred AS (SELECT t.rating_id, coalesce(CASE WHEN agg.den <> 0 THEN agg.num / agg.den END, 3.0) AS pred
           FROM test t LEFT JOIN agg USING (rating_id))"""

PRED_OUT = "\nSELECT rating_id, round(pred, 6) AS pred FROM pred"


def _spark_predict(name, train, test, users, met=None):
    if name == "Baseline":
        return cf.predict_constant(train, test)
    if name == "User-based CF (Mean)":
        return cf.predict_movie_mean(train, test)
    if name == "User-based CF (Weighted Mean)":
        return cf.predict_user_wmean(train, test, met)
    if name == "Gender-based CF":
        return cf.predict_gender(train, test, users)
    if name == "Gender and Occupation based CF":
        return cf.predict_gender_occupation(train, test, users)
    if name == "kNN Basic":
        return cf.predict_knn(train, test, met=met)
    raise KeyError(name)


def _register_predictor(key, name):
    @register(key, SPLIT_SQL + PRED_SQL[name].format(s="") + PRED_OUT)
    def q(spark, sf_dir):
        train, test = _train_test(spark, sf_dir)
        return _pred_out(_spark_predict(name, train, test, proxy.users(spark, sf_dir)))
    return q


_register_predictor("R7_baseline_predictions", "Baseline")
_register_predictor("R8_movie_mean_predictions", "User-based CF (Mean)")
_register_predictor("R9_user_wmean_predictions", "User-based CF (Weighted Mean)")
_register_predictor("R10_gender_predictions", "Gender-based CF")
_register_predictor("R11_gender_occupation_predictions", "Gender and Occupation based CF")
_register_predictor("R12_knn_predictions", "kNN Basic")


@register("R21_item_knn_predictions", SPLIT_SQL + ITEM_KNN_SQL + PRED_OUT)
def r21_item_knn(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _pred_out(cf.predict_item_knn(train, test))


# --------------------------------------------------------------------------
# split, metrics, leaderboard
# --------------------------------------------------------------------------

@register("E1_stratified_split", SPLIT_SQL + "\nSELECT rating_id, is_test FROM split")
def e1_split(spark, sf_dir):
    return _split(spark, sf_dir).select("rating_id", "is_test")


@register("E2_random_split", W("ratings") + """
SELECT rating_id, CAST('0x' || substr(md5(concat_ws('-', CAST(rating_id AS VARCHAR), '42')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE
                  < 0.25 AS is_test FROM ratings""")
def e2_split(spark, sf_dir):
    return cf.random_split(proxy.ratings(spark, sf_dir), "rating_id").select("rating_id", "is_test")


def _results_spark(spark, sf_dir, models):
    train, test = _train_test(spark, sf_dir)
    users = proxy.users(spark, sf_dir)
    # one co-rating table, of the test pairs' own raters, serves both the weighted mean and kNN
    met = cut_lineage(cf.co_rated(cf.cell_means(train), test))
    parts = [evaluate.score_model(m, _spark_predict(m, train, test, users, met)) for m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _results_sql(models):
    ctes = "".join(PRED_SQL[m].format(s=i) for i, m in enumerate(models))
    fam = evaluate.MODEL_FAMILY
    sel = "\nUNION ALL ".join(
        f"SELECT '{m}' AS model, '{fam[m]}' AS family, sqrt(avg((t.rating - p.pred) * (t.rating - p.pred))) AS rmse,"
        f" count(*) AS n FROM test t JOIN pred{i} p USING (rating_id)"
        for i, m in enumerate(models))
    return SPLIT_SQL + ctes + f"\n, results AS ({sel})\n"


LEADER_MODELS = ["Baseline", "User-based CF (Mean)", "User-based CF (Weighted Mean)",
                 "Gender-based CF", "Gender and Occupation based CF", "kNN Basic"]


@register("E6_leaderboard", _results_sql(LEADER_MODELS) + """
SELECT model, family, round(rmse, 6) AS rmse, n,
       row_number() OVER (ORDER BY rmse, model) AS position,
       row_number() OVER (ORDER BY rmse, model) = 1 AS is_best
FROM results""")
def e6_leaderboard(spark, sf_dir):
    lb = evaluate.leaderboard(_results_spark(spark, sf_dir, LEADER_MODELS))
    return lb.select("model", "family", r6("rmse").alias("rmse"), "n",
                     F.col("position").cast("bigint").alias("position"), "is_best")


@register("E6_leaderboard_svd", None)
def e6_leaderboard_svd(spark, sf_dir):
    """The whole leaderboard, with the factorisation that no SQL can fit."""
    from reelkit.plans import hybrid
    train, test = _train_test(spark, sf_dir)
    users = proxy.users(spark, sf_dir)
    met = cut_lineage(cf.co_rated(cf.cell_means(train), test))
    out = evaluate.score_model("SVD", hybrid.predict_svd(train, test))
    for m in LEADER_MODELS:
        out = out.unionByName(evaluate.score_model(m, _spark_predict(m, train, test, users, met)))
    results = cut_lineage(out)
    board = evaluate.leaderboard(results).select("model", F.lit(None).cast("string").alias("insight"), r6("rmse").alias("value"),
                                                 F.col("position").cast("bigint").alias("position"))
    said = evaluate.insights(results).select("model", "insight", r6("value").alias("value"), F.lit(None).cast("bigint").alias("position"))
    return board.unionByName(said)


@register("E7_insights", _results_sql(LEADER_MODELS) + """
, agg AS (SELECT arg_min(model, rmse) AS best_model, min(rmse) AS best,
                 arg_max(model, rmse) AS worst_model, max(rmse) AS worst,
                 min(rmse) FILTER (WHERE model = 'Baseline') AS base,
                 min(rmse) FILTER (WHERE model = 'User-based CF (Mean)') AS mean_,
                 min(rmse) FILTER (WHERE model = 'User-based CF (Weighted Mean)') AS wmean,
                 min(rmse) FILTER (WHERE model = 'Gender-based CF') AS gen,
                 min(rmse) FILTER (WHERE model = 'Gender and Occupation based CF') AS genocc,
                 min(rmse) FILTER (WHERE model = 'SVD') AS svd,
                 min(rmse) FILTER (WHERE model = 'kNN Basic') AS knn
          FROM results)
, tidy AS (
    SELECT 'best_model' AS insight, best_model AS model, best AS value FROM agg
    UNION ALL SELECT 'worst_model', worst_model, worst FROM agg
    UNION ALL SELECT 'improvement_over_baseline_pct', NULL, (base - best) / base * 100 FROM agg
    UNION ALL SELECT 'weighted_mean_improved', NULL, CAST(wmean <= mean_ AS DOUBLE) FROM agg
    UNION ALL SELECT 'occupation_improved', NULL, CAST(genocc < gen AS DOUBLE) FROM agg
    UNION ALL SELECT 'svd_beats_knn', NULL, CAST(svd < knn AS DOUBLE) FROM agg
    UNION ALL SELECT 'svd_within_10pct_of_best', NULL, CAST(svd <= best * 1.1 AS DOUBLE) FROM agg
    UNION ALL SELECT 'worst_over_1_5x_best', NULL, CAST(worst > best * 1.5 AS DOUBLE) FROM agg
    UNION ALL SELECT 'best_in_cf', arg_min(model, rmse), min(rmse) FROM results WHERE model LIKE '%CF%' AND model LIKE '%based%' HAVING count(*) > 0
    UNION ALL SELECT 'best_in_demographic', arg_min(model, rmse), min(rmse) FROM results WHERE model LIKE '%Gender%' OR model LIKE '%Occupation%' HAVING count(*) > 0
    UNION ALL SELECT 'best_in_model', arg_min(model, rmse), min(rmse) FROM results WHERE model LIKE '%kNN%' OR model LIKE '%SVD%' HAVING count(*) > 0
    UNION ALL SELECT 'best_in_baseline', arg_min(model, rmse), min(rmse) FROM results WHERE model = 'Baseline' HAVING count(*) > 0)
SELECT insight, model, round(value, 6) AS value FROM tidy""")
def e7_insights(spark, sf_dir):
    ins = evaluate.insights(_results_spark(spark, sf_dir, LEADER_MODELS))
    return ins.select("insight", "model", r6("value").alias("value"))


@register("E9_precision_recall_at_k", SPLIT_SQL + PRED_SQL["User-based CF (Mean)"].format(s="") + """
, recs AS (SELECT t.user_id, t.movie_id, row_number() OVER (PARTITION BY t.user_id
               ORDER BY p.pred DESC, t.movie_id, t.rating_id) AS rank
           FROM test t JOIN pred p USING (rating_id))
, relevant AS (SELECT DISTINCT user_id, movie_id FROM test WHERE rating >= 4)
, hits AS (SELECT r.user_id, count(*) AS hits FROM recs r JOIN relevant USING (user_id, movie_id)
           WHERE r.rank <= 5 GROUP BY r.user_id)
, per_user AS (SELECT rel.user_id, coalesce(h.hits, 0) AS hits, rel.n_rel
               FROM (SELECT user_id, count(*) AS n_rel FROM relevant GROUP BY user_id) rel
               LEFT JOIN hits h USING (user_id))
SELECT round(avg(hits / 5.0), 6) AS precision_at_k, round(avg(hits / n_rel), 6) AS recall_at_k,
       count(*) AS users FROM per_user""")
def e9_precision_recall(spark, sf_dir):
    from reelkit.operators.relational import top_n_per_group
    train, test = _train_test(spark, sf_dir)
    scored = cf.predict_movie_mean(train, test)
    recs = top_n_per_group(scored, "user_id", [F.desc("pred"), F.asc("movie_id"), F.asc("rating_id")], 5)
    relevant = test.filter(F.col("rating") >= 4).select("user_id", "movie_id").distinct()
    out = evaluate.precision_recall_at_k(recs.select("user_id", "movie_id", "rank"), relevant, 5)
    return out.select(r6("precision_at_k").alias("precision_at_k"), r6("recall_at_k").alias("recall_at_k"),
                      "users")


# --------------------------------------------------------------------------
# aggregates over the ratings
# --------------------------------------------------------------------------

@register("A2_distinct_counts", W("ratings") + """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies, count(*) AS n_ratings
FROM ratings""")
def a2_distinct(spark, sf_dir):
    r = proxy.ratings(spark, sf_dir)
    return r.agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct("movie_id").alias("n_movies"),
                 F.count(F.lit(1)).alias("n_ratings"))


@register("A9_user_movie_means", W("ratings") + """
SELECT user_id, movie_id, round(avg(rating), 6) AS r FROM ratings GROUP BY user_id, movie_id""")
def a9_cells(spark, sf_dir):
    c = cf.cell_means(proxy.ratings(spark, sf_dir))
    return c.select("user_id", "movie_id", r6("r").alias("r"))


@register("A11_movie_means", W("ratings") + """
, cells AS (SELECT user_id, movie_id, avg(rating) AS r FROM ratings GROUP BY user_id, movie_id)
SELECT movie_id, round(avg(r), 6) AS movie_mean FROM cells GROUP BY movie_id""")
def a11_movie_means(spark, sf_dir):
    m = cf.movie_means(cf.cell_means(proxy.ratings(spark, sf_dir)))
    return m.select("movie_id", r6("movie_mean").alias("movie_mean"))


@register("A8_movie_sex_mean", W("ratings", "users") + """
SELECT r.movie_id, u.sex, round(avg(r.rating), 6) AS mean_rating, count(*) AS n
FROM ratings r JOIN users u USING (user_id) GROUP BY r.movie_id, u.sex""")
def a8_movie_sex(spark, sf_dir):
    j = proxy.ratings(spark, sf_dir).join(proxy.users(spark, sf_dir), "user_id")
    return (j.groupBy("movie_id", "sex")
             .agg(r6(F.avg("rating")).alias("mean_rating"), F.count(F.lit(1)).alias("n")))


@register("A10_sex_occupation_movie_mean", W("ratings", "users") + """
SELECT r.movie_id, u.sex, u.occupation, round(avg(r.rating), 6) AS mean_rating
FROM ratings r JOIN users u USING (user_id) GROUP BY r.movie_id, u.sex, u.occupation""")
def a10_sex_occ(spark, sf_dir):
    j = proxy.ratings(spark, sf_dir).join(proxy.users(spark, sf_dir), "user_id")
    return j.groupBy("movie_id", "sex", "occupation").agg(r6(F.avg("rating")).alias("mean_rating"))


@register("J1_ratings_users_join", W("ratings", "users") + """
SELECT u.sex, u.occupation, count(*) AS n_ratings, count(DISTINCT r.user_id) AS n_users,
       round(avg(r.rating), 6) AS mean_rating
FROM ratings r JOIN users u USING (user_id) GROUP BY u.sex, u.occupation""")
def j1_ratings_users(spark, sf_dir):
    j = proxy.ratings(spark, sf_dir).join(proxy.users(spark, sf_dir), "user_id")
    return j.groupBy("sex", "occupation").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.countDistinct("user_id").alias("n_users"),
        r6(F.avg("rating")).alias("mean_rating"))


@register("F6_users_with_two_ratings", W("ratings") + """
, ucnt AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)
, kept AS (SELECT r.* FROM ratings r JOIN ucnt USING (user_id)
           WHERE ucnt.n >= 2 OR NOT EXISTS (SELECT 1 FROM ucnt WHERE n >= 2))
SELECT user_id, count(*) AS n FROM kept GROUP BY user_id""")
def f6_min_ratings(spark, sf_dir):
    kept = cf.drop_single_rating_users(proxy.ratings(spark, sf_dir))
    return kept.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@register("V7_user_cosine", W("ratings") + """
, cells AS (SELECT user_id, movie_id, avg(rating) AS r FROM ratings GROUP BY user_id, movie_id)
, norms AS (SELECT user_id, sqrt(sum(r * r)) AS norm FROM cells GROUP BY user_id)
, dots AS (SELECT a.user_id AS u, b.user_id AS v, sum(a.r * b.r) AS dot
           FROM cells a JOIN cells b ON a.movie_id = b.movie_id GROUP BY 1, 2)
, sims AS (SELECT d.u, d.v, d.dot / (nu.norm * nv.norm) AS sim
           FROM dots d JOIN norms nu ON nu.user_id = d.u JOIN norms nv ON nv.user_id = d.v)
SELECT u AS user_id, count(*) FILTER (WHERE v <> u) AS n_neighbours,
       round(sum(sim) FILTER (WHERE v <> u), 6) AS sim_sum,
       round(max(sim) FILTER (WHERE v <> u), 6) AS sim_max,
       round(max(sim) FILTER (WHERE v = u), 6) AS self_sim
FROM sims GROUP BY u""")
def v7_user_cosine(spark, sf_dir):
    sims = cf.user_cosine(cf.cell_means(proxy.ratings(spark, sf_dir)))
    other = F.col("v") != F.col("u")
    return sims.groupBy(F.col("u").alias("user_id")).agg(
        F.count(F.when(other, 1)).alias("n_neighbours"),
        r6(F.sum(F.when(other, F.col("sim")))).alias("sim_sum"),
        r6(F.max(F.when(other, F.col("sim")))).alias("sim_max"),
        r6(F.max(F.when(~other, F.col("sim")))).alias("self_sim"))


# --------------------------------------------------------------------------
# cross-validation of the neighbourhood model (E5), a Python predictor
# --------------------------------------------------------------------------

FOLD_SQL = W("ratings") + """
, ucnt AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)
, folded AS MATERIALIZED (
    SELECT r.*, CAST('0x' || substr(md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(movie_id AS VARCHAR), '42')), 1, 8) AS BIGINT) % 3 AS fold
    FROM ratings r JOIN ucnt USING (user_id) WHERE ucnt.n >= 2 OR NOT EXISTS (SELECT 1 FROM ucnt WHERE n >= 2))
, fcells AS MATERIALIZED (SELECT user_id, movie_id, fold, avg(rating) AS r FROM folded GROUP BY user_id, movie_id, fold)
"""


def _fold_sql(f: int) -> str:
    """One fold's test rows, neighbours and predictions, from its own training cells."""
    knn = PRED_SQL["kNN Basic"].format(s=f).replace("FROM pstats", f"FROM pstats{f}").replace("FROM test ", f"FROM test{f} ")
    knn = knn.replace("JOIN cells c", f"JOIN cells{f} c").replace("FROM train", f"FROM folded WHERE fold <> {f}")
    return f"""
, test{f} AS (SELECT * FROM folded WHERE fold = {f})
, cells{f} AS (SELECT * FROM fcells WHERE fold <> {f})
, pstats{f} AS (SELECT a.user_id AS u, b.user_id AS v, count(*) AS n_common, sum((a.r - b.r) * (a.r - b.r)) AS sqd
                FROM cells{f} a JOIN cells{f} b ON a.movie_id = b.movie_id AND a.user_id <> b.user_id GROUP BY 1, 2)""" + knn


@register("E5_knn_cross_validation", FOLD_SQL + "".join(map(_fold_sql, range(3))) + "\n" + "\nUNION ALL ".join(
    f"SELECT {f} AS fold, round(sqrt(avg((t.rating - p.pred) * (t.rating - p.pred))), 6) AS rmse, count(*) AS n"
    f" FROM test{f} t JOIN pred{f} p USING (rating_id) HAVING count(*) > 0" for f in range(3)))
def e5_knn(spark, sf_dir):
    ratings = cf.drop_single_rating_users(proxy.ratings(spark, sf_dir)).select("rating_id", "user_id", "movie_id", "rating")
    return cf.cross_validate_knn(ratings, 3).select("fold", r6("rmse").alias("rmse"), "n")


def _parity_predictor(pdf):
    """A predictor that SQL can repeat: by the ids' sum, and silent about every seventh movie."""
    guess = 2.0 + (pdf["user_id"] + 3 * pdf["movie_id"]) % 5 / 2.0
    return guess.where(pdf["movie_id"] % 7 != 0)


@register("Y4_python_predictor", SPLIT_SQL + """
, scored AS (SELECT rating, CASE WHEN movie_id % 7 = 0 THEN 3.0::DOUBLE ELSE 2.0::DOUBLE + (user_id + 3 * movie_id) % 5 / 2.0::DOUBLE END AS pred FROM test)
SELECT 'Python' AS model, 'other' AS family, round(sqrt(avg((rating - pred) * (rating - pred))), 6) AS rmse, count(*) AS n FROM scored""")
def y4_python_predictor(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    scored = evaluate.python_scorer(_parity_predictor)(test)
    return evaluate.score_model("Python", scored).select("model", "family", r6("rmse").alias("rmse"), "n")
