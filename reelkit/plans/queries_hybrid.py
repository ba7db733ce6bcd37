"""Catalogue entries: hybrid (R17, R18, R22) and factorisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelkit.operators import cf, evaluate
from reelkit.plans import content, hybrid
from reelkit.plans.catalog import W, r6, register
from reelkit.plans.queries_content import PAIRS_SQL, SOUP_BODY, SOUP_VIEWS, _soups
from reelkit.plans.queries_ratings import SPLIT_SQL, _train_test
from reelkit.sources import proxy

HYBRID_BASE_SQL = W("ratings", *SOUP_VIEWS) + SOUP_BODY + PAIRS_SQL + """
, firsts AS (SELECT title, min(id) AS id FROM soups WHERE title IS NOT NULL GROUP BY title)
, cells AS (SELECT user_id, movie_id, avg(rating) AS r FROM ratings GROUP BY user_id, movie_id)
, mm AS (SELECT movie_id, avg(r) AS est FROM cells GROUP BY movie_id)
, fav AS (SELECT user_id, movie_id FROM (
             SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id
                    ORDER BY rating DESC, movie_id) AS rk FROM ratings) WHERE rk = 1)
, req AS (SELECT DISTINCT f.user_id, s.title FROM fav f JOIN soups s ON s.id = f.movie_id)
, cand AS (SELECT r.user_id, r.title, e.dst_id, e.similarity
           FROM req r JOIN firsts f USING (title) JOIN ranked e ON e.src_id = f.id AND e.rank <= 25)
, scored AS (SELECT c.*, coalesce(mm.est, 3.0) AS est FROM cand c LEFT JOIN mm ON mm.movie_id = c.dst_id)
"""


def _hybrid_inputs(spark, sf_dir):
    soups = _soups(spark, sf_dir)
    catalogue = soups.select("id", "title")
    edges = content.metadata_similarity(soups, top=25)
    ratings = proxy.ratings(spark, sf_dir)
    requests = hybrid.favourite_titles(ratings, catalogue)
    return ratings, catalogue, edges, requests


@register("R18_hybrid_recommend", HYBRID_BASE_SQL + """
, top AS (SELECT *, similarity + est / 5.0 AS hybrid_score,
                 row_number() OVER (PARTITION BY user_id, title
                                    ORDER BY round(similarity + est / 5.0, 9) DESC, dst_id) AS rank
          FROM scored)
SELECT user_id, title, rank, dst_id, round(similarity, 6) AS similarity, round(est, 6) AS est,
       round(hybrid_score, 6) AS hybrid_score FROM top WHERE rank <= 10""")
def r18_hybrid(spark, sf_dir):
    ratings, catalogue, edges, requests = _hybrid_inputs(spark, sf_dir)
    cands = hybrid.candidates(requests, catalogue, edges, 25)
    scored = hybrid.predict_candidates(cands, hybrid.movie_mean_scorer(ratings))
    top = hybrid.hybrid_rank(scored, 10)
    return top.select("user_id", "title", F.col("rank").cast("bigint").alias("rank"), "dst_id",
                      r6("similarity").alias("similarity"), r6("est").alias("est"),
                      r6("hybrid_score").alias("hybrid_score"))


@register("R17_predict_candidates", HYBRID_BASE_SQL + """
SELECT user_id, title, dst_id, round(est, 6) AS est FROM scored""")
def r17_predict(spark, sf_dir):
    ratings, catalogue, edges, requests = _hybrid_inputs(spark, sf_dir)
    cands = hybrid.candidates(requests, catalogue, edges, 25)
    scored = hybrid.predict_candidates(cands, hybrid.movie_mean_scorer(ratings))
    return scored.select("user_id", "title", "dst_id", r6("est").alias("est"))


@register("R22_blends", HYBRID_BASE_SQL + """
, nr AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)
SELECT s.user_id, s.title, s.dst_id,
       round(0.7 * s.similarity + 0.3 * s.est / 5.0, 6) AS weighted_score,
       round(CASE WHEN coalesce(nr.n, 0) < 40 THEN s.similarity ELSE s.est / 5.0 END, 6) AS switching_score
FROM scored s LEFT JOIN nr USING (user_id)""")
def r22_blends(spark, sf_dir):
    ratings, catalogue, edges, requests = _hybrid_inputs(spark, sf_dir)
    cands = hybrid.candidates(requests, catalogue, edges, 25)
    scored = hybrid.predict_candidates(cands, hybrid.movie_mean_scorer(ratings))
    nr = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    out = scored.join(nr, "user_id", "left")
    return out.select("user_id", "title", "dst_id",
                      r6(hybrid.weighted_blend(F.col("similarity"), F.col("est"), 0.7)).alias("weighted_score"),
                      r6(hybrid.switching_blend(F.col("similarity"), F.col("est"), F.col("n"), 40))
                      .alias("switching_score"))


@register("R15_top_unrated", W("ratings", "movies") + """
, cells AS (SELECT user_id, movie_id, avg(rating) AS r FROM ratings GROUP BY user_id, movie_id)
, mm AS (SELECT movie_id, avg(r) AS est FROM cells GROUP BY movie_id)
, items AS (SELECT m.id AS movie_id, m.title, coalesce(mm.est, 3.0) AS pred FROM movies m LEFT JOIN mm ON mm.movie_id = m.id)
, ranked AS (SELECT u.user_id, i.*, row_number() OVER (PARTITION BY u.user_id ORDER BY round(i.pred, 9) DESC, i.movie_id) AS rank
             FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN items i
             WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = u.user_id AND r.movie_id = i.movie_id))
SELECT user_id, rank, movie_id, title, round(pred, 6) AS pred FROM ranked WHERE rank <= 5""")
def r15_top_unrated(spark, sf_dir):
    from reelkit.plans.queries_charts import movies
    ratings = proxy.ratings(spark, sf_dir)
    mean = cf.movie_means(cf.cell_means(ratings))
    items = (movies(spark, sf_dir).select(F.col("id").alias("movie_id"), "title").join(mean, "movie_id", "left")
             .withColumn("pred", F.coalesce("movie_mean", F.lit(3.0))))
    out = hybrid.top_unrated(ratings.select("user_id"), ratings, items, 5)
    return out.select("user_id", F.col("rank").cast("bigint").alias("rank"), "movie_id", "title", r6("pred").alias("pred"))


# ------------------------------------------------------------------ factorisation (rows-only)

@register("R13_svd_predictions", None)
def r13_svd(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    pred = hybrid.predict_svd(train, test)
    return pred.select("rating_id", r6("pred").alias("pred"))


BIAS_SQL = """
, mu AS (SELECT avg(rating) AS mu FROM train)
, bi AS (SELECT movie_id, sum(rating - mu.mu) / (count(*) + 5.0) AS b_i FROM train CROSS JOIN mu GROUP BY movie_id)
, bu AS (SELECT user_id, sum(rating - mu.mu - b_i) / (count(*) + 5.0) AS b_u
         FROM train JOIN bi USING (movie_id) CROSS JOIN mu GROUP BY user_id)
, pred AS (SELECT rating_id, rating, least(5.0, greatest(1.0, mu.mu + coalesce(b_u, 0) + coalesce(b_i, 0))) AS pred
           FROM test LEFT JOIN bu USING (user_id) LEFT JOIN bi USING (movie_id) CROSS JOIN mu)
"""


@register("R13_bias_predictions", SPLIT_SQL + BIAS_SQL + "SELECT rating_id, round(pred, 6) AS pred FROM pred")
def r13_biases(spark, sf_dir):
    """The model without factors: its biases alone, which SQL can repeat."""
    train, test = _train_test(spark, sf_dir)
    return hybrid.predict_svd(train, test, rank=0).select("rating_id", r6("pred").alias("pred"))


@register("R15_personal_top_unrated", None)
def r15_personal(spark, sf_dir):
    from reelkit.plans.queries_charts import movies
    ratings = proxy.ratings(spark, sf_dir)
    items = movies(spark, sf_dir).select(F.col("id").alias("movie_id"), "title")
    out = hybrid.top_unrated_personal(ratings.select("user_id"), ratings, items, hybrid.fit_biased_mf(ratings, rank=16, max_iter=5), 5)
    return out.select("user_id", F.col("rank").cast("bigint").alias("rank"), "movie_id", "title", r6("pred").alias("pred"))


@register("E4_svd_rmse", None)
def e4_svd_rmse(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return evaluate.score_model("SVD", hybrid.predict_svd(train, test))


@register("E5_cross_validation", None)
def e5_cross_validation(spark, sf_dir):
    ratings = cf.drop_single_rating_users(proxy.ratings(spark, sf_dir))
    return hybrid.cross_validate(ratings, folds=3)


@register("R18_hybrid_svd", None)
def r18_hybrid_svd(spark, sf_dir):
    ratings, catalogue, edges, requests = _hybrid_inputs(spark, sf_dir)
    model = hybrid.fit_biased_mf(ratings)
    cands = hybrid.candidates(requests, catalogue, edges, 25)
    scored = hybrid.predict_candidates(cands, model.predict)
    return hybrid.hybrid_rank(scored, 10).select("user_id", "title", "rank", "dst_id", "hybrid_score")
