"""Catalogue entries: catalogue cleaning, charts (R1-R3) and their operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelkit.functions.clean import (title_year, to_bigint_id, to_date, to_double, to_int_or_zero,
                                     year_int, year_string)
from reelkit.functions.scores import weighted_rating
from reelkit.operators.relational import (exact_quantile, exact_quantiles, filter_at_least_quantile, frequency,
                                          sample_per_group, scalar, surrogate_id, top_n)
from reelkit.plans.catalog import W, r6, register
from reelkit.plans.charts import (chart_defaults, clean_catalogue, explode_genres,
                                  knowledge_chart_from_defaults, popularity_chart)
from reelkit.plans.wrangling import budget_stats, subset_existing
from reelkit.session import cut_lineage
from reelkit.sources import proxy

# Fixed parameters of the proxy catalogue: runtime (p_size) is 1-50, so the
# popularity chart's runtime window is 5-40 instead of 45-300.
R1_MIN_RUNTIME, R1_MAX_RUNTIME = 5, 40


def movies(spark, sf_dir):
    return clean_catalogue(proxy.movies_raw(spark, sf_dir))


@register("R1_popularity_chart", W("movies") + """
, stats AS (SELECT quantile_cont(vote_count, 0.8) AS m, avg(vote_average) AS c FROM movies)
, scored AS (
    SELECT mv.id, mv.title, mv.vote_count, mv.vote_average, mv.runtime,
           mv.vote_count / (mv.vote_count + s.m) * mv.vote_average
             + s.m / (s.m + mv.vote_count) * s.c AS score
    FROM movies mv, stats s
    WHERE mv.runtime BETWEEN 5 AND 40 AND mv.vote_count >= s.m)
SELECT id, title, vote_count, round(vote_average, 6) AS vote_average,
       round(score, 6) AS score, runtime
FROM scored ORDER BY round(score, 9) DESC NULLS LAST, id LIMIT 25""")
def r1_popularity_chart(spark, sf_dir):
    chart = popularity_chart(movies(spark, sf_dir), R1_MIN_RUNTIME, R1_MAX_RUNTIME)
    return chart.select("id", "title", "vote_count", r6("vote_average").alias("vote_average"),
                        r6("score").alias("score"), "runtime")


# --------------------------------------------------------------------------
# cleaning (P*)
# --------------------------------------------------------------------------

NUM_RE = "'[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?'"
INT_RE = "'[+-]?\\d+'"


@register("P1_select_columns", W("movies") + """
SELECT id, title, vote_count FROM movies""")
def p1_select(spark, sf_dir):
    return movies(spark, sf_dir).select("id", "title", "vote_count")


@register("P2_existing_columns", W("movies_raw") + """
SELECT id, title, genres, release_date FROM movies_raw""")
def p2_existing(spark, sf_dir):
    """The columns asked for, and of the optional ones those that the table has."""
    return subset_existing(proxy.movies_raw(spark, sf_dir), ["id", "title"], ["genres", "tagline", "release_date"])


@register("P4_clean_numeric", W("movies_raw") + """
SELECT id, budget AS budget_raw,
       CASE WHEN regexp_full_match(trim(budget), """ + NUM_RE + """) THEN CAST(trim(budget) AS DOUBLE) END
           AS budget
FROM movies_raw""")
def p4_clean_numeric(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    return raw.select("id", F.col("budget").alias("budget_raw"), to_double("budget").alias("budget"))


@register("P5_clean_ids", W("movies_raw") + """
SELECT id AS id_raw, CASE WHEN regexp_full_match(trim(id), """ + INT_RE + """) THEN CAST(trim(id) AS BIGINT) END
           AS id
FROM movies_raw""")
def p5_clean_ids(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    return raw.select(F.col("id").alias("id_raw"), to_bigint_id("id").alias("id"))


@register("P6_int_or_zero", W("movies_raw") + """
SELECT id AS id_raw, coalesce(CASE WHEN regexp_full_match(trim(id), """ + INT_RE + """)
                                   THEN TRY_CAST(trim(id) AS INTEGER) END, 0) AS id_int
FROM movies_raw""")
def p6_int_or_zero(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    return raw.select(F.col("id").alias("id_raw"), to_int_or_zero("id").alias("id_int"))


@register("P10_parse_date", W("movies_raw") + """
SELECT id, CAST(CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) AS VARCHAR) AS release_date
FROM movies_raw""")
def p10_parse_date(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    return raw.select("id", to_date("release_date").cast("string").alias("release_date"))


@register("P11_year_string", W("movies_raw") + """
SELECT id, strftime(try_strptime(release_date, '%Y-%m-%d'), '%Y') AS year FROM movies_raw""")
def p11_year_string(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    return raw.select("id", year_string("release_date").alias("year"))


@register("P12_year_int", W("movies_raw") + """
SELECT id, CAST(coalesce(year(try_strptime(release_date, '%Y-%m-%d')), 0) AS INTEGER) AS year
FROM movies_raw""")
def p12_year_int(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    return raw.select("id", year_int("release_date").cast("int").alias("year"))


@register("P14_title_year", W("movies_raw") + """
, t AS (SELECT id, CASE WHEN release_date IS NULL THEN title
                        ELSE title || ' (' || substr(release_date, 1, 4) || ')' END AS title
        FROM movies_raw)
SELECT id, title, nullif(regexp_extract(title, '\\((\\d{4})\\)$', 1), '') AS year_from_title FROM t""")
def p14_title_year(spark, sf_dir):
    raw = proxy.movies_raw(spark, sf_dir)
    t = raw.select("id", F.when(F.col("release_date").isNull(), F.col("title"))
                   .otherwise(F.concat("title", F.lit(" ("), F.substring("release_date", 1, 4), F.lit(")")))
                   .alias("title"))
    return t.select("id", "title", title_year("title").alias("year_from_title"))


@register("P15_surrogate_ids", W("movies") + """
SELECT row_number() OVER (ORDER BY id) AS movieId, id, title FROM movies""")
def p15_surrogate_ids(spark, sf_dir):
    m = movies(spark, sf_dir).select("id", "title")
    return surrogate_id(m, "id", "movieId").select(F.col("movieId").cast("bigint").alias("movieId"),
                                                   "id", "title")


# --------------------------------------------------------------------------
# id mapping and slim metadata
# --------------------------------------------------------------------------

LINKS_SQL = """
, links AS (SELECT p_partkey * 10 AS movieId,
                   CASE WHEN p_partkey % 3 = 0 THEN CAST(CAST(p_partkey AS DOUBLE) AS VARCHAR)
                        ELSE CAST(p_partkey AS VARCHAR) END AS tmdbId
            FROM part)
"""


def links(spark, sf_dir):
    """links(movieId, tmdbId): rating-side id -> catalogue id as text, some as '30.0' (D12)."""
    p = proxy.table(spark, sf_dir, "part")
    return p.select((F.col("p_partkey") * 10).alias("movieId"),
                    F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("double").cast("string"))
                    .otherwise(F.col("p_partkey").cast("string")).alias("tmdbId"))


@register("R19_id_mapping", W("movies_raw") + LINKS_SQL + """
, norm AS (SELECT movieId, CASE WHEN regexp_full_match(trim(tmdbId), """ + NUM_RE + """)
                                     AND CAST(trim(tmdbId) AS DOUBLE) = floor(CAST(trim(tmdbId) AS DOUBLE))
                                THEN CAST(CAST(trim(tmdbId) AS DOUBLE) AS BIGINT)::VARCHAR
                                ELSE trim(tmdbId) END AS tmdbId FROM links)
SELECT n.movieId, m.id, m.title FROM movies_raw m JOIN norm n ON m.id = n.tmdbId""")
def r19_id_mapping(spark, sf_dir):
    from reelkit.plans.hybrid import id_mapping
    return id_mapping(proxy.movies_raw(spark, sf_dir), links(spark, sf_dir))


@register("R20_slim_metadata", W("movies") + """
SELECT id, title, vote_count, round(vote_average, 6) AS vote_average, CAST(year AS INTEGER) AS year
FROM movies""")
def r20_slim(spark, sf_dir):
    m = movies(spark, sf_dir)
    return m.select("id", "title", "vote_count", r6("vote_average").alias("vote_average"),
                    F.col("year").cast("int").alias("year"))


# --------------------------------------------------------------------------
# filters (F*)
# --------------------------------------------------------------------------

@register("F1_high_revenue", W("movies") + """
SELECT id, title, round(revenue, 6) AS revenue, budget FROM movies
WHERE revenue > 1200000 AND budget < 1500""")
def f1_high_revenue(spark, sf_dir):
    from reelkit.plans.wrangling import high_revenue
    out = high_revenue(movies(spark, sf_dir), revenue_threshold=1_200_000, budget_threshold=1500)
    return out.select("id", "title", r6("revenue").alias("revenue"), "budget")


@register("F2_runtime_between", W("movies") + """
SELECT id, runtime FROM movies WHERE runtime BETWEEN 10 AND 20""")
def f2_runtime(spark, sf_dir):
    return movies(spark, sf_dir).filter(F.col("runtime").between(10, 20)).select("id", "runtime")


@register("F3_vote_percentile_filter", W("movies") + """
SELECT id, vote_count FROM movies WHERE vote_count >= (SELECT quantile_cont(vote_count, 0.9) FROM movies)""")
def f3_percentile(spark, sf_dir):
    return filter_at_least_quantile(movies(spark, sf_dir), "vote_count", 0.9).select("id", "vote_count")


GEN_SQL = """
, gen AS (SELECT id, title, runtime, year, vote_count, vote_average,
                 unnest(CASE WHEN genres IS NULL OR len(genres) = 0 THEN [NULL::VARCHAR] ELSE genres END)
                     AS genre
          FROM movies)
"""


def gen_df(spark, sf_dir):
    return explode_genres(movies(spark, sf_dir))


@register("U1_explode_genres", W("movies") + GEN_SQL + """
SELECT id, genre FROM gen""")
def u1_explode(spark, sf_dir):
    return gen_df(spark, sf_dir).select("id", "genre")


@register("F4_preference_filter", W("movies") + GEN_SQL + """
SELECT id, genre, runtime, CAST(year AS INTEGER) AS year FROM gen
WHERE genre = 'economy' AND runtime >= 10 AND runtime <= 30 AND year >= 1995 AND year <= 1998""")
def f4_preference(spark, sf_dir):
    g = gen_df(spark, sf_dir)
    out = g.filter((F.col("genre") == "economy") & F.col("runtime").between(10, 30)
                   & F.col("year").between(1995, 1998))
    return out.select("id", "genre", "runtime", "year")


@register("F7_genre_contains", W("movies") + """
SELECT id, title FROM movies WHERE len(list_filter(genres, lambda x: lower(x) = 'promo')) > 0""")
def f7_contains(spark, sf_dir):
    m = movies(spark, sf_dir)
    return m.filter(F.exists("genres", lambda x: F.lower(x) == F.lit("promo"))).select("id", "title")


@register("U2_first_id_per_title", W("movies") + """
SELECT title, min(id) AS id, count(*) AS n FROM movies WHERE title IS NOT NULL GROUP BY title""")
def u2_dedupe(spark, sf_dir):
    m = movies(spark, sf_dir).filter(F.col("title").isNotNull())
    return m.groupBy("title").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))


@register("U0_never_top_rated", W("movies", "ratings") + """
SELECT id FROM movies WHERE id NOT IN (SELECT movie_id FROM ratings WHERE rating = 5)""")
def u0_difference(spark, sf_dir):
    top = proxy.ratings(spark, sf_dir).filter(F.col("rating") == 5).select(F.col("movie_id").alias("id"))
    return movies(spark, sf_dir).select("id").join(top, "id", "left_anti")


# --------------------------------------------------------------------------
# aggregates over the catalogue (A*)
# --------------------------------------------------------------------------

@register("A3_genre_frequency", W("movies") + GEN_SQL + """
SELECT genre, count(*) AS n FROM gen WHERE genre IS NOT NULL GROUP BY genre""")
def a3_genre_frequency(spark, sf_dir):
    return frequency(gen_df(spark, sf_dir).filter(F.col("genre").isNotNull()), "genre")


@register("A4_year_histogram", W("movies_raw") + """
, y AS (SELECT strftime(try_strptime(release_date, '%Y-%m-%d'), '%Y') AS year FROM movies_raw)
SELECT year, count(*) AS n FROM y WHERE year IS NOT NULL GROUP BY year ORDER BY year LIMIT 10""")
def a4_year_histogram(spark, sf_dir):
    y = proxy.movies_raw(spark, sf_dir).select(year_string("release_date").alias("year"))
    return frequency(y.filter(F.col("year").isNotNull()), "year").orderBy("year").limit(10)


@register("A5_runtime_min_max", W("movies") + """
SELECT min(runtime) AS min_runtime, max(runtime) AS max_runtime FROM movies""")
def a5_runtime(spark, sf_dir):
    return movies(spark, sf_dir).agg(F.min("runtime").alias("min_runtime"), F.max("runtime").alias("max_runtime"))


@register("A6_budget_mean_median", W("movies") + """
SELECT round(avg(budget), 6) AS mean_budget, round(median(budget), 6) AS median_budget FROM movies""")
def a6_budget(spark, sf_dir):
    m = budget_stats(movies(spark, sf_dir))
    return m.select(r6("mean").alias("mean_budget"), r6("median").alias("median_budget"))


@register("A7_vote_quantiles", W("movies") + """
SELECT round(quantile_cont(vote_count, 0.25), 6) AS q25, round(quantile_cont(vote_count, 0.75), 6) AS q75,
       round(quantile_cont(vote_count, 0.8), 6) AS q80, round(quantile_cont(vote_count, 0.9), 6) AS q90
FROM movies""")
def a7_quantiles(spark, sf_dir):
    ps = {"q25": 0.25, "q75": 0.75, "q80": 0.8, "q90": 0.9}
    found = exact_quantiles(movies(spark, sf_dir), "vote_count", list(ps.values()))
    return spark.range(1).select(*[r6(F.lit(q).cast("double")).alias(n) for n, q in zip(ps, found, strict=True)])


@register("A14_available_genres", W("movies") + GEN_SQL + """
SELECT DISTINCT genre FROM gen WHERE genre IS NOT NULL""")
def a14_genres(spark, sf_dir):
    return gen_df(spark, sf_dir).select("genre").filter(F.col("genre").isNotNull()).distinct()


@register("A15_year_range", W("movies") + GEN_SQL + """
SELECT CAST(CASE WHEN min(year) IS NULL OR min(year) <= 0 THEN 1900 ELSE min(year) END AS INTEGER) AS min_year,
       CAST(coalesce(max(year), 2023) AS INTEGER) AS max_year FROM gen""")
def a15_year_range(spark, sf_dir):
    from reelkit.plans.charts import year_range
    return year_range(gen_df(spark, sf_dir))


@register("A16_runtime_range", W("movies") + GEN_SQL + """
SELECT CAST(coalesce(floor(min(runtime) FILTER (WHERE runtime > 0 AND runtime < 1000)), 60) AS INTEGER)
           AS min_runtime,
       CAST(coalesce(floor(max(runtime) FILTER (WHERE runtime > 0 AND runtime < 1000)), 180) AS INTEGER)
           AS max_runtime
FROM gen""")
def a16_runtime_range(spark, sf_dir):
    from reelkit.plans.charts import runtime_range
    return runtime_range(gen_df(spark, sf_dir))


@register("A17_top_genres", W("movies") + GEN_SQL + """
SELECT genre, n, rank FROM (SELECT genre, count(*) AS n,
                                   row_number() OVER (ORDER BY count(*) DESC, genre) AS rank
                            FROM gen WHERE genre IS NOT NULL GROUP BY genre) WHERE rank <= 5""")
def a17_top_genres(spark, sf_dir):
    f = frequency(gen_df(spark, sf_dir).filter(F.col("genre").isNotNull()), "genre")
    top = top_n(f, 5, [F.desc("n"), F.asc("genre")])
    from pyspark.sql.window import Window
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("genre")))
                          .cast("bigint"))


# --------------------------------------------------------------------------
# ordering (O*)
# --------------------------------------------------------------------------

@register("O1_sort_asc_nulls_last", W("movies") + """
SELECT id, budget FROM movies ORDER BY budget ASC NULLS LAST, id LIMIT 20""")
def o1_sort_asc(spark, sf_dir):
    return top_n(movies(spark, sf_dir).select("id", "budget"), 20, [F.asc_nulls_last("budget"), F.asc("id")])


@register("O2_sort_desc_nulls_last", W("movies") + """
SELECT id, round(vote_average, 6) AS vote_average FROM movies
ORDER BY round(vote_average, 9) DESC NULLS LAST, id LIMIT 20""")
def o2_sort_desc(spark, sf_dir):
    m = movies(spark, sf_dir)
    out = top_n(m, 20, [F.desc_nulls_last(F.round("vote_average", 9)), F.asc("id")])
    return out.select("id", r6("vote_average").alias("vote_average"))


@register("O8_random_per_genre", W("movies") + GEN_SQL + """
SELECT genre, id, pick FROM (
    SELECT genre, id, row_number() OVER (PARTITION BY genre
        ORDER BY md5(concat_ws('-', CAST(id AS VARCHAR), '42')), id) AS pick
    FROM gen WHERE genre IS NOT NULL) WHERE pick <= 2""")
def o8_random_per_genre(spark, sf_dir):
    g = gen_df(spark, sf_dir).filter(F.col("genre").isNotNull())
    out = sample_per_group(g, "genre", "id", 2, seed=42)
    return out.select("genre", "id", F.col("pick").cast("bigint").alias("pick"))


@register("O10_argmax_per_genre", W("movies") + GEN_SQL + """
SELECT genre, arg_max(id, vote_count * 1e9 - id) AS most_voted_id, max(vote_count) AS max_votes
FROM gen WHERE genre IS NOT NULL GROUP BY genre""")
def o10_argmax(spark, sf_dir):
    g = gen_df(spark, sf_dir).filter(F.col("genre").isNotNull())
    return g.groupBy("genre").agg(F.max_by("id", F.struct(F.col("vote_count"), -F.col("id"))).alias("most_voted_id"),
                                  F.max("vote_count").alias("max_votes"))


# --------------------------------------------------------------------------
# scalar functions on the catalogue
# --------------------------------------------------------------------------

@register("X2_genre_names", W("movies") + """
SELECT id, array_to_string(genres, '|') AS genres FROM movies""")
def x2_genre_names(spark, sf_dir):
    return movies(spark, sf_dir).select("id", F.array_join("genres", "|").alias("genres"))


@register("X8_weighted_rating", W("movies") + """
, st AS (SELECT quantile_cont(vote_count, 0.8) AS m, avg(vote_average) AS c FROM movies)
SELECT id, round(vote_count / (vote_count + m) * vote_average + m / (m + vote_count) * c, 6) AS score
FROM movies, st""")
def x8_weighted_rating(spark, sf_dir):
    m = cut_lineage(movies(spark, sf_dir).select("id", "vote_count", "vote_average"))
    votes, mean = exact_quantile(m, "vote_count", 0.8), scalar(m, F.avg("vote_average"))
    return m.select("id", r6(weighted_rating("vote_count", "vote_average", votes, mean)).alias("score"))


# --------------------------------------------------------------------------
# knowledge chart
# --------------------------------------------------------------------------

DEFAULTS_SQL = """
, counts AS (SELECT genre, count(*) AS n FROM gen WHERE genre IS NOT NULL GROUP BY genre)
, pick AS (SELECT CASE WHEN EXISTS (SELECT 1 FROM counts WHERE genre = 'animation') THEN 'animation'
                       ELSE (SELECT min(genre) FROM counts WHERE n = (SELECT max(n) FROM counts)) END AS genre)
, rng AS (SELECT quantile_cont(CASE WHEN runtime > 0 THEN runtime END, 0.25) AS q25,
                 quantile_cont(CASE WHEN runtime > 0 THEN runtime END, 0.75) AS q75,
                 min(year) AS ymin, max(year) AS ymax FROM gen)
, params AS (
    SELECT pick.genre,
           CAST(coalesce(floor(q25), 60) AS INTEGER) AS low_time,
           CAST(coalesce(floor(q75), 180) AS INTEGER) AS high_time,
           CAST(greatest(CASE WHEN ymin IS NULL OR ymin <= 0 THEN 1900 ELSE ymin END,
                         coalesce(ymax, 2023) - 30) AS INTEGER) AS low_year,
           CAST(coalesce(ymax, 2023) AS INTEGER) AS high_year
    FROM rng, pick)
"""


@register("R3_chart_defaults", W("movies") + GEN_SQL + DEFAULTS_SQL + """
SELECT * FROM params""")
def r3_chart_defaults(spark, sf_dir):
    return chart_defaults(gen_df(spark, sf_dir))


@register("R2_knowledge_chart", W("movies") + GEN_SQL + DEFAULTS_SQL + """
, matches AS (SELECT g.* FROM gen g, params p
              WHERE g.genre = p.genre AND g.runtime >= p.low_time AND g.runtime <= p.high_time
                AND g.year >= p.low_year AND g.year <= p.high_year)
, st AS (SELECT quantile_cont(vote_count, 0.8) AS m, avg(vote_average) AS c FROM matches)
, q AS (SELECT matches.*, vote_count / (vote_count + m) * vote_average + m / (m + vote_count) * c AS score
        FROM matches, st WHERE vote_count >= m)
, chart AS (SELECT * FROM q
            UNION ALL SELECT matches.*, NULL AS score FROM matches WHERE NOT EXISTS (SELECT 1 FROM q))
SELECT id, title, genre, runtime, CAST(year AS INTEGER) AS year, vote_count,
       round(vote_average, 6) AS vote_average, round(score, 6) AS score,
       row_number() OVER (ORDER BY round(score, 9) DESC NULLS LAST, vote_average DESC NULLS LAST, id) AS rank
FROM chart""")
def r2_knowledge_chart(spark, sf_dir):
    chart = knowledge_chart_from_defaults(gen_df(spark, sf_dir))
    return chart.select("id", "title", "genre", "runtime", F.col("year").cast("int").alias("year"),
                        "vote_count", r6("vote_average").alias("vote_average"), r6("score").alias("score"),
                        F.col("rank").cast("bigint").alias("rank"))


# --------------------------------------------------------------------------
# file round trip (S1, S12): the text catalogue through CSV and back
# --------------------------------------------------------------------------

# Empty text comes back NULL from CSV (as from pandas' read_csv); whitespace is kept.
@register("S12_csv_round_trip", W("movies_raw") + """
SELECT id, title, 'Line one, "quoted"' || chr(10) || title AS overview, genres,
       nullif(budget, '') AS budget, vote_count
FROM movies_raw""")
def s12_csv_round_trip(spark, sf_dir):
    import uuid

    from reelkit.session import checkpoint_dir
    from reelkit.sources import files
    raw = proxy.movies_raw(spark, sf_dir)
    out = raw.select("id", "title",
                     F.concat(F.lit('Line one, "quoted"'), F.lit("\n"), F.col("title")).alias("overview"),
                     "genres", "release_date", "budget", "revenue", "runtime", "vote_average", "vote_count")
    path = f"{checkpoint_dir(spark).rstrip('/')}/reelkit-io/{uuid.uuid4().hex}"
    files.write_table(out, path, fmt="csv")
    back = files.read_metadata(spark, path)
    return back.select("id", "title", "overview", "genres", "budget", "vote_count")
