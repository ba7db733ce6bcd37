"""Catalogue entries: file sources and sinks, by round trip of given tables through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkit.plans.catalog import W, r6, register
from reelkit.session import checkpoint_dir
from reelkit.sources import files, proxy
from reelkit.sources.records import read_quoted_csv


def _path(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/reelkit-io/{uuid.uuid4().hex}"


def _plain(df: DataFrame, sep: str, header: bool = False) -> str:
    """``df`` as a separated file in ISO-8859-1, as the readers of the old formats expect it."""
    path = _path(df.sparkSession)
    df.write.option("sep", sep).option("header", header).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return path


@register("S1_multi_line_records", """
SELECT doc_id AS id, md5(coalesce(text, '') || chr(10) || '"' || lang || '"' || chr(10)) AS digest FROM documents""")
def s1_multi_line(spark, sf_dir):
    """Whole texts with quotes and line feeds through CSV files and back, read in byte ranges."""
    quoted = F.concat(F.coalesce("text", F.lit("")), F.lit('\n"'), F.col("lang"), F.lit('"\n'))
    path = _path(spark)
    files.write_table(proxy.table(spark, sf_dir, "documents").select("doc_id", quoted.alias("text")), path, fmt="csv")
    return read_quoted_csv(spark, path, "id long, text string").select("id", F.md5("text").alias("digest"))


@register("S11_iris_file", """
SELECT CAST(l_quantity AS DOUBLE) AS sepal_length, CAST(l_extendedprice AS DOUBLE) AS sepal_width,
       CAST(l_discount AS DOUBLE) AS petal_length, CAST(l_tax AS DOUBLE) AS petal_width, l_returnflag AS class FROM lineitem""")
def s11_iris(spark, sf_dir):
    """A headerless file of four measures and a class, with the reader's names."""
    li = proxy.table(spark, sf_dir, "lineitem")
    measures = [F.col(c).cast("double") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    return files.read_iris(spark, _plain(li.select(*measures, "l_returnflag"), ","))


@register("S19_fallback_source", W("ratings") + "SELECT rating_id, rating FROM ratings")
def s19_fallback(spark, sf_dir):
    """A source that turns out empty is replaced by the one named for that."""
    r = proxy.ratings(spark, sf_dir).select("rating_id", "rating")
    return files.with_fallback(r.filter("rating < 0"), r)


@register("S2_users_file", W("users") + """
SELECT CAST(user_id AS INTEGER) AS user_id, age, sex, occupation, 'T8H' || CAST(user_id AS VARCHAR) AS zip_code FROM users""")
def s2_users(spark, sf_dir):
    u = proxy.users(spark, sf_dir)
    u = u.select("user_id", "age", "sex", "occupation", F.concat(F.lit("T8H"), F.col("user_id").cast("string")).alias("zip_code"))
    return files.read_users(spark, _plain(u, "|"))


@register("S3_items_file", W("movies_raw") + """
SELECT CAST(id AS INTEGER) AS movie_id, title FROM movies_raw WHERE regexp_full_match(id, '[0-9]+')""")
def s3_items(spark, sf_dir):
    m = proxy.movies_raw(spark, sf_dir).filter(F.col("id").rlike(r"^[0-9]+$"))
    flags = [F.lit(i % 2).alias(f"g{i}") for i in range(files.ITEM_COLUMNS - 2)]
    return files.read_items(spark, _plain(m.select("id", "title", *flags), "|"))


@register("S4_ratings_tab_file", W("ratings") + """
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(movie_id AS INTEGER) AS movie_id, rating FROM ratings""")
def s4_ratings_tab(spark, sf_dir):
    r = proxy.ratings(spark, sf_dir).select("user_id", "movie_id", "rating", F.lit(881250949).alias("timestamp"))
    return files.read_ratings_tab(spark, _plain(r, "\t"))


@register("S5_ratings_csv_file", W("ratings") + """
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(movie_id AS INTEGER) AS movie_id, CAST(rating AS DOUBLE) AS rating FROM ratings""")
def s5_ratings_csv(spark, sf_dir):
    r = proxy.ratings(spark, sf_dir).select(F.col("user_id").alias("userId"), F.col("movie_id").alias("movieId"), "rating")
    return files.read_ratings_csv(spark, _plain(r, ",", header=True))


@register("S6_links_file", """
SELECT CAST(p_partkey * 10 AS INTEGER) AS "movieId", 'tt' || CAST(p_partkey AS VARCHAR) AS "imdbId",
       CAST(p_partkey AS VARCHAR) || '.0' AS "tmdbId" FROM part""")
def s6_links(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    p = proxy.table(spark, sf_dir, "part").select((F.col("p_partkey") * 10).alias("movieId"), F.concat(F.lit("tt"), key).alias("imdbId"),
                                                  F.concat(key, F.lit(".0")).alias("tmdbId"))
    return files.read_links(spark, _plain(p, ",", header=True))


@register("S7_credits_file", W("credits", "keywords") + """
SELECT CAST(c.id AS VARCHAR) AS id, c."cast", c.crew, k.keywords FROM credits c JOIN keywords k USING (id)""")
def s7_credits(spark, sf_dir):
    c, k = _path(spark), _path(spark)
    files.write_table(proxy.credits(spark, sf_dir).select("id", "cast", "crew"), c, fmt="csv")
    files.write_table(proxy.keywords(spark, sf_dir).select("id", "keywords"), k, fmt="csv")
    return files.read_credits(spark, c).join(files.read_keywords(spark, k), "id")


@register("S8_edges_file", """
SELECT l_orderkey AS movie_idx, l_partkey AS similar_idx, round(max(l_discount), 6)::DOUBLE AS similarity
FROM lineitem GROUP BY 1, 2""")
def s8_edges(spark, sf_dir):
    li = proxy.table(spark, sf_dir, "lineitem")
    edges = li.groupBy(F.col("l_orderkey").alias("src_id"), F.col("l_partkey").alias("dst_id")) \
              .agg(F.max("l_discount").cast("double").alias("similarity"))
    path = _path(spark)
    files.write_edges(edges, path)  # S13
    back = files.read_edges(spark, [path + "-elsewhere", path])  # S10: the first path that exists
    return back.select("movie_idx", "similar_idx", r6("similarity").alias("similarity"))


@register("S9_title_map_file", W("movies") + """
SELECT title, min(id) AS id FROM movies WHERE title IS NOT NULL GROUP BY title""")
def s9_title_map(spark, sf_dir):
    from reelkit.plans.queries_charts import movies
    path = _path(spark)
    files.write_title_map(movies(spark, sf_dir), path)  # S14
    return files.read_title_map(spark, path)
