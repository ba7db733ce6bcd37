"""Seeded synthetic sources (S15-S18), generated on the executors.

Rows come from ``spark.range`` and column expressions (seeded hash uniforms,
Box-Muller normals); nothing is built on the driver, so the generators scale
with the requested size.  They reproduce the *definitions* (ranges, counts,
shapes), not numpy's or scikit-learn's random streams.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 20 occupations and the sexes of the sample users.
OCCUPATIONS = ["administrator", "artist", "doctor", "educator", "engineer",
               "entertainment", "executive", "healthcare", "homemaker", "lawyer",
               "librarian", "marketing", "programmer", "retired", "salesman",
               "scientist", "student", "technician", "writer", "other"]
SEXES = ["M", "F"]


def _u(seed: int, *cols) -> F.Column:
    """Uniform [0, 1) from a hash of (seed, cols): reproducible per row, any partitioning."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


def sample_users(spark: SparkSession, n: int = 100, seed: int = 42) -> DataFrame:
    """Id 1..n, age 18-70, sex, one of 20 occupations, zip 10000-99998."""
    ids = spark.range(1, n + 1).withColumnRenamed("id", "user_id")
    occ = F.array(*[F.lit(o) for o in OCCUPATIONS])
    return ids.select(
        F.col("user_id").cast("int"),
        (F.lit(18) + F.floor(_u(seed, F.col("user_id"), F.lit(1)) * 53)).cast("int").alias("age"),
        F.element_at(F.array(*[F.lit(s) for s in SEXES]),
                     (F.floor(_u(seed, F.col("user_id"), F.lit(2)) * 2) + 1).cast("int")).alias("sex"),
        F.element_at(occ, (F.floor(_u(seed, F.col("user_id"), F.lit(3)) * len(OCCUPATIONS)) + 1).cast("int"))
        .alias("occupation"),
        F.lpad((F.floor(_u(seed, F.col("user_id"), F.lit(4)) * 89999) + 10000).cast("int").cast("string"), 5, "0")
        .alias("zip_code"))


def sample_ratings(spark: SparkSession, n_users: int = 100, n_movies: int = 50, min_k: int = 5,
                   max_k: int = 15, seed: int = 42) -> DataFrame:
    """Each user rates k in [min_k, max_k] distinct movies, rating 1-5.

    Distinct movies per user: the first k movies by a per-(user, movie) hash
    order, chosen with a window over that user's n_movies candidates (bounded
    by the catalogue size, which is a parameter).
    """
    users = spark.range(1, n_users + 1).withColumnRenamed("id", "user_id")
    k = (F.lit(min_k) + F.floor(_u(seed, F.col("user_id"), F.lit(7)) * (max_k - min_k + 1))).cast("int")
    cand = users.select("user_id", k.alias("k"), F.explode(F.sequence(F.lit(1), F.lit(n_movies))).alias("movie_id"))
    from pyspark.sql.window import Window
    order = Window.partitionBy("user_id").orderBy(_u(seed, F.col("user_id"), F.col("movie_id")), "movie_id")
    picked = cand.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= F.col("k"))
    return picked.select(F.col("user_id").cast("int"), F.col("movie_id").cast("int"),
                         (F.lit(1) + F.floor(_u(seed + 1, F.col("user_id"), F.col("movie_id")) * 5)).cast("int")
                         .alias("rating"))


def _gauss(seed: int, *cols) -> F.Column:
    """Standard normal by Box-Muller over two hash uniforms."""
    u1 = F.greatest(_u(seed, *cols, F.lit(11)), F.lit(1e-12))
    u2 = _u(seed, *cols, F.lit(13))
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * math.pi * u2)


def blobs(spark: SparkSession, n: int = 200, centers: int = 3, std: float = 0.6, seed: int = 0,
          box: float = 10.0) -> DataFrame:
    """Isotropic Gaussian blobs in 2-d; centres uniform in [-box, box]."""
    rows = spark.range(n)
    label = F.pmod(F.col("id"), F.lit(centers)).cast("int")
    cx = (_u(seed, label, F.lit(1)) * 2 - 1) * box
    cy = (_u(seed, label, F.lit(2)) * 2 - 1) * box
    return rows.select("id", (cx + std * _gauss(seed, F.col("id"), F.lit(1))).alias("x"),
                       (cy + std * _gauss(seed, F.col("id"), F.lit(2))).alias("y"), label.alias("label"))


def moons(spark: SparkSession, n: int = 200, noise: float = 0.05, seed: int = 0) -> DataFrame:
    """Two interleaving half circles with Gaussian noise."""
    rows = spark.range(n)
    outer = F.col("id") < n // 2
    k = F.when(outer, F.col("id")).otherwise(F.col("id") - n // 2).cast("double")
    m = F.when(outer, F.lit(n // 2)).otherwise(F.lit(n - n // 2)).cast("double")
    t = F.lit(math.pi) * k / F.greatest(m - 1, F.lit(1.0))
    x = F.when(outer, F.cos(t)).otherwise(1 - F.cos(t))
    y = F.when(outer, F.sin(t)).otherwise(0.5 - F.sin(t))
    return rows.select("id", (x + noise * _gauss(seed, F.col("id"), F.lit(1))).alias("x"),
                       (y + noise * _gauss(seed, F.col("id"), F.lit(2))).alias("y"),
                       F.when(outer, 0).otherwise(1).alias("label"))
