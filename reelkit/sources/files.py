"""File sources and sinks (S1-S14, S19) with explicit schemas.

Every reader declares its schema (no inference pass over the data); dirty
columns are read as strings and cleaned by ``functions.clean``.  Writers
default to Parquet; CSV output turns arrays into JSON text.  Missing optional
inputs return a typed empty table only when the caller asks for it (S8/S9,
S19) - never silently.
"""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from reelkit.sources.records import read_quoted_csv

# ---------------------------------------------------------------- schemas (FIXTURES §1)

USERS = "user_id int, age int, sex string, occupation string, zip_code string"
RATINGS_TAB = "user_id int, movie_id int, rating int, timestamp long"
RATINGS_CSV = "userId int, movieId int, rating double"
ITEM_COLUMNS = 24  # id, title, release date, video date, URL, 19 genre flags
METADATA = ("id string, title string, overview string, genres string, release_date string, budget string, "
            "revenue double, runtime double, vote_average double, vote_count double")
CREDITS = "id string, cast string, crew string"
KEYWORDS = "id string, keywords string"
LINKS = "movieId int, imdbId string, tmdbId string"
EDGES = "movie_idx long, similar_idx long, similarity double"
TITLE_MAP = "title string, id long"
IRIS = "sepal_length double, sepal_width double, petal_length double, petal_width double, class string"


def _csv(spark: SparkSession, schema, header: bool, sep: str = ",", encoding: str = "UTF-8"):
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
                 .option("encoding", encoding)
                 .option("escape", '"').option("mode", "PERMISSIVE"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with quoted multi-line text; numerics stay text where dirty."""
    return read_quoted_csv(spark, path, METADATA)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Headerless, pipe-separated, latin-1 user table (zip codes are text)."""
    return _csv(spark, USERS, header=False, sep="|", encoding="ISO-8859-1").csv(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """S3: 24-column pipe file -> (movie_id, title); non-numeric ids dropped."""
    cols = ", ".join(["movie_id string", "title string"] + [f"c{i} string" for i in range(ITEM_COLUMNS - 2)])
    raw = _csv(spark, cols, header=False, sep="|", encoding="ISO-8859-1").csv(path)
    from reelkit.functions.clean import to_bigint_id
    return (raw.select(to_bigint_id("movie_id").cast("int").alias("movie_id"), "title")
               .filter(F.col("movie_id").isNotNull()))


def read_ratings_tab(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ratings; the timestamp is dropped."""
    return _csv(spark, RATINGS_TAB, header=False, sep="\t", encoding="ISO-8859-1").csv(path).drop("timestamp")


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered ratings, renamed to snake_case."""
    r = _csv(spark, RATINGS_CSV, header=True).csv(path)
    return r.select(F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), "rating")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Links; the catalogue key is text (normalise with ``clean.id_text``)."""
    return _csv(spark, LINKS, header=True).csv(path)


def read_credits(spark: SparkSession, path: str) -> DataFrame:
    """Credits with nested literals as text."""
    return read_quoted_csv(spark, path, CREDITS)


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    return read_quoted_csv(spark, path, KEYWORDS)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a reader finds the path, on whatever storage it names: resolved by Spark, without reading a row."""
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _holds_csv(spark: SparkSession, path: str) -> bool:
    """Whether a path is a CSV file, or a folder with one in it, on any storage."""
    if path.endswith(".csv"):
        return True
    return not spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path").limit(1).isEmpty()


def first_existing(spark: SparkSession, paths) -> str | None:
    """The first of several candidate paths that exists."""
    for p in paths:
        if _exists(spark, p):
            return p
    return None


def read_edges(spark: SparkSession, paths, empty_if_missing: bool = False) -> DataFrame:
    """Similarity edge list (Parquet or CSV); missing -> error, or typed empty table."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    p = first_existing(spark, paths)
    if p is None:
        if empty_if_missing:
            return spark.createDataFrame([], EDGES)
        raise FileNotFoundError(f"no edge table at {paths}")
    if _holds_csv(spark, p):
        return _csv(spark, EDGES, header=True).csv(p)
    return spark.read.schema(EDGES).parquet(p)


def read_title_map(spark: SparkSession, path: str, empty_if_missing: bool = False) -> DataFrame:
    """Headerless title -> id map."""
    if not _exists(spark, path):
        if empty_if_missing:
            return spark.createDataFrame([], TITLE_MAP)
        raise FileNotFoundError(path)
    return _csv(spark, TITLE_MAP, header=False).csv(path)


def read_iris(spark: SparkSession, path: str) -> DataFrame:
    """Headerless iris CSV from a local/shared path (no HTTP read)."""
    return _csv(spark, IRIS, header=False).csv(path)


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Use ``fallback`` only when ``primary`` is empty - an explicit choice of
    the caller, decided lazily by a scalar subquery (no driver round trip)."""
    has_rows = primary.select(F.count(F.lit(1)) > 0).scalar()
    return primary.unionByName(fallback.filter(~has_rows))


# ---------------------------------------------------------------- sinks

def _csv_ready(df: DataFrame) -> DataFrame:
    """Arrays / maps / structs are not CSV types: store them as JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, header: bool = True) -> None:
    """Write a table (Parquet default; CSV with header, arrays as JSON)."""
    w = (_csv_ready(df) if fmt == "csv" else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        # RFC 4180 quoting (doubled quotes), the dialect the readers expect
        # whitespace is data (pandas keeps it); empty text reads back as NULL, as in pandas
        (w.option("header", header).option("escape", '"').option("quote", '"')
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.format(fmt).save(path)


def write_edges(edges: DataFrame, path: str) -> None:
    """Top-k similarity edges, as (movie_idx, similar_idx, similarity)."""
    write_table(edges.select(F.col("src_id").alias("movie_idx"), F.col("dst_id").alias("similar_idx"),
                             "similarity"), path)


def write_title_map(catalogue: DataFrame, path: str) -> None:
    """Headerless title -> id map (read back by S9), first id per title."""
    m = catalogue.filter(F.col("title").isNotNull()).groupBy("title").agg(F.min("id").alias("id"))
    write_table(m, path, fmt="csv", header=False)
