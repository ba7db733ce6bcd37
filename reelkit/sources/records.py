"""Quoted CSV records that span lines, from files cut into byte ranges.

Spark's own reader takes a whole file into one task once records may hold line
feeds.  Here the lines are read in byte ranges, by as many tasks as any text
file gets, and put together by quote parity:

1. each line's quotes are counted, with a running count inside its range;
2. one row a range (its quotes, its last record start for either parity)
   suffices for a prefix sum over a file's ranges, which says whether a range
   begins inside quotes, and which record it then goes on with;
3. a line that begins outside quotes starts a record.  Lines of one record are
   joined inside their range; only the first and last record of a range can
   cross a cut, and only these meet again across ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _joined() -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda s: s["line"]), "\n")


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """file, block, at (rises along a file's range), line, quotes of it, quotes before it in its range."""
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
                       (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"))
    within = Window.partitionBy("file", "block").orderBy("at")
    return lines.withColumn("before", F.sum("quotes").over(within) - F.col("quotes"))


def _ranges(lines: DataFrame) -> DataFrame:
    """One row a range: file, block, ``inside`` (0 or 1 quote open where it begins), ``open_at`` (the record that an
    earlier range started and that goes on here), ``last_at`` (the last record started here), ``header_at``."""
    def places(best, parity: int, written: bool = False) -> Column:
        cond = F.col("before") % 2 == parity
        return best(F.when(cond & (F.rtrim("line") != "") if written else cond, F.col("at")))

    stats = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), places(F.max, 0).alias("last_0"), places(F.max, 1).alias("last_1"),
        places(F.min, 0, True).alias("first_0"), places(F.min, 1, True).alias("first_1"))
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    even = F.col("inside") == 0
    return (stats.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
                 .withColumn("last_at", F.when(even, F.col("last_0")).otherwise(F.col("last_1")))
                 .withColumn("first_at", F.when(even, F.col("first_0")).otherwise(F.col("first_1")))
                 .select("file", "block", "inside", "last_at", F.last("last_at", ignorenulls=True).over(earlier).alias("open_at"),
                         F.first("first_at", ignorenulls=True)
                          .over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("header_at")))


def quoted_records(spark: SparkSession, path: str, header: bool = True, quote: str = '"') -> DataFrame:
    """``record``: the text of every CSV record under ``path`` (a file or a folder), line feeds inside quotes kept.

    Quotes must pair up, as they do where a field that holds one is quoted and
    the quote doubled.  Empty lines outside quotes are no records; with
    ``header`` the first record of every file is left out.  A carriage return
    before the line feed that ends a record goes.  A quote that never closes
    makes one record of the rest of its file.  Empty files: no rows.
    """
    lines = _lines(spark, path, quote)
    ranges = _ranges(_lines(spark, path, quote))
    within = Window.partitionBy("file", "block").orderBy("at")
    starts = F.when((F.col("inside") + F.col("before")) % 2 == 0, F.col("at"))
    placed = (lines.join(ranges, ["file", "block"])
                   .withColumn("here", F.last(starts, ignorenulls=True).over(within))
                   .withColumn("start", F.coalesce("here", "open_at")))
    # one piece a record and range: grouped as the windows are, so without another shuffle
    pieces = placed.groupBy("file", "block", "start").agg(
        F.min("at").alias("at"), _joined().alias("line"), F.max("last_at").alias("last_at"), F.max("header_at").alias("header_at"))
    at_cut = (F.col("start") != F.col("at")) | (F.col("start") == F.col("last_at"))
    whole = pieces.filter(~at_cut).select("start", "header_at", "line")
    cut = pieces.filter(at_cut).groupBy("start").agg(F.max("header_at").alias("header_at"), _joined().alias("line"))
    records = whole.unionByName(cut)
    if header:
        records = records.filter(F.col("start") != F.coalesce("header_at", F.lit(-1)))
    record = F.regexp_replace("line", r"\r\z", "")
    return records.select(record.alias("record")).filter("record != ''")


def read_quoted_csv(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Rows of the CSV files under ``path``, as ``spark.read.csv`` with ``multiLine`` gives them, read in many tasks."""
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    rows = quoted_records(spark, path, header)
    return rows.select(F.from_csv("record", schema, options).alias("r")).select("r.*")
