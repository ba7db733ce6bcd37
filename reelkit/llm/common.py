"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelkit.session import checkpoint_dir

#: Fixed value: white space between words is space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the session names in ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/reelkit-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back (a lineage cut that outlives executors)."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def emptied(spark: SparkSession, path: str) -> None:
    """Overwrite a table of the shared folder that nothing reads any more with one of no rows: its files go, by the
    same writer that made them, on any storage."""
    spark.createDataFrame([], "gone boolean").write.mode("overwrite").parquet(path)


def partitions_of(df: DataFrame) -> int:
    """Input partitions of a plan, which Spark sizes by bytes; used to size exchanges in proportion to the input."""
    return max(1, df.rdd.getNumPartitions())


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def texts(batch: pa.RecordBatch, col: str = "text") -> list[str]:
    """The text column of an Arrow batch, null as empty."""
    return [t if t is not None else "" for t in batch.column(col).to_pylist()]


def pieces(batch: pa.RecordBatch, col: str, budget: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``budget`` bytes, and one row at least, so that memory is bounded."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(col)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > budget:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task shouldn't hold old batches


def positions(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with ``pos``, each row's 0-based place in the total order of ``order`` (named columns come first).

    Rows are dealt to key ranges and stored once, with the range's number, so
    that every later step sees the same ranges; a row's place is its place in
    its range plus the rows of the ranges before.  No task holds more than one
    range; the table of ranges has one short row each.
    """
    dealt = df.repartitionByRange(partitions_of(df), *order).withColumn("__range", F.spark_partition_id())
    dealt = stored(dealt, name)
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = dealt.withColumn("__i", F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1)
    return local.join(offsets, "__range").withColumn("pos", F.col("__before") + F.col("__i")).drop("__range", "__i", "__before")
