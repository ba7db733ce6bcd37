"""Operator 6, token counts by a digest cache."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.llm import vocab
from reelkit.llm.common import pieces, text_or_empty, texts, utf8_bytes

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"


def normalised(text):
    """Content whose count is stored: white space in lines as spaces where the tokenizer drops it anyway."""
    return F.translate(text, "\n\t\r", "   ")


def _counted(path: str, tokenizer: str):
    def run(batches):
        count = vocab.counter(path).counts
        for batch in batches:
            for part in pieces(batch, "content", 8 << 20):
                yield pa.RecordBatch.from_pydict({
                    "tokenizer": pa.array([tokenizer] * part.num_rows, pa.string()),
                    "digest": part.column("digest").cast(pa.string()),
                    "n_tokens": pa.array(count(texts(part, "content")), pa.int64())})
    return run


def read_cache(spark, cache: str) -> DataFrame:
    """The stored counts; an empty table where nothing has been stored yet."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    there = jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache) if there else spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(docs: DataFrame, vocabulary: str, cache: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text).

    The SHA-256 of the normalised content and of the tokenizer file are joined
    to the counts stored in the Parquet table at ``cache`` (a path on storage
    that all executors share); distinct contents without one are encoded, once
    each, and appended.  Rows of equal content are combined before the shuffle,
    so a group of copies moves one row a task.

    Null text: empty, 0 tokens.  Repeated ids or rows: a row each.  Empty
    table: no rows.  Other columns of ``docs`` are not read.  A run that dies
    before its append stores nothing; counts that two runs append twice are
    equal, and the look-up takes one of them.
    """
    spark = docs.sparkSession
    version = vocab.file_digest(vocabulary)
    text = text_or_empty()
    # word files drop white space, others keep it: only the former share counts between its kinds
    content = normalised(text) if isinstance(vocab.counter(vocabulary), vocab.WordCounts) else text
    keyed = docs.select("doc_id", utf8_bytes(text).alias("n_bytes"), F.sha2(content, 256).alias("digest"))
    stored = read_cache(spark, cache).filter(F.col("tokenizer") == version)
    misses = (docs.select(content.alias("content")).select("content", F.sha2("content", 256).alias("digest"))
                  .groupBy("digest").agg(F.first("content").alias("content"))
                  .join(stored.select("digest").distinct(), "digest", "left_anti"))
    misses.mapInArrow(_counted(vocabulary, version), CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = (read_cache(spark, cache).filter(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return (keyed.join(counts, "digest")
                 .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
