"""The corpus pipeline: low-quality documents go, near duplicates go, repeated passages go, sources are mixed, text is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each one's rows to the shared folder and reads them again as the next one's
``docs``.  All but the last return the columns of ``docs``, whatever these are
called, and every row that they keep.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelkit.llm import mixing, pieces_bpe, quality, simhash, suffixes, vocab
from reelkit.llm.common import stored, table

#: Documents of a lower score are rejected.
QUALITY = 0.7


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def _column(name: str):
    return F.col(f"`{name}`")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score by operator 4, fitted on the labels that are not held out, is QUALITY at least.  Without any
    label nothing can be told from anything, and all rows stay."""
    labels = table(spark, sf_dir, "labels")
    if labels.filter(F.col("quality").isNotNull() & ~quality.held_out()).isEmpty():
        return docs
    score = _free(docs, "score")
    return quality.with_score(docs, quality.fit(docs, labels), score).filter(_column(score) >= QUALITY).drop(score)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component by operator 2 (three-word shingles, 3 bits) one row: that of the smallest id, and of rows that
    share that id the one of least text hash.  Components are of rows, so texts that share an id stay or go each by its
    own.  Rows without an id are judged among themselves, and of each component one stays."""
    alone, number, digest, nth = (_free(docs, c) for c in ("alone", "number", "digest", "nth"))
    given = F.col("doc_id").cast("long")
    keyed = docs.withColumns({alone: given.isNull(), number: F.coalesce(given, F.lit(0)), digest: F.xxhash64("text")})
    key = [_column(c) for c in (alone, number, digest)]
    once = keyed.withColumn(nth, F.row_number().over(Window.partitionBy(*key).orderBy(key[-1]))).filter(_column(nth) == 1)
    first = simhash.one_of_each(docs).toDF(alone, number, digest)
    return once.join(first, [alone, number, digest], "left_semi").select(*[_column(c) for c in docs.columns])


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without the strings of 100 bytes that stand earlier (operator 1), n_chars made anew.
    Characters that a removal cuts in two go too.  A null text becomes empty."""
    found = suffixes.remove_repeats(docs, full=True)
    new = {"text": F.col("kept_text").cast("string"), "n_chars": F.char_length("kept_text").cast("long")}
    return found.select(*[new.get(c, F.col("others").getField(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as operator 9 takes it: none, once or twice.

    The operator sees no more of a row than its size and a key; texts are dealt
    once, by that key, to meet their number of copies.  Rows of one key (same
    id, source and text) share their copies evenly."""
    key, nth, copies, many = (_free(docs, c) for c in ("row_key", "nth", "copies", "many"))
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("source").isNull(), "source", F.col("text").isNull(), "text"))
    taken = (mixing.mix(keyed.select("doc_id", "text", "source", F.col(key).alias("row_key")), keep=("row_key",))
             .groupBy(F.col("row_key").alias(key)).agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(many)))
    rows = keyed.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(key))).join(taken, key)
    upto = lambda n: F.floor(n * F.col(copies) / F.col(many))
    own = (upto(F.col(nth)) - upto(F.col(nth) - 1)).cast("int")
    return rows.withColumn(nth, F.explode(F.array_repeat(F.lit(1), own))).select(*[_column(c) for c in docs.columns])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row (operator 7)."""
    return pieces_bpe.encode_decode(docs, vocab.vocabulary_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: No SQL: XXH64, the fitted machine and the vocabulary have none; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
