"""Operator 11, importance resampling towards a target text: hashed n-grams of whole batches at once."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.llm.common import pieces, positions, stored

BUCKETS, LONGEST, LEAST_WORDS = 10_000, 3, 20
#: Bytes of the texts that are joined for one regular expression pass, and words of it that are held at a time.
JOINED, WORDS = 4 << 20, 1 << 18
#: Fixed value: in UTF-8, lower-cased, the bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F].  A NUL byte parts documents.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SENTINEL = b"\x00"


def _byte_table() -> np.ndarray:
    """CRC-32's step for a byte, from its reversed polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def _shift_tables(bits: int = 34) -> np.ndarray:
    """For each power of two, what that many zero bytes after it make of a CRC, by the CRC's four bytes: a linear map,
    of which each is the one before applied twice."""
    step = _byte_table()
    tables = np.empty((bits, 4, 256), np.uint32)
    for j in range(4):
        x = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
        tables[0, j] = step[x & 255] ^ (x >> np.uint32(8))
    for b in range(1, bits):
        for j in range(4):
            tables[b, j] = _through(tables[b - 1], tables[b - 1, j])
    return tables


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]


_STEP, _SHIFT = _byte_table(), _shift_tables()


def joined_crc(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings with a space between them, from both CRCs and the second string's bytes."""
    c = ~a
    c = ~(_STEP[(c ^ np.uint32(32)) & 255] ^ (c >> np.uint32(8)))
    bit = 0
    while (left := size >> bit).any():
        some = np.flatnonzero(left & 1)
        c[some] = _through(_SHIFT[bit], c[some])
        bit += 1
    return c ^ b


def features(texts: list[bytes], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents and buckets of all n-grams of a batch of texts, and the documents of its words, a block of words at a time.

    The texts are joined by a byte that no word holds, so that one pass finds
    the words of all; the document of a word is the last one that starts
    before it, and n-grams whose words differ in it are left out.  A block
    keeps the last words of the one before, for the n-grams that cross.
    """
    data = _SENTINEL.join(texts).lower()  # of bytes: A to Z only
    starts = np.cumsum([0] + [len(t) + len(_SENTINEL) for t in texts[:-1]])
    found = _WORD.finditer(data)
    held = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    while block := [(m.start(), m.group()) for m in islice(found, WORDS)]:
        at, words = zip(*block, strict=True)
        n, first = len(words), len(held[0])
        new = (np.fromiter(map(zlib.crc32, words), np.uint32, n), np.fromiter(map(len, words), np.int64, n),
               np.searchsorted(starts, at, side="right") - 1)
        crc, size, doc = (np.concatenate([h, x]) for h, x in zip(held, new, strict=True))
        docs, grams, run = [doc[first:]], [crc[first:]], crc
        for k in range(1, LONGEST):
            run = joined_crc(run[:-1], crc[k:], size[k:])  # of k + 1 words, at the place of the last one
            within = doc[k:] == doc[:-k]
            within[:max(0, first - k)] = False
            docs.append(doc[k:][within])
            grams.append(run[within])
        yield np.concatenate(docs), np.concatenate(grams).astype(np.int64) % buckets, new[2]
        held = tuple(x[-(LONGEST - 1):] for x in (crc, size, doc))


def _batches(batches, col: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for part in pieces(batch, col, JOINED):
            yield part, [t if t is not None else b"" for t in part.column(col).cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all whole texts (column ``text``) fall into each bucket.  Tasks count for themselves; what
    is shuffled is a row a task and bucket, and what reaches the driver one number a bucket."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for _, some in _batches(batches, "text"):
            for _, bucket, _ in features(some, buckets):
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    rows = (texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
                 .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the target's smoothed share over the source's), a bucket."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(float(b + 1) * (s + n) / (float(a + 1) * (t + n))))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    per = docs.sparkSession.sparkContext.broadcast(gain)  # a number a bucket, whatever the data

    def run(batches):
        for part, some in _batches(batches, "text"):
            n = part.num_rows
            words, counts, sums = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for doc, bucket, own in features(some, len(per.value)):
                words += np.bincount(own, minlength=n)
                counts += np.bincount(doc, minlength=n)
                sums += np.bincount(doc, per.value[bucket], minlength=n).astype(np.int64)  # exact: far below 2 to the 53
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words), pa.array(counts), pa.array(sums)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, seed: int = 42, percent: int = 5) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text), drawn towards ``target`` (text).

    Two passes over the texts: one counts the features of all documents by
    bucket, one sums each document's gains.  A score is the weight plus Gumbel
    noise from the seed and the id, so that the highest ones are a draw without
    replacement by weight.  Of the documents of LEAST_WORDS words at least,
    ``percent`` of a hundred are ranked; ranks come from key ranges of narrow
    rows, so that no task sorts more than a range.

    Null or empty text: no features, weight 0.  Null id: as an empty one, last
    of equal scores.  Rows that repeat an id are rows of their own, with equal
    noise; those of equal score are ordered by n_features.  Equal rows are
    ranked in any order.  No target text: T is 0.  Empty table: no rows.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))
    rows = stored(weights(docs, gain).withColumn("score", F.col("weight") + noise), "weights")
    enough = F.col("n_words") >= LEAST_WORDS
    drawn = percent * rows.filter(enough).count() // 100
    placed = positions(rows.filter(enough), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")], "draw")
    ranked = placed.withColumn("rank", F.when(F.col("pos") < drawn, F.col("pos") + 1).cast("long"))
    rest = rows.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*out).unionByName(rest.select(*out))


#: CRC-32 byte by byte, on the distinct features; the same noise from the same digest.
ORACLE = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)
, texts AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
            UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark)
, words AS (SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts)
, grams AS (SELECT side, r, unnest(list_concat(w,
               list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
               list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM words)
, counted AS (SELECT side, r, g, count(*) AS n FROM grams GROUP BY ALL)
, digits AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM counted))
, bucket AS (SELECT g, xor(list_reduce(list_transform(range(0, len(x) // 2),
                 lambda i: CAST(('0x' || substr(x, 2 * i + 1, 2)) AS BIGINT)),
                 lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 10000 AS b FROM digits, tab)
, per AS (SELECT b, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
          FROM counted JOIN bucket USING (g) GROUP BY b)
, gain AS (SELECT b, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT sum(s) FROM per) + 10000)
               / ((CAST(s AS DOUBLE) + 1) * ((SELECT sum(t) FROM per) + 10000)))) AS BIGINT) AS v FROM per)
, weighed AS (SELECT r, sum(n) AS n_features, sum(n * v) AS weight
              FROM counted JOIN bucket USING (g) JOIN gain USING (b) WHERE side = 'd' GROUP BY r)
, scored AS (SELECT r, doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
                      + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
             FROM words LEFT JOIN weighed USING (r) WHERE side = 'd')
, placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= (SELECT 5 * count(*) // 100 FROM placed) THEN k END AS rank
FROM scored LEFT JOIN placed USING (r)
"""
