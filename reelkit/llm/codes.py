"""Operator 13, vector codes by product quantisation: Lloyd's rounds that compare only what moved."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelkit.llm.common import emptied, shared_path

#: Integer components of a batch that a task looks at together.
BLOCK = 1 << 20

_STATE = "vec_id long, v array<int>, code binary, dist array<long>, sums array<long>"


def nearest(v: np.ndarray, book: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest of some entries of one part's codebook, the lower index on ties, and its squared distance."""
    d = np.stack([((v - book[e]) ** 2).sum(axis=1) for e in entries], axis=1)
    j = d.argmin(axis=1)
    return entries[j], d[np.arange(len(v)), j]


def assign(v: np.ndarray, old: np.ndarray | None, new: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[int, int]:
    """Move ``code`` and ``dist`` (rows x parts) from the codebooks ``old`` to ``new``, in place.

    Where a part's own entry stayed as it was, its stored distance still
    holds and no entry that stayed can have become nearer, so that only moved
    entries are compared.  Other parts, and all of them in the first round
    (``old`` is None), compare every entry.  Returns how many distances each
    of the two ways took.
    """
    everything = np.arange(new.shape[1])
    few = full = 0
    for p in range(new.shape[0]):
        moved = np.ones(new.shape[1], bool) if old is None else (old[p] != new[p]).any(axis=1)
        again = moved[code[:, p]]
        if again.any():
            code[again, p], dist[again, p] = nearest(v[again, p], new[p], everything)
            full += int(again.sum()) * len(everything)
        stayed, those = np.flatnonzero(~again), np.flatnonzero(moved)
        if len(stayed) and len(those):
            e, d = nearest(v[stayed, p], new[p], those)
            held, far = code[stayed, p], dist[stayed, p]
            better = (d < far) | (d == far) & (e < held)
            code[stayed[better], p], dist[stayed[better], p] = e[better], d[better]
            few += len(stayed) * len(those)
    return few, full


def _round(old: np.ndarray | None, new: np.ndarray, last: bool):
    """One pass over the rows: new codes and distances, and at a task's end one row of the sums for the next codebooks."""
    parts, entries, width = new.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for whole in batches:
            step = max(1, BLOCK // (parts * width))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                n = batch.num_rows
                v = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, width)
                if old is None:
                    code, dist = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
                else:
                    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                    dist = batch.column("dist").flatten().to_numpy(zero_copy_only=False).reshape(n, parts).copy()
                assign(v, old, new, code, dist)
                if not last:
                    for p in range(parts):
                        of = np.zeros((n, entries))
                        of[np.arange(n), code[:, p]] = 1
                        total[p, :, :width] += (of.T @ v[:, p].astype(float)).astype(np.int64)  # exact: below 2 to the 53
                        total[p, :, width] += of.sum(axis=0).astype(np.int64)
                rows = code.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id"), batch.column("v"), pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.array(list(dist), pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64())),
                    *(batch.column(c) for c in ("label", "labelled"))],
                    names=["vec_id", "v", "code", "dist", "sums", "label", "labelled"])
        if not last and total[:, :, width].any():
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.nulls(1, pa.int64()), "v": pa.nulls(1, pa.list_(pa.int32())), "code": pa.nulls(1, pa.binary()),
                "dist": pa.nulls(1, pa.list_(pa.int64())), "sums": pa.array([total.ravel()], pa.list_(pa.int64())),
                "label": pa.nulls(1, pa.string()), "labelled": pa.nulls(1, pa.bool_())})
    return run


def _next(sums: DataFrame, old: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each used entry the floor of its parts' mean, by component.  What reaches the driver
    is one number a part, entry and component."""
    parts, entries, width = old.shape
    rows = (sums.filter(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("at", "x"))
                .groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
    total = [0] * (parts * entries * (width + 1))
    for r in rows:
        total[r["at"]] = int(r["x"])
    new = old.copy()
    for p in range(parts):
        for e in range(entries):
            at = (p * entries + e) * (width + 1)
            if total[at + width]:
                new[p, e] = [x // total[at + width] for x in total[at:at + width]]
    return new


def whole_numbers(x: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of every component as an int, held within plus or minus ``limit``."""
    held = lambda c: F.greatest(F.lit(float(-limit)), F.least(F.lit(float(limit)), F.lit(float(scale)) * c.cast("double")))
    return F.transform(x, lambda c: F.floor(held(c)).cast("int"))


def codes(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row of ``vectors`` (vec_id, embedding, label).

    Rounds are passes over a Parquet table in the shared folder that holds
    each row's integer vector, its codes and their exact distances; a task
    adds its sums as one more row of the table, so that a round reads the
    vectors once, and an executor that is lost costs only its tasks.  The
    round before is emptied when the next one is written.  On the driver are
    the codebooks alone (parts x entries x width numbers).

    Rows whose vector is null or empty, or holds null or non-finite
    components, take no part and aren't returned.  Neither are vectors of
    another length than that of the smallest vec_id.  A length that the parts
    don't divide is filled up with zeros, which show in no distance.
    Components are held within plus or minus 2 to the 30, divided by the root
    of the length (32,767 times the scale of 4,096 for 64 of them), so that
    every distance is an exact 64-bit number.  Repeated ids are rows of their
    own; among equal ids the smaller vector comes first.  A null vec_id comes
    last.  Fewer kept rows than entries: as many entries.  Null labels are
    one label.  Other columns aren't read.  Empty table: no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    x = F.col("embedding")
    order = [F.asc_nulls_last("vec_id"), F.asc("embedding")]
    good = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                           F.col("label").isNotNull().alias("labelled"), x)
                   .filter(x.isNotNull() & (F.size(x) > 0) & F.forall(x, good)))
    first = kept.orderBy(*order).select(F.size(x).alias("n")).limit(1).collect()
    out = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if not first:
        return spark.createDataFrame([], out)
    length = first[0]["n"]
    width = -(-length // parts)
    ints = whole_numbers(x, scale, int(2 ** 30 / math.sqrt(length)))
    rows = kept.filter(F.size(x) == length).select(
        "vec_id", "label", "labelled", "embedding",
        (ints if width * parts == length else F.concat(ints, F.array_repeat(F.lit(0), width * parts - length))).alias("v"))
    start = rows.orderBy(*order).limit(entries).select("v").collect()
    new = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    old, state, path = None, rows.select("vec_id", "v", "label", "labelled"), None
    schema = f"{_STATE}, label string, labelled boolean"
    for r in range(rounds + 1):
        last = r == rounds
        following = shared_path(spark, "codes")
        state.mapInArrow(_round(old, new, last), schema).drop(*(("v",) if last else ())).write.parquet(following)
        if path:
            emptied(spark, path)
        written, path = spark.read.parquet(following), following
        old = new
        if not last:
            new = _next(written, old)
            state = written.filter(F.col("sums").isNull()).drop("sums")
    pad = width * parts - length
    flat = old if not pad else [[e for e in book] for book in old[:-1]] + [[e[:width - pad] for e in old[-1]]]
    digest = hashlib.sha256(",".join(str(int(c)) for book in flat for e in book for c in e).encode()).hexdigest()
    coded = written.select("vec_id", F.lower(F.hex("code")).alias("code"),
                           F.aggregate("dist", F.lit(0).cast("long"), lambda s, d: s + d).alias("error"), "label", "labelled")
    sums = coded.groupBy(F.col("label").alias("of"), F.col("labelled").alias("is")).agg(F.try_sum("error").alias("label_error"))
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("labelled") == F.col("is")))
                 .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """DuckDB SQL for the same rows: every round compares every entry."""
    ctes = [f"""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
, part AS (
  SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v
  FROM kept CROSS JOIN (SELECT unnest(range({parts})) AS p))
, c0 AS (SELECT p, r - 1 AS e, v FROM part WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        ctes.append(f"""
, a{k} AS (
  SELECT r, p, min(d * {entries} + e) AS m
  FROM (SELECT part.r, part.p, c.e,
               CAST(list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (part.v[i] - c.v[i]) * (part.v[i] - c.v[i]))) AS BIGINT) AS d
        FROM part JOIN c{k} c USING (p)) GROUP BY r, p)""")
        if k < rounds:
            ctes.append(f"""
, c{k + 1} AS (
  SELECT p, e, coalesce(n.v, c.v) AS v
  FROM c{k} c LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS v
    FROM (SELECT p, e, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
          FROM (SELECT p, m % {entries} AS e, unnest(part.v) AS x, unnest(range(len(part.v))) AS i FROM a{k} JOIN part USING (r, p))
          GROUP BY p, e, i) GROUP BY p, e) n USING (p, e))""")
    return "".join(ctes) + f"""
, rows AS (
  SELECT vec_id, label, code, error
  FROM kept JOIN (SELECT r, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
                  FROM a{rounds} GROUP BY r) USING (r))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM rows"""
