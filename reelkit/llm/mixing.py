"""Operator 9, mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelkit.llm.common import WORD_PATTERN, positions, stored, text_or_empty

#: Offsets that are tried; that with the taken words nearest a source's target is kept.
OFFSETS = 32
#: A multiplier whose multiples spread evenly over 2^32.
SPREAD, RANGE = 2654435761, 4294967296


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target from (source, source_size): ``share`` of all words dealt by weight, none above ``cap``.

    Sources in code-point order, null last, take ``weights`` in turn.  A source
    whose share by weight would exceed ``cap`` times its size stops there, and
    the excess goes to the others by weight, again and again.  With sources
    sorted by cap / weight those that stop are the first ones, so one pass of
    running sums finds the final level; the table has a row a source.
    """
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % n + 1)
    s = sizes.select("source", "source_size", w.alias("weight"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = ((share * F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0)))
             / F.sum("weight").over(rest))
    s = s.withColumn("level", level).withColumn("stops", cap * F.col("source_size") <= F.col("level") * F.col("weight"))
    final = F.coalesce(F.max(F.when(~F.col("stops"), F.col("level"))).over(whole), F.lit(float("inf")))
    return s.select("source", "source_size",
                    F.least(cap * F.col("source_size"), F.when(F.col("source_size") > 0, final * F.col("weight")).otherwise(0.0))
                    .cast("double").alias("target"))


def _offset(k, seed: int):
    return ((k + 1) * F.lit(SPREAD) + F.lit(seed)) % F.lit(RANGE) / F.lit(float(RANGE))


def _copies(i, rate, offset):
    """Integer boundaries that the running sum of expected copies crosses in document ``i`` (from 0) of its source."""
    return F.floor(rate * (i + 1) + offset) - F.floor(rate * i + offset)


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        seed: int = 42, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document (and ``keep``'s columns).

    Each document of a source expects target / source_size copies.  In order of
    size, the largest first (ties: doc_id, then text), a document gets a copy for
    each integer that the running sum, shifted by the source's offset, crosses
    in it; a source's words then miss its target by less than its largest
    document.  Of ``OFFSETS`` seeded offsets the one nearest the target is kept.

    Null or empty text: size 0, taken 0 (copies as any).  Null source: a source of its own, last.
    Repeated rows count as documents each.  Empty table: no rows.  Sources
    whose documents are all empty: target 0, no copies.  The same input gives
    the same result, whatever its partitions.
    """
    rows = docs.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD_PATTERN)).cast("long").alias("size"),
                       F.xxhash64(text_or_empty()).alias("__tie"), *keep)
    placed = positions(rows, [F.asc_nulls_last("source"), F.desc("size"), F.asc("doc_id"), F.asc("__tie")], "mix")
    by_source = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by_source = stored(by_source, "sources")
    order = Window.orderBy(F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    starts = by_source.select("source", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    plan = targets(by_source, weights, share, cap)
    plan = (plan.join(starts, plan.source.eqNullSafe(starts.source)).drop(starts.source)
                .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))
    plan = stored(plan, "plan")

    def with_plan(rows, plan):
        p = plan.withColumnRenamed("source", "__source")
        return rows.join(p, rows.source.eqNullSafe(p["__source"])).drop("__source").withColumn("i", F.col("pos") - F.col("first"))

    k = F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1))).alias("k")
    tried = (with_plan(placed.select("source", "size", "pos"), plan)
             .select("source", "size", "i", "rate", "target", k)
             .groupBy("source", "target", "k")
             .agg(F.sum(F.col("size") * _copies(F.col("i"), F.col("rate"), _offset(F.col("k"), seed))).alias("words")))
    best = (tried.groupBy("source").agg(F.min(F.struct(F.abs(F.col("words") - F.col("target")), "k")).alias("b"))
                 .select(F.col("source").alias("s"), _offset(F.col("b.k"), seed).alias("offset")))
    plan = plan.join(best, plan.source.eqNullSafe(best.s)).drop("s")
    copies = F.least(_copies(F.col("i"), F.col("rate"), F.col("offset")), F.lit(int(cap))).cast("long")
    return (with_plan(placed, plan).withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), *keep))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents)
, s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
, s1 AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s0)
, s2 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
           - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1)
, s3 AS (SELECT *, max(level) FILTER (WHERE 2.0::DOUBLE * source_size > level * w) OVER () AS fin FROM s2)
, s4 AS (SELECT source, source_size, least(2.0::DOUBLE * source_size,
           CASE WHEN source_size > 0 THEN coalesce(fin, 'Infinity'::DOUBLE) * w ELSE 0 END)::DOUBLE AS target FROM s3)
, s AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END::DOUBLE AS rate FROM s4)
, p AS (SELECT d.doc_id, d.size, s.*, (row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id) - 1) AS i
        FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)
, u AS (SELECT k, ((k + 1) * 2654435761 + 42) % 4294967296 / 4294967296.0::DOUBLE AS off FROM range(32) t(k))
, tried AS (SELECT source, target, k, sum(size * (floor(rate * (i + 1) + off) - floor(rate * i + off))) AS words
            FROM p CROSS JOIN u GROUP BY source, target, k)
, best AS (SELECT source, arg_min(k, abs(words - target) * 64 + k * 1e-9) AS k FROM tried GROUP BY source)
SELECT p.doc_id, p.source, p.size::BIGINT AS size, p.source_size, p.target,
       (floor(rate * (i + 1) + off) - floor(rate * i + off))::BIGINT AS copies,
       (p.size * (floor(rate * (i + 1) + off) - floor(rate * i + off)))::BIGINT AS taken
FROM p JOIN best b ON p.source IS NOT DISTINCT FROM b.source JOIN u ON u.k = b.k
"""
