"""Relational building blocks shared by the recommenders.

Scale notes
-----------
* Global scalars (a percentile, a mean) are scalar subqueries: Spark runs a
  partial/final aggregate once and folds the value into the filter; nothing
  is collected by library code and no data-sized table is broadcast.
* Per-group top-N uses ``row_number() <= n``; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so a hot group ships at most
  n rows per map partition.
* Exact positions inside groups (stratified split, surrogate ids) cut big
  groups into deterministic slices (hash prefixes, key ranges) so a group
  holding a third of all rows is numbered by many tasks; a small per-slice
  count table gives the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelkit.session import cut_lineage, emptied, stored_at


def _cols(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


# --------------------------------------------------------------------------
# scalars and percentile filters
# --------------------------------------------------------------------------

def quantile(col, p: float, exact: bool = True, accuracy: int = 100_000) -> Column:
    """Quantile with linear interpolation (exact) or the approximate sketch."""
    c = F.col(col) if isinstance(col, str) else col
    return F.percentile(c, p) if exact else F.percentile_approx(c, p, accuracy).cast("double")


#: Rows among which one task may order values to find a rank.
ORDERED = 100_000


def values_at_ranks(v: DataFrame, n: int, ranks: set[int], accuracy: int = 10_000, ordered: int = ORDERED) -> dict[int, float]:
    """rank -> value, for neighbouring 0-based ranks in the order of the column ``_v`` of ``v`` (``n`` rows, no nulls).

    A mergeable sketch brackets the ranks by two values; copies of these are
    counted, so that either they hold a rank or it lies among the values
    strictly between, some thousandth of the rows.  These are bracketed again,
    until ``ordered`` of them at most are left for one task to order.  Every
    step is an aggregate without a shuffle of rows; the driver sees one row.
    """
    found, below, lo, hi, slack = {}, 0, float("-inf"), float("inf"), 2.0 / accuracy
    x = F.col("_v")
    # Spark's order: NaN above all, infinities are values as any
    inside, m = v, n
    while left := sorted(ranks - found.keys()):
        if m <= ordered:
            upto = F.sum("_k").over(Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
            got = (inside.groupBy("_v").agg(F.count(F.lit(1)).alias("_k")).withColumn("_upto", upto)
                   .agg(*[F.min(F.when(F.col("_upto") > r - below, x)) for r in left]).first())
            return found | dict(zip(left, got, strict=True))
        share = [max(0.0, (left[0] - below) / m - slack), min(1.0, (left[-1] + 1 - below) / m + slack)]
        lo, hi = inside.agg(F.percentile_approx("_v", share, accuracy).alias("q")).first()["q"]
        count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
        less, low, between, high = inside.agg(count(x < lo), count(x == lo), count((x > lo) & (x < hi)), count(x == hi)).first()
        if lo == hi:
            high = 0
        first, second, third = below + less, below + less + low, below + less + low + between
        if left[0] < first or left[-1] >= third + high:
            slack *= 4
            continue
        found |= {r: lo for r in left if r < second} | {r: hi for r in left if r >= third}
        inside, m, below = inside.filter((x > lo) & (x < hi)), between, second
    return found


def exact_quantiles(df: DataFrame, col, ps: Sequence[float], accuracy: int = 10_000, ordered: int = ORDERED) -> list[float | None]:
    """Exact quantiles of one column with linear interpolation; None without values.

    ``F.percentile`` gathers every distinct value in its final task.  Here the
    column alone is stored once, as the plan above it may be dear, and all
    passes of all quantiles read that table (``values_at_ranks``).
    """
    c = F.col(col) if isinstance(col, str) else col
    v, path = stored_at(df.select(c.cast("double").alias("_v")).filter(F.col("_v").isNotNull()))
    n, out = v.count(), []
    for p in ps:
        rank = (n - 1) * p
        if not n:
            out.append(None)
            continue
        low, high = math.floor(rank), math.ceil(rank)
        at = values_at_ranks(v, n, {low, high}, accuracy, ordered)
        out.append(at[low] + (rank - low) * (at[high] - at[low]) if high > low else at[low])
    emptied(df.sparkSession, path)
    return out


def exact_quantile(df: DataFrame, col, p: float, accuracy: int = 10_000) -> Column:
    """One exact quantile (``exact_quantiles``) as a literal; NULL without values."""
    return F.lit(exact_quantiles(df, col, [p], accuracy)[0]).cast("double")


def scalar(df: DataFrame, expr: Column) -> Column:
    """One aggregate over a whole DataFrame as a scalar-subquery Column."""
    return df.select(expr).scalar()


def filter_at_least_quantile(df: DataFrame, col: str, p: float, scope: DataFrame | None = None,
                             exact: bool = True) -> DataFrame:
    """keep rows with ``col >= quantile(p)``.

    ``scope`` is the table the threshold is computed on: the whole catalogue
    (popularity chart) or the filtered matches (knowledge chart).
    """
    base = df if scope is None else scope
    m = exact_quantile(base, col, p) if exact else scalar(base, quantile(col, p, exact))
    return df.filter(F.col(col) >= m)


# --------------------------------------------------------------------------
# ordering and top-N
# --------------------------------------------------------------------------

def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """O2+O3: sort with a total order and keep the first n (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def cap_catalogue(df: DataFrame, max_items: int | None = None, by: str = "vote_count",
                  key: str = "id") -> DataFrame:
    """Keep the ``max_items`` rows with the largest ``by`` (ties by key);
    default None keeps everything - no hidden ceiling."""
    if max_items is None:
        return df
    return top_n(df, max_items, [F.desc_nulls_last(by), F.asc(key)])


def top_n_per_group(df: DataFrame, group, order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """First n rows of every group under a total order."""
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def sample_per_group(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """N pseudo-random rows per group, reproducible from the seed."""
    h = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
    return top_n_per_group(df, group, [h, F.col(key)], n, rank_col="pick")


# --------------------------------------------------------------------------
# exact positions inside groups, skew-safe
# --------------------------------------------------------------------------

def position_in_group(df: DataFrame, group, order: Sequence[str], slice_expr: Column,
                      pos_col: str = "pos") -> DataFrame:
    """1-based position of every row inside its group under ``order`` (a total order).

    A plain ``row_number().over(partitionBy(group))`` puts a whole group in one
    task.  Here each group is cut into slices by ``slice_expr``, which must be
    non-decreasing along ``order`` (e.g. a prefix of the hash the rows are
    ordered by, longer for bigger groups).  Rows are numbered inside their
    slice and shifted by the sizes of the earlier slices of the same group,
    taken from a small per-slice count table.  Everything is a deterministic
    function of the data, so the result is the same in every branch of a plan
    and after a task retry.
    """
    group = _cols(group)
    d = df.withColumn("_slice", slice_expr)
    counts = d.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = d.withColumn("_local", F.row_number().over(
        Window.partitionBy(*group, "_slice").orderBy(*order)))
    return (local.join(offsets, [*group, "_slice"])
                 .withColumn(pos_col, F.col("_off") + F.col("_local"))
                 .drop("_slice", "_off", "_local"))


def hash_slice(hex_hash: Column, group_size: Column, target: int = 100_000) -> Column:
    """Slice key for ``position_in_group`` when rows are ordered by a hex hash.

    Groups up to ``target`` rows get one slice (''); bigger ones use the first
    L hex digits with 16^L >= size/target, so slices stay near ``target`` rows.
    """
    digits = F.ceil(F.log(16.0, F.greatest(F.lit(1.0), group_size.cast("double") / target))).cast("int")
    return F.when(group_size <= target, F.lit("")).otherwise(F.substr(hex_hash, F.lit(1), digits))


def global_position(df: DataFrame, order: Sequence[Column], pos_col: str = "pos") -> DataFrame:
    """1-based position of every row under a total order, without a single-task window.

    Rows are range-partitioned by the data, so sparse keys make even slices,
    and stored once with their slice, so that counts and numbers see the same
    slices; the slice-count table has a row a partition.
    """
    dealt = cut_lineage(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
               .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    local = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return (dealt.withColumn("_local", local).join(offsets, "_slice")
                 .withColumn(pos_col, F.col("_off") + F.col("_local")).drop("_slice", "_off", "_local"))


def surrogate_id(df: DataFrame, order: str, id_col: str = "movieId") -> DataFrame:
    """Dense 1..n id following a key, without a single-task window."""
    return global_position(df, [F.asc(order)], id_col)


# --------------------------------------------------------------------------
# small relational helpers
# --------------------------------------------------------------------------

def frequency(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """A3: value counts (partial aggregation before the shuffle)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))


def first_per_key(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """One row per key, the one with the smallest id (deterministic 'first')."""
    return df.groupBy(key).agg(F.min(id_col).alias(id_col))


def keep_groups_with_at_least(df: DataFrame, group: str, k: int, fallback_all: bool = True) -> DataFrame:
    """keep rows of groups with >= k rows; with ``fallback_all`` keep everything
    when no group qualifies (the reference's 'cannot stratify' branch)."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_cnt"))
    qualifying = counts.filter(F.col("_cnt") >= k).select(group)
    kept = df.join(qualifying, group, "left_semi")
    if not fallback_all:
        return kept
    any_ok = F.coalesce(scalar(counts, F.max(F.col("_cnt")) >= k), F.lit(False))
    return kept.filter(any_ok).unionByName(df.filter(~any_ok))
