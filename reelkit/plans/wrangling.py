"""Data-wrangling demo as operators (DW): subset, clean, year, filter, stats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.operators.relational import exact_quantile

from reelkit.functions.clean import to_double, year_string


def subset(df: DataFrame, columns) -> DataFrame:
    """Column subset (missing columns raise, as a projection should)."""
    return df.select(*columns)


def subset_existing(df: DataFrame, required, optional) -> DataFrame:
    """The required columns plus those optional ones that exist."""
    return df.select(*required, *[c for c in optional if c in df.columns])


def clean_numeric(df: DataFrame, column: str) -> DataFrame:
    """P4 applied in place."""
    return df.withColumn(column, to_double(column))


def with_year(df: DataFrame, date_col: str = "release_date") -> DataFrame:
    """Year as text (NULL without a date)."""
    return df.withColumn("year", year_string(date_col))


def high_revenue(df: DataFrame, revenue_threshold: float = 1e9, budget_threshold: float | None = None) -> DataFrame:
    """revenue above a threshold and, when a budget cap is given (0/None = not given),
    budget below it."""
    cond = F.col("revenue") > revenue_threshold
    if budget_threshold:
        cond = cond & (F.col("budget") < budget_threshold)
    return df.filter(cond)


def runtime_stats(df: DataFrame, column: str = "runtime") -> DataFrame:
    """A5: min / max."""
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def budget_stats(df: DataFrame, column: str = "budget") -> DataFrame:
    """Mean and median."""
    return df.agg(F.avg(column).alias("mean")).withColumn("median", exact_quantile(df, column, 0.5))


def year_histogram(df: DataFrame, year_col: str = "year", first: int = 10) -> DataFrame:
    """A4: counts per year, sorted by year, NULL excluded, first n."""
    return (df.filter(F.col(year_col).isNotNull()).groupBy(year_col)
              .agg(F.count(F.lit(1)).alias("n")).orderBy(year_col).limit(first))
