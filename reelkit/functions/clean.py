"""Cleaning expressions for dirty catalogue text.

All are plain Column expressions, so they stay inside whole-stage codegen.
ANSI mode is on in Spark 4, so every cast of dirty text is guarded or a
``try_`` form; nothing here changes session configuration.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (the rules adopted in SURVEY §8 D15 and P5).
NUMERIC_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER_PATTERN = r"^[+-]?\d+$"
TITLE_YEAR_PATTERN = r"\((\d{4})\)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Text -> double; anything that is not a plain decimal/exponent number -> NULL.

    ``nan``, ``inf``, ``1_000``, ``1.0d`` and paths are rejected on purpose.
    """
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(NUMERIC_PATTERN), t.try_cast("double"))


def to_bigint_id(c) -> Column:
    """P5: text -> bigint id, NULL when not an integer literal."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(INTEGER_PATTERN), t.try_cast("bigint"))


def to_int_or_zero(c) -> Column:
    """Value -> int, 0 when it is not an integer (or too large)."""
    t = F.trim(_c(c).cast("string"))
    return F.coalesce(F.when(t.rlike(INTEGER_PATTERN), t.try_cast("int")), F.lit(0))


def to_date(c) -> Column:
    """P10: text -> date (accepts 1- or 2-digit month/day), bad -> NULL."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(t, F.lit("yyyy-M-d"))).cast("date")


def year_string(c) -> Column:
    """Year of a date text as a string, NULL when there is no date."""
    return F.date_format(to_date(c), "yyyy")


def year_int(c) -> Column:
    """Year of a date text as int, 0 when there is no date."""
    return F.coalesce(F.year(to_date(c)), F.lit(0))


def title_year(c) -> Column:
    """Trailing ``(YYYY)`` of a title as text, NULL when absent."""
    return F.nullif(F.regexp_extract(_c(c), TITLE_YEAR_PATTERN, 1), F.lit(""))


def id_text(c) -> Column:
    """Id as text for cross-source joins; '862.0' -> '862'."""
    t = F.trim(_c(c).cast("string"))
    as_num = F.when(t.rlike(NUMERIC_PATTERN), t.try_cast("double"))
    return F.coalesce(
        F.when(as_num.isNotNull() & (as_num == F.floor(as_num)), as_num.cast("bigint").cast("string")),
        t)


def sanitize(c) -> Column:
    """Drop spaces and lower-case a string, or every element of an array of strings."""
    col = _c(c)
    return F.lower(F.replace(col, F.lit(" "), F.lit("")))


def sanitize_array(c) -> Column:
    return F.transform(_c(c), lambda x: F.lower(F.replace(x, F.lit(" "), F.lit(""))))
