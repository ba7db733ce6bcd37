"""Score and vector expressions.

Vector functions work on ``array<double>`` columns with higher-order
functions, so they run inside codegen without a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weighted_rating(v, r, m, c) -> Column:
    """Bayesian weighted rating ``v/(v+m)*R + m/(m+v)*C``.

    ``try_divide`` turns the 0/0 of a zero-vote item at threshold 0 into NULL
    instead of an ANSI error.
    """
    v, r, m, c = _c(v), _c(r), _c(m), _c(c)
    return F.try_divide(v, v + m) * r + F.try_divide(m, m + v) * c


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def euclidean(a, b) -> Column:
    """Euclidean distance of two equal-length arrays."""
    a, b = _c(a), _c(b)
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0), lambda s, v: s + v))


def cosine(a, b) -> Column:
    """X11: cosine of two arrays; NULL when either is the zero vector."""
    a, b = _c(a), _c(b)
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def pearson(a, b) -> Column:
    """Pearson correlation of two arrays; NULL when either side is constant."""
    a, b = _c(a), _c(b)
    n = F.size(a).cast("double")
    ma, mb = _sum(a) / n, _sum(b) / n
    da = F.transform(a, lambda x: x - ma)
    db = F.transform(b, lambda x: x - mb)
    den = F.sqrt(_dot(da, da)) * F.sqrt(_dot(db, db))
    return F.when(den > 0, _dot(da, db) / den)
