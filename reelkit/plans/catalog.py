"""Query catalogue: every implemented operator as (Spark query, DuckDB oracle SQL).

Keys follow SURVEY §2 ids (``<ID>_<slug>``).  Each Spark query takes
``(spark, sf_dir)`` and reads the driver tables through ``sources.proxy``;
each oracle is independent DuckDB SQL over the same tables.  Floats are
rounded to 6 places on both sides; every top-k has a total order.
Queries without an oracle (model fits, iterative algorithms) are listed with
``None`` and get the driver's rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkit.sources import proxy

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


def r6(c) -> Column:
    """Round a float column to 6 places (the comparison precision)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def W(*views: str) -> str:  # noqa: N802 - reads like SQL's WITH
    return proxy.sql_with(*views)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from reelkit.plans import (queries_charts, queries_content, queries_files, queries_hybrid,  # noqa: F401
                               queries_mining, queries_ratings)
