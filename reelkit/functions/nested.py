"""Nested python-literal lists stored as text.

Fast path: a JSON parse on the JVM after rewriting the python keywords
(``None/True/False``) that JSON spells differently; single quotes are accepted
by Spark's JSON reader.  Rows the JSON parser cannot read (escapes such as
``\\xa0``, tuples, ...) fall back to an Arrow-batched pandas UDF over the
standard-library ``ast.literal_eval``; it only sees the text that the fast path
left NULL, so the Python worker does no work on clean data.
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# One struct shape covers genres, keywords, cast and crew members.
MEMBER = StructType([StructField("name", StringType()), StructField("job", StringType())])
MEMBER_LIST = ArrayType(MEMBER)

_QUOTED = r"'[^'\\]*'|\"[^\"\\]*\""
_KEYWORD = r":\s*(?:None|True|False)(?=\s*[,}\]])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(StringType())
def _literal_to_json(s: pd.Series) -> pd.Series:
    """Python literal -> JSON text (NULL if it cannot be read)."""
    def one(x):
        if x is None:
            return None
        try:
            return json.dumps(ast.literal_eval(x), default=str)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None
    out = pd.Series(None, index=s.index, dtype=object)
    left = s.notna()
    if left.any():
        out[left] = s[left].map(one)
    return out


def parse_literal_list(c, schema=MEMBER_LIST) -> Column:
    """X1 fast path: python-literal list text -> typed array on the JVM.

    Rewrites ``None/True/False`` and parses as JSON (single quotes allowed).
    Lists of plain strings become members with that name.  NULL: text that the
    JSON reader cannot read, that holds escapes, or that has one of the
    keywords inside a string, where rewriting would change it.  Use
    ``with_parsed_literals`` to send exactly those rows through Python.
    """
    text = _c(c)
    bare = F.regexp_replace(text, _QUOTED, "''")
    plain = ~F.contains(text, F.lit("\\")) & (
        ~text.rlike(_KEYWORD) | (F.regexp_count(text, F.lit(_KEYWORD)) == F.regexp_count(bare, F.lit(_KEYWORD))))
    text = F.when(plain, text)
    jsonish = F.regexp_replace(text, r":\s*None(?=\s*[,}\]])", ": null")
    jsonish = F.regexp_replace(jsonish, r":\s*True(?=\s*[,}\]])", ": true")
    jsonish = F.regexp_replace(jsonish, r":\s*False(?=\s*[,}\]])", ": false")
    return _from_json(jsonish, schema)


def _from_json(text: Column, schema) -> Column:
    options = {"allowSingleQuotes": "true", "mode": "PERMISSIVE"}
    parsed = F.from_json(text, schema, options)
    if schema != MEMBER_LIST:
        return parsed
    strings = F.from_json(text, ArrayType(StringType()), options)
    return F.coalesce(parsed, F.transform(strings, lambda s: F.struct(
        s.alias("name"), F.lit(None).cast("string").alias("job"))))


def count_unreadable(parsed: DataFrame, raw: DataFrame, col: str) -> DataFrame:
    """One row, the number of texts that no parser could read (raw text there, parsed list NULL)."""
    there = raw.agg(F.count(col).alias("texts"))
    return there.join(parsed.agg(F.count(col).alias("lists"))).select((F.col("texts") - F.col("lists")).alias("unreadable"))


def with_parsed_literals(df: DataFrame, cols, schema=MEMBER_LIST, suffix: str = "") -> DataFrame:
    """X1 with the fallback: parse each column in ``cols`` into ``<col><suffix>``.

    Text that the JVM path could not read goes through ``ast.literal_eval`` in
    an Arrow pandas UDF, whose argument is NULL for all other rows: ``df`` is
    run once, and Python gets batches of NULLs where nothing is left to read.
    Text that even ``literal_eval`` rejects stays NULL (D22).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = df.select("*", *[parse_literal_list(c, schema).alias(c + suffix + "__p") for c in cols])
    for c in cols:
        fast = F.col(c + suffix + "__p")
        slow = _from_json(_literal_to_json(F.when(fast.isNull(), F.col(c))), schema)
        out = out.withColumn(c + suffix + "__p", F.coalesce(fast, slow))
    for c in cols:
        out = out.withColumnRenamed(c + suffix + "__p", c + suffix) if suffix else \
            out.drop(c).withColumnRenamed(c + "__p", c)
    return out


def names(c) -> Column:
    """List of ``{name: ...}`` -> list of names."""
    return F.transform(_c(c), lambda x: x["name"])


def names_lower(c) -> Column:
    """List of structs -> lower-cased names; non-list -> empty array."""
    return F.coalesce(F.transform(_c(c), lambda x: F.lower(x["name"])),
                      F.array().cast("array<string>"))


def director(c) -> Column:
    """First crew member whose job is 'Director', else NULL."""
    return F.try_element_at(F.filter(_c(c), lambda m: m["job"] == "Director"), F.lit(1))["name"]


def first_names(c, n: int = 3) -> Column:
    """First n names of a list of structs; non-list -> empty array."""
    return F.coalesce(F.slice(names(c), 1, n), F.array().cast("array<string>"))


def soup(keywords, cast, director_col, genres) -> Column:
    """Keywords, cast, director, genres joined by blanks, in that order."""
    return F.concat_ws(" ",
                       F.array_join(_c(keywords), " "),
                       F.array_join(_c(cast), " "),
                       F.coalesce(_c(director_col), F.lit("")),
                       F.array_join(_c(genres), " "))


def neighbour_map(edges, src: str = "src_id", dst: str = "dst_id", score: str = "similarity"):
    """Edge table -> one row per source with a map dst -> score.

    The map of one source holds at most its top-N edges (already cut by the
    caller), so the per-group collect is bounded.
    """
    return (edges.groupBy(src)
                 .agg(F.map_from_entries(F.collect_list(F.struct(F.col(dst), F.col(score))))
                      .alias("neighbours")))
