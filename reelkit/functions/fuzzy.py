"""Near-miss title suggestions (X14): difflib's close matches, distributed.

Candidates are not a cross product: a query of length q can only reach the
cutoff with titles whose length t satisfies 2*min(q, t)/(q + t) >= cutoff
(difflib's ``real_quick_ratio`` bound), so each query is expanded to that
length range and equi-joined with the distinct titles on length.  The exact
ratio runs in an Arrow pandas UDF over the surviving pairs only.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from reelkit.operators.relational import top_n_per_group


@F.pandas_udf(DoubleType())
def _ratio(titles: pd.Series, queries: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, t, q).ratio() for t, q in zip(titles, queries)])


def close_matches(queries: DataFrame, titles: DataFrame, n: int = 5, cutoff: float = 0.6) -> DataFrame:
    """For each ``query`` the up-to-n distinct non-null titles with ratio >= cutoff,
    best first (ties: title descending, as difflib's nlargest)."""
    t = titles.filter(F.col("title").isNotNull()).select("title").distinct() \
              .withColumn("len", F.length("title"))
    q = queries.select("query").filter(F.col("query").isNotNull()).distinct()
    ql = F.length("query")
    lo = F.ceil(ql * cutoff / (2 - cutoff)).cast("int")
    longest = t.agg(F.max("len")).scalar()
    hi = F.least(F.floor(ql * (2 - cutoff) / cutoff).cast("int"), longest) if cutoff > 0 else longest
    q = q.filter(lo <= hi)
    qx = q.select("query", F.explode(F.sequence(F.greatest(lo, F.lit(0)), hi)).alias("len"))
    cand = qx.join(t, "len").select("query", "title")
    scored = cand.withColumn("ratio", _ratio("title", "query")).filter(F.col("ratio") >= cutoff)
    return top_n_per_group(scored, "query", [F.desc("ratio"), F.desc("title")], n, rank_col="rank")
