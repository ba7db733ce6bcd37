"""Benchmark: run the headline queries on $BENCH_SF_DIR and print one JSON line.

Each query is executed in full with Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).  Usage:

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from reelkit.plans import catalog  # noqa: E402
from reelkit.session import get_session  # noqa: E402

# Headline queries: one per family (charts, content, ratings, hybrid, mining).
HEADLINE = [
    "R1_popularity_chart",
    "R2_knowledge_chart",
    "R4_plot_similarity",
    "R5_metadata_similarity",
    "E1_stratified_split",
    "V7_user_cosine",
    "R9_user_wmean_predictions",
    "R12_knn_predictions",
    "E6_leaderboard",
    "R18_hybrid_recommend",
    "R13_svd_predictions",
    "M7_pca",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(64, cpus * 8))))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=parts, app_name="reelkit-bench")
    qs = catalog.queries()
    # untimed warm-up: JVM class loading, Parquet reader and codegen of a first
    # scan-join-aggregate job (same for every query, so no query pays it)
    spark.range(100_000).selectExpr("id % 7 AS k", "id").groupBy("k").count() \
        .write.format("noop").mode("overwrite").save()
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    part.join(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), part.p_partkey == F.col("l_partkey")) \
        .groupBy("p_type").agg(F.avg("l_quantity")).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
