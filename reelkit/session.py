"""Session helpers.

Library code never changes session configuration.  ``get_session`` is only
used by tests, ``bench.py`` and scripts; on a cluster the caller brings its
own session and the operators read what they need from it
(``spark.checkpoint.dir`` for lineage cuts).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Fixed defaults for local runs only.
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "reelkit") -> SparkSession:
    """Local session for tests / bench.  Sets a checkpoint dir only if unset."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        # Only for local runs: a cluster names a shared folder itself.
        local_dir = tempfile.mkdtemp(prefix="reelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When it is unset, a local-mode session (tests, a laptop) gets a temporary
    folder; on a cluster this raises, because a machine-local folder would not
    survive the loss of an executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; lineage cuts need a shared folder")
        path = tempfile.mkdtemp(prefix="reelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as a Parquet table under ``spark.checkpoint.dir`` and read back, and its path for ``emptied``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/reelkit-cut/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path), path


def emptied(spark: SparkSession, path: str) -> None:
    """Overwrite a table that nothing reads any more with one of no rows: its files go, by the writer that made them,
    on any storage."""
    spark.createDataFrame([], "gone boolean").write.mode("overwrite").parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under ``spark.checkpoint.dir`` and read it back.

    A lineage cut for intermediates that several branches or models reuse: it
    is computed once (a reliable ``checkpoint()`` of an uncached plan computes
    it twice), survives the loss of an executor (the files are in the shared
    folder), and the re-read keeps column pruning and statistics.  Never
    ``localCheckpoint``.
    """
    return stored_at(df)[0]
