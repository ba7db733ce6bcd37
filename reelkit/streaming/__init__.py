"""Micro-batch adapter.

The reference reads complete files only; it has no streams, watermarks or
state (SURVEY §2.13).  This module only lets the batch operators run on each
micro-batch of a Structured Streaming source, e.g. scoring newly arriving
(user, movie) request rows against model tables that were written earlier.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def score_stream(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], sink_path: str,
                 checkpoint: str, fmt: str = "parquet", trigger_once: bool = True):
    """Apply a batch scorer (DataFrame -> DataFrame) to every micro-batch and append
    the result to ``sink_path``; exactly-once through the streaming checkpoint."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        scorer(batch).write.mode("append").format(fmt).save(sink_path)

    w = requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
