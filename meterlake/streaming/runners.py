"""Bounded streaming runs: take everything that is new, then stop."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.sinks.counters import load_counters, save_counters


def stream_apply(
    stream: DataFrame, batch_fn: Callable[[DataFrame, int], dict | None], checkpoint: str
) -> None:
    """Call ``batch_fn`` for every non-empty micro-batch and wait for the end.

    A batch is repeated after a failure, so ``batch_fn`` must be safe to repeat. The counters it
    returns go into the stream's journal with the seconds it took; a repeated batch replaces
    its entry.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        began = time.monotonic()
        counts = batch_fn(batch, batch_id) or {}
        seconds = round(time.monotonic() - began, 3)
        save_counters(batch.sparkSession, _journal(checkpoint), {str(batch_id): {**counts, "seconds": seconds}})

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _journal(checkpoint: str) -> str:
    return f"{checkpoint}/journal"


def read_journal(spark: SparkSession, checkpoint: str) -> list[tuple[int, int | None, float]]:
    """Batch, rows written and seconds of every batch of a stream, in order."""
    entries = load_counters(spark, _journal(checkpoint))
    return sorted((int(batch), counts.get("total"), counts["seconds"]) for batch, counts in entries.items())


def stream_append(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append every new row to a parquet path; the sink's log makes each batch count once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
