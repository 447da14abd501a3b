"""Running a stream into per-batch folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def batch_folder(out: str, batch_id: int) -> str:
    return f"{out}/batch={batch_id:012d}"


def run_batches(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
    trigger: dict | None = None,
) -> None:
    """Feeds every micro-batch to ``handle`` until the trigger is done.

    ``handle`` must end in the same state when a batch comes again, which
    happens when a run dies between writing and committing: write to
    batch_folder with overwrite, or to a state version named after the batch.
    The default trigger takes what is there and ends; pass for example
    {"processingTime": "60 seconds"} for a job that stays up.
    """
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()


def write_batch(frame: DataFrame, out: str, batch_id: int, *partitions: str) -> None:
    """A batch's result under its own folder; repeating the batch replaces it."""
    writer = frame.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(batch_folder(out, batch_id))
