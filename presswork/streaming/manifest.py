"""Batches of several sinks that become visible at once.

A batch is judged once, into one table; its sinks are parts of that table. The manifest
has a row per table that is written whole, and a last one that shows the batch: readers
take shown batches only. A batch that comes again goes on where it stopped. A table that
the manifest names is not made anew (so its times stay), a half-written one is replaced,
and a batch that is shown is left alone. Everything lies below one root, the stream's
positions included, as batch numbers mean nothing without them.

Structured Streaming starts a batch after the one before has ended, so all batches up to
the newest visible one are visible: reading is a partition filter, not a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.streaming.runner import batch_folder, run_batches

MANIFEST = "rows bigint, batch bigint, step string"
JUDGED, VISIBLE = "judged", "visible"


def stored(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The table in ``folder``, empty while nobody has written it."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """What has been written whole: a row per batch and step, with the rows of it."""
    return stored(spark, f"{root}/manifest", MANIFEST)


def steps(spark: SparkSession, root: str, batch_id: int) -> list[str]:
    """Steps of a batch that are done: tables written whole, VISIBLE at last."""
    done = manifest(spark, root).filter(F.col("batch") == batch_id)
    return [r.step for r in done.select("step").collect()]


def _mark(spark: SparkSession, root: str, batch_id: int, step: str, rows: int) -> None:
    folder = f"{batch_folder(f'{root}/manifest', batch_id)}/step={step}"
    spark.createDataFrame([(rows,)], "rows bigint").coalesce(1).write.mode("overwrite").parquet(folder)


def _write_counted(frame: DataFrame, folder: str) -> int:
    """Writes ``frame`` over ``folder``; its rows, counted from the file footers."""
    frame.write.mode("overwrite").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder).count()


def visible_upto(spark: SparkSession, root: str) -> int:
    """Number of the newest visible batch, -1 without one."""
    newest = manifest(spark, root).filter(F.col("step") == VISIBLE).agg(F.max("batch")).first()[0]
    return -1 if newest is None else newest


def committed(spark: SparkSession, root: str, sink: str, schema: str) -> DataFrame:
    """Rows of a sink in visible batches, with their batch."""
    rows = stored(spark, f"{root}/{sink}", f"{schema}, batch bigint")
    return rows.filter(F.col("batch") <= visible_upto(spark, root))


def run_judged(
    stream: DataFrame, root: str,
    judge: Callable[[DataFrame, int], DataFrame],
    sinks: dict[str, Callable[[DataFrame, int], DataFrame]],
    keep: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> None:
    """Runs a stream whose batches are judged once and shown in ``sinks`` together.

    judge(batch, batch_id) makes the batch's table; each sink maps that table, read
    back, to its rows, in the order given. A sink function may read what earlier
    batches committed. ``keep`` brings keyed state to the version named by the batch.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = set(steps(spark, root, batch_id))
        if VISIBLE in done:
            return
        folder = batch_folder(f"{root}/{JUDGED}", batch_id)
        if JUDGED not in done:
            _mark(spark, root, batch_id, JUDGED, _write_counted(judge(batch, batch_id), folder))
        judged = spark.read.parquet(folder)
        for name, rows in sinks.items():
            if name not in done:
                counted = _write_counted(rows(judged, batch_id), batch_folder(f"{root}/{name}", batch_id))
                _mark(spark, root, batch_id, name, counted)
        if keep is not None:
            keep(judged, batch_id)
        _mark(spark, root, batch_id, VISIBLE, 0)

    run_batches(stream, f"{root}/checkpoint", handle, trigger)
