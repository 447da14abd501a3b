"""Streaming jobs: restarts, stops and event-time windows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from presswork.functions.errors import error_struct
from presswork.operators import metrics
from presswork.session import new_run_folder, shared_folder
from presswork.streaming import jobs
from presswork.streaming.runner import run_batches, write_batch

ROUTED = "topic string, partition int, offset bigint, kind string"


def consumed(frame):
    error = error_struct(F.lit("article_fetch"), F.lit("E"), F.lit("m"), F.col("kind") == "retry")
    return frame.withColumn("untyped", F.col("kind") == "stray").withColumn(
        "error", F.when(F.col("kind") != "ok", error))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).parquet(folder)


def test_shared_folder_is_kept(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert new_run_folder(spark, "x") != new_run_folder(spark, "x")


def test_unclaimed_error_stops_before_commit(spark):
    run = new_run_folder(spark, "stop")
    spark.createDataFrame([("t", 0, 1, "ok"), ("t", 0, 2, "stray")], ROUTED).write.parquet(f"{run}/in")
    records = consumed(stream(spark, f"{run}/in", ROUTED))
    with pytest.raises(Exception, match="unclaimed errors"):
        jobs.route_stream(records, f"{run}/out", f"{run}/checkpoint")
    jobs.route_stream(records, f"{run}/out", f"{run}/checkpoint", park_unclaimed=True)
    rows = spark.read.parquet(f"{run}/out").collect()
    assert {(r.offset, r.route, r.advances) for r in rows} == {(1, "ok", True), (2, "stop", False)}


def test_repeated_batch_replaces_its_output(spark):
    run = new_run_folder(spark, "repeat")
    for _ in range(2):
        write_batch(spark.range(3), run, 7)
    assert spark.read.parquet(run).count() == 3


def test_attempts_grow_and_clear(spark):
    empty = spark.createDataFrame([], jobs.RETRY_STATE)
    schema = "topic string, partition int, offset bigint, seq bigint, route string"
    first = spark.createDataFrame(
        [("t", 0, 1, 1, "retry"), ("t", 0, 1, 2, "retry"), ("t", 0, 2, 1, "retry"), ("t", 0, 3, 1, "ok")], schema)
    state = jobs.retry_attempts(empty, first)
    assert {r.offset: (r.attempts, r.delay_seconds) for r in state.collect()} == {1: (2, 2.0), 2: (1, 1.0)}
    second = spark.createDataFrame(
        [("t", 0, 1, 3, "ok"), ("t", 0, 1, 4, "retry"), ("t", 0, 2, 2, "dlq")], schema)
    later = jobs.retry_attempts(state, second)
    assert {r.offset: r.attempts for r in later.collect()} == {1: 1}
    untouched = jobs.retry_attempts(state, spark.createDataFrame([], schema))
    assert {r.offset: r.attempts for r in untouched.collect()} == {1: 2, 2: 1}


def test_completions_hold_across_batches(spark):
    run, schema = new_run_folder(spark, "done"), "event_id bigint, article_id string, request_revision string"
    for rows in ([(1, "a", "r"), (2, "a", "r")], [(3, "a", "r"), (4, "a", "s"), (5, "b", "r")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{run}/in")
        jobs.completion_stream(
            stream(spark, f"{run}/in", schema), f"{run}/state", f"{run}/out", f"{run}/checkpoint")
    got = {r.event_id: r.status for r in spark.read.parquet(f"{run}/out").collect()}
    assert got == {1: "published", 2: "already_processed", 3: "already_processed", 4: "published", 5: "published"}


def test_event_time_windows_close(spark):
    run = new_run_folder(spark, "windows")
    schema = "ts timestamp, topic_key string, source_id string"
    table = spark.createDataFrame(
        [("2026-01-01 01:00:00", "article_fetched", "s"), ("2026-01-01 23:00:00", "article_fetched", "s"),
         ("2026-01-03 00:00:00", "article_fetched", "s")], "at string, topic_key string, source_id string")
    table.select(F.col("at").cast("timestamp").alias("ts"), "topic_key", "source_id").write.parquet(f"{run}/in")
    none = F.lit(None).cast("string")
    records = stream(spark, f"{run}/in", schema).withWatermark("ts", "1 hour").select(
        metrics.flush_window(F.col("ts")).alias("window"), "topic_key", "source_id",
        *[none.alias(c) for c in ("stage", "error_class", "service", "metric_name", "metric_unit")],
        F.lit(1.0).alias("metric_value"), F.lit(None).cast("map<string,string>").alias("dimensions"))
    query = (jobs.windowed_counts(records).writeStream.outputMode("append").format("memory")
             .queryName("closed_windows").option("checkpointLocation", f"{run}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.table("closed_windows").collect()
    assert [(str(r.window_start)[:10], r.value) for r in rows] == [("2026-01-01", 2.0)]


def test_folder_tables_stream_like_files(spark, tmp_path):
    from presswork.sources.tables import stream_table, table

    rows = table(spark, "/root/testdata/sf0.001", "events").limit(40)
    rows.repartition(3).write.parquet(f"{tmp_path}/many/events.parquet")
    for folder, n in ((f"{tmp_path}/many", 40), ("/root/testdata/sf0.001", None)):
        run_batches(
            stream_table(spark, folder, "events"), f"{tmp_path}/{n}/checkpoint",
            lambda batch, i, n=n: write_batch(batch, f"{tmp_path}/{n}/out", i),
        )
        got = spark.read.parquet(f"{tmp_path}/{n}/out").drop("batch")
        assert got.count() == table(spark, folder, "events").count()
