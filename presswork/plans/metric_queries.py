"""Queries over the metrics operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators import metrics as M
from presswork.sources import carriers as C


def day():
    return F.date_format("window_start", "yyyy-MM-dd").alias("day")


def metric_records(events: DataFrame, interval: str = "1 day") -> DataFrame:
    """Bus records in the column set the metric operators read."""
    no_map = F.lit(None).cast("map<string,string>")
    dims = F.create_map(
        F.lit("source_id"), F.col("source_id"),
        F.lit("error_class"), F.col("error_class"),
        F.lit("blank"), F.lit("  "),
    )
    dims = F.when(
        F.col("k") % 10 == 3, F.map_concat(dims, F.create_map(F.lit("service"), F.lit("override")))
    ).otherwise(dims)
    return events.select(
        M.flush_window(F.col("ts"), interval).alias("window"),
        "topic_key", "source_id", "stage", "error_class", "service", "metric_name",
        F.col("value").alias("metric_value"), F.lit("count").alias("metric_unit"),
        F.when(F.col("topic_key") == "pipeline_metric", dims).otherwise(no_map).alias("dimensions"),
    )


def _records(spark: SparkSession, folder: str, *topics: str) -> DataFrame:
    return metric_records(C.bus_events(spark, folder, *topics))


def _shown(points: DataFrame) -> DataFrame:
    return points.select(day(), "name", "value", "unit", "dimensions")


def fetch_success_count(spark, folder):
    counts = M.metric_counts(_records(spark, folder, "article_fetched"))
    return _shown(M.count_points(counts, 1))


def extraction_success_count(spark, folder):
    counts = M.metric_counts(_records(spark, folder, "article_extracted"))
    return _shown(M.count_points(counts, 2))


def rejected_and_dlq_count(spark, folder):
    return _shown(M.count_points(M.metric_counts(_records(spark, folder, "dlq")), 3))


def observed_metric_sum(spark, folder):
    return _shown(M.count_points(M.metric_counts(_records(spark, folder, "pipeline_metric")), 5))


def metric_name_filter(spark, folder):
    kept = M.rename_metrics(C.bus_events(spark, folder, "pipeline_metric"))
    return kept.select("event_id", "metric_name")


def source_extraction_failure(spark, folder):
    counts = M.metric_counts(_records(spark, folder, "dlq", "article_extracted"))
    return M.failing_sources(counts).select(day(), "source_id", "rejects")


def _lag_points(spark, folder):
    at = F.lit("2024-01-31").cast("timestamp")
    return M.lag_points(C.committed_offsets(spark, folder), C.latest_offsets(spark, folder), at)


def metric_points(spark, folder):
    """All families of every day, plus the lag seen at the end of the month."""
    return _shown(M.metric_points(_records(spark, folder), _lag_points(spark, folder)))


def metric_points_sorted(spark, folder):
    return M.sorted_points(M.metric_points(_records(spark, folder))).select(
        day(), "name", "value", "unit", "dimensions"
    )


def metric_batches(spark, folder):
    batched = M.batched_points(M.metric_points(_records(spark, folder)))
    return batched.select(day(), "name", "dimensions", "position", "batch")


def consumer_lag(spark, folder):
    return M.consumer_lag(C.committed_offsets(spark, folder), C.latest_offsets(spark, folder))


def lag_totals(spark, folder):
    committed = C.committed_offsets(spark, folder)
    return M.lag_totals(committed, M.consumer_lag(committed, C.latest_offsets(spark, folder)))


QUERIES = {
    f.__name__: f
    for f in (
        fetch_success_count, extraction_success_count, rejected_and_dlq_count,
        observed_metric_sum, metric_name_filter, source_extraction_failure, metric_points,
        metric_points_sorted, metric_batches, consumer_lag, lag_totals,
    )
}
