"""What happens to a consumed record: next topic, dead letter, retry or stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.operators import bus, dlq

ROUTES = ("ok", "dlq", "retry", "stop")


def route_of(error: Column, untyped: Column) -> Column:
    """Route by the record's error struct.

    No error goes on. A permanent error becomes a dead letter and the consumer
    advances; a retryable one is tried again without advancing; an error no
    stage claimed stops the consumer.
    """
    return (
        F.when(error.isNull(), F.lit("ok"))
        .when(F.coalesce(untyped, F.lit(False)), F.lit("stop"))
        .when(error["retryable"], F.lit("retry"))
        .otherwise(F.lit("dlq"))
    )


def with_route(records: DataFrame) -> DataFrame:
    """Adds ``route`` and whether the consumer's position ``advances``."""
    return records.withColumn("route", route_of(F.col("error"), F.col("untyped"))).withColumn(
        "advances", F.col("route").isin("ok", "dlq")
    )


def dead_letters(routed: DataFrame, service: str) -> DataFrame:
    """Dead letters of the records routed there.

    routed: topic, partition, offset, value, error, route, observed_at."""
    failures = routed.filter(F.col("route") == "dlq").select(
        F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"), "value", "error.*", "observed_at",
    )
    return dlq.dlq_events(failures, F.lit(service), F.col("observed_at"))


def retry_metrics(retried: DataFrame, metric_name: str, service: Column) -> DataFrame:
    """One metric event per retried record.

    retried: topic, partition, source_id, error, observed_at.
    """
    dims = F.create_map(
        F.lit("topic"), F.col("topic"),
        F.lit("partition"), F.col("partition").cast("string"),
        F.lit("stage"), F.col("error.stage"),
        F.lit("error_class"), F.col("error.error_class"),
        F.lit("source_id"), F.col("source_id"),
    )
    return bus.metric_events(
        retried.select(
            service.alias("service"), F.lit(metric_name).alias("metric_name"),
            F.lit(1.0).alias("metric_value"), F.lit("count").alias("metric_unit"),
            dims.alias("dimensions"), "observed_at",
        )
    )
