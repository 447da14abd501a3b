"""Fetched bus records to extracted events, side payloads, dead letters and retries.

judge() decides every record of a batch once; the sinks below are selections of its
result. A record is decoded, checked against the fields its schema requires, matched
with its source, gated and extracted, and its event is cut to the size the bus takes.
The first rule that fails names the stage, class and message of the record's error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.errors import error_struct
from presswork.operators import bus, routing
from presswork.operators.records import POSITION, RECORD, decoded_events, failed, with_source
from presswork.plans import article_flow
from presswork.sources.landing import absent_payloads

SERVICE = "extractor"
FETCHED = (
    "run_id string, source_id string, ingest_date string, article_id string, requested_url string, "
    "source_document_id string, payload_uri string, content_hash string, fetch_status string"
)
SCHEMA = "article.fetched.v2"
EVENTS = "topic string, message_key string, event_id string, json string, inline_event_bytes int"
SIDE = "payload_uri string, content_hash string, source_id string, ingest_date string, payload binary"
DEAD = (
    "schema_version string, event_id string, event_time string, source_topic string, source_partition int, "
    "source_offset bigint, error_class string, error_message string, payload string"
)
RETRIES = f"{RECORD}, source_id string, attempts bigint, error_message string"
METRICS = (
    "schema_version string, event_id string, event_time string, service string, metric_name string, "
    "metric_value double, metric_unit string, dimensions string"
)


def judge(
    records: DataFrame, landed: DataFrame, settings: DataFrame, observed_at: Column,
    registry: DataFrame | None = None, limit: int = article_flow.MAX_INLINE_BYTES,
) -> DataFrame:
    """Records with their ``error`` (null: accepted), ``route`` and, if accepted, the
    extracted event as bus JSON and the side payload it points to.

    ``settings`` has a row per source: enabled, extractor, attribution_policy and
    compiled extraction. ``landed`` is looked up by address for records that need it.
    """
    gated = with_source(decoded_events(records, SCHEMA, FETCHED, registry), settings)
    # what has failed already is stopped before its payload is looked up
    found = article_flow.extract_fetched(
        gated.withColumn("stopped", F.when(F.col("error").isNotNull(), F.lit("stopped"))), landed
    )
    verdict = F.when(F.col("error").isNull(), F.col("verdict"))
    late = error_struct(
        article_flow.gate_stage(verdict), F.lit("IngestionError"), verdict, verdict == "missing_payload"
    )
    judged = found.withColumn("error", F.coalesce("error", F.when(verdict.isNotNull(), late))).drop("verdict", "stopped")
    events = article_flow.event_columns(judged, observed_at)
    sized = article_flow.split_oversize(events, limit)
    too_large = failed("article_extract", F.col("size_verdict"), "IngestionError", False)
    error = F.coalesce("error", F.when(F.col("size_verdict").isNotNull(), too_large))
    whole = sized.withColumn("error", error)
    good = F.col("error").isNull()
    shown = whole.select(
        *records.columns, "source_id", "ingest_date", "article_id", "error",
        F.when(good, F.col("event_id")).alias("event_id"),
        F.when(good, F.col("json")).alias("json"),
        F.when(good, F.col("inline_event_bytes")).cast("int").alias("inline_event_bytes"),
        *[F.when(good, F.col(c)).alias(c) for c in ("side_json", "extracted_payload_uri", "extracted_payload_hash")],
        observed_at.alias("observed_at"), F.lit(False).alias("untyped"),
    )
    return routing.with_route(shown)


def event_rows(judged: DataFrame) -> DataFrame:
    """Events for the bus, keyed by article."""
    return judged.filter("route = 'ok'").select(
        bus.topic_name(F.lit("article_extracted")).alias("topic"), F.col("article_id").alias("message_key"),
        "event_id", "json", "inline_event_bytes",
    )


def side_rows(judged: DataFrame, before: DataFrame) -> DataFrame:
    """Side payloads of oversize events whose address holds nothing yet."""
    wanted = article_flow.side_payloads(judged.filter("route = 'ok'"))
    return absent_payloads(wanted, before).select(
        "payload_uri", "content_hash", "source_id", "ingest_date", "payload"
    )


def dead_rows(judged: DataFrame) -> DataFrame:
    """Dead letters of records that can never succeed."""
    return routing.dead_letters(judged, SERVICE)


def retry_rows(judged: DataFrame) -> DataFrame:
    """Records to be tried again, with the tries so far."""
    return judged.filter("route = 'retry'").select(
        *POSITION, "ts", "value", "source_id", (F.coalesce("attempts", F.lit(0)) + 1).cast("bigint").alias("attempts"),
        F.col("error.error_message").alias("error_message"),
    )


def metric_rows(judged: DataFrame) -> DataFrame:
    """One consumer_retry_count observation per record to be tried again."""
    emitted = routing.retry_metrics(judged.filter("route = 'retry'"), "consumer_retry_count", F.lit(SERVICE))
    return emitted.withColumn("dimensions", F.to_json("dimensions"))
