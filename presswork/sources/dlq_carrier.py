"""Error events in the shape of dead letters of many kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators import bus
from presswork.sources.carriers import bus_events, pick

FAILED_TOPICS = (
    "article_fetched", "article_extracted", "dlq", "article_fetch_requested", "pipeline_metric",
)


def dlq_rows(spark: SparkSession, folder: str) -> DataFrame:
    e = bus_events(spark, folder, "dlq")
    failed_topic = pick(F.col("k") + F.col("event_id"), *FAILED_TOPICS)
    kind = F.col("k") % 10
    version = F.when(F.col("k") % 7 == 0, F.lit("other.v9")).otherwise(
        bus.schema_version(failed_topic)
    )
    text = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
    common = F.concat_ws(
        ",",
        text("schema_version", version), text("event_id", F.col("event_id").cast("string")),
        text("event_time", F.lit("2024-01-01T00:00:00Z")), text("run_id", F.lit("run")),
        text("ingest_date", F.lit("2024-01-01")),
        F.when(F.col("k") % 11 != 0, text("article_id", F.col("article_id"))),
        text("requested_url", F.lit("https://example.com/a")),
        text("request_revision", F.lit("rev")), text("source_document_id", F.lit("doc")),
        text("fetched_at", F.lit("2024-01-01T00:00:00Z")),
        F.lit('"status_code":200,"content_length_bytes":9,"content_blocks":[],"images":[]'),
        text("content_hash", F.lit("00")), text("fetch_status", F.lit("success")),
        text("canonical_url", F.lit("https://example.com/a")), text("title", F.lit("t")),
        text("body_text", F.lit("b")), text("source_payload_uri", F.lit("u")),
        text("extractor_version", F.lit("v")), text("extraction_status", F.lit("success")),
        text("service", F.col("service")), text("metric_name", F.lit("m")),
        F.lit('"metric_value":1.5'), text("metric_unit", F.lit("count")), F.lit('"dimensions":{}'),
    )
    source = F.when(kind == 9, F.concat(F.lit('"source_id":'), F.col("user_id"))).otherwise(
        text("source_id", F.col("source_id"))
    )
    failed = (
        F.when(kind == 6, F.lit('"gone"'))
        .when(kind == 7, F.lit('{"encoding":"base64","value":"bm90"}'))
        .when(kind == 8, F.lit('{"encoding":"json","value":[1]}'))
        .otherwise(F.concat(F.lit('{"encoding":"json","value":{'), common, F.lit(","), source,
                            F.lit("}}")))
    )
    stage = F.when(kind == 9, F.lit("")).otherwise(F.concat(F.lit(","), text("stage", F.col("stage"))))
    return e.select(
        F.concat(F.lit("dlq_"), F.col("event_id")).alias("event_id"), "ts",
        bus.topic_name(failed_topic).alias("source_topic"),
        F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
        "error_class",
        F.concat(F.lit('{"failed_event":'), failed, F.lit(',"service":"fetcher"'), stage, F.lit("}"))
        .alias("payload"),
    )
