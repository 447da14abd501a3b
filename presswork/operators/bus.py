"""Event bus records: topics, keys, decoding, routing and reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions import frames
from presswork.functions.binding import literal_array, literal_map
from presswork.functions.dims import event_dimensions
from presswork.functions.ids import stable_id
from presswork.functions.text import iso_micros
from presswork.operators.settle import settle

# Topic key -> schema version of its events.
TOPIC_SCHEMAS = {
    "feed_item_discovered": "feed_item.discovered.v2",
    "article_fetch_requested": "article.fetch_requested.v3",
    "article_fetched": "article.fetched.v2",
    "article_extracted": "article.extracted.v3",
    "dlq": "news.dlq.v1",
    "pipeline_metric": "pipeline.metric_observed.v1",
}
# Fields an event of a schema cannot do without.
REQUIRED_FIELDS = {
    "feed_item.discovered.v2": (
        "schema_version event_id event_time run_id source_id ingest_date feed_item_id article_id "
        "feed_id category article_url title discovered_at record_hash"
    ).split(),
    "article.fetch_requested.v3": (
        "schema_version event_id event_time run_id source_id ingest_date article_id requested_url "
        "request_revision"
    ).split(),
    "article.fetched.v2": (
        "schema_version event_id event_time run_id source_id ingest_date article_id requested_url "
        "source_document_id fetched_at status_code content_length_bytes content_hash fetch_status"
    ).split(),
    "article.extracted.v3": (
        "schema_version event_id event_time run_id source_id ingest_date article_id requested_url "
        "canonical_url title body_text content_blocks images content_hash source_document_id "
        "source_payload_uri extractor_version extraction_status"
    ).split(),
    "news.dlq.v1": (
        "schema_version event_id event_time source_topic error_class error_message payload"
    ).split(),
    "pipeline.metric_observed.v1": (
        "schema_version event_id event_time service metric_name metric_value metric_unit dimensions"
    ).split(),
}
TOPIC_PREFIX = "news."


def _literal_map(pairs) -> Column:
    return literal_map(pairs)


def topic_name(topic_key: Column) -> Column:
    """Topic of a topic key, null for unknown keys."""
    return F.try_element_at(_literal_map((k, TOPIC_PREFIX + k) for k in TOPIC_SCHEMAS), topic_key)


def topic_key(topic: Column) -> Column:
    return F.try_element_at(_literal_map((TOPIC_PREFIX + k, k) for k in TOPIC_SCHEMAS), topic)


def schema_version(key: Column) -> Column:
    return F.try_element_at(_literal_map(TOPIC_SCHEMAS.items()), key)


def required_fields(version: Column) -> Column:
    """array of required field names, null for unknown schema versions."""
    pairs = [
        x
        for name, fields in REQUIRED_FIELDS.items()
        for x in (F.lit(name), literal_array(fields))
    ]
    return F.try_element_at(F.create_map(*pairs), version)


def allowed_schema_ids(registry: DataFrame) -> DataFrame:
    """topic -> array of the ids of all versions of its value subject."""
    return registry.select(
        F.regexp_replace("subject", "-value$", "").alias("topic"), "schema_id"
    ).groupBy("topic").agg(F.collect_set(F.col("schema_id").cast("bigint")).alias("allowed_ids"))


def decode(records: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Framed records with verdict, schema_id and decoded JSON text.

    One pass: good and bad records stay in one frame and are told apart by
    ``verdict`` (null means decoded).
    """
    if registry is None:
        known = records.withColumn("allowed_ids", F.lit(None).cast("array<bigint>"))
    else:
        # A topic without registered versions accepts no id at all.
        known = records.join(allowed_schema_ids(registry), "topic", "left").withColumn(
            "allowed_ids", F.coalesce("allowed_ids", F.array().cast("array<bigint>"))
        )
    return settle(
        known, records.columns,
        schema_id=frames.frame_schema_id(F.col("value")),
        verdict=frames.frame_verdict(F.col("value"), F.col("allowed_ids")),
    ).withColumn(
        "json",
        F.when(F.col("verdict").isNull(), frames.frame_body(F.col("value")).cast("string")),
    )


def unknown_schema_ids(records: DataFrame, registry: DataFrame) -> DataFrame:
    """(topic, schema id) pairs on the bus that no registered version has."""
    seen = records.select("topic", frames.frame_schema_id(F.col("value")).alias("schema_id"))
    known = registry.select(
        F.regexp_replace("subject", "-value$", "").alias("topic"),
        F.col("schema_id").cast("bigint").alias("schema_id"),
    )
    return seen.filter("schema_id > 0").distinct().join(known, ["topic", "schema_id"], "left_anti")


def message_key(key: Column) -> Column:
    """Key under which an event is published, by its topic.

    Reads the columns feed_item_id, article_id, source_topic, source_partition,
    source_offset, service and metric_name. Null for unsupported topics.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (
        F.when(key == "feed_item_discovered", F.col("feed_item_id"))
        .when(
            key.isin("article_fetch_requested", "article_fetched", "article_extracted"),
            F.col("article_id"),
        )
        .when(
            key == "dlq",
            F.concat_ws(":", "source_topic", blank("source_partition"), blank("source_offset")),
        )
        .when(key == "pipeline_metric", F.concat_ws(":", "service", "metric_name"))
    )


def route(events: DataFrame) -> DataFrame:
    """Events with topic, message key and the verdict for unroutable ones."""
    routed = events.withColumn("topic", topic_name(F.col("topic_key"))).withColumn(
        "message_key", message_key(F.col("topic_key"))
    )
    return routed.withColumn(
        "verdict", F.when(F.col("message_key").isNull(), F.lit("unsupported_event"))
    )


def write_topics(routed: DataFrame, folder: str) -> None:
    """Bus sink: one folder per topic."""
    routed.write.mode("append").partitionBy("topic").parquet(folder)


def read_topics(spark: SparkSession, folder: str, schema: str, topics: list[str]) -> DataFrame:
    """Stream over several topics of a bus folder, earliest first.

    The topic filter is a partition filter: other topics' files are not read.
    """
    return spark.readStream.schema(schema).parquet(folder).filter(F.col("topic").isin(*topics))


def metric_events(observed: DataFrame) -> DataFrame:
    """pipeline_metric events of observations (service, metric_name,
    metric_value, metric_unit, dimensions map, observed_at)."""
    at = iso_micros(F.col("observed_at"))
    return observed.select(
        F.lit("pipeline.metric_observed.v1").alias("schema_version"),
        stable_id("event", "pipeline.metric_observed.v1", F.col("service"), F.col("metric_name"), at)
        .alias("event_id"),
        at.alias("event_time"), "service", "metric_name",
        F.col("metric_value").cast("double").alias("metric_value"), "metric_unit",
        event_dimensions(F.col("dimensions")).alias("dimensions"),
    )


def log_rows(outcomes: DataFrame, service: str, event: str, level: Column, at: Column) -> DataFrame:
    """Run-log rows: level and one JSON envelope with sorted keys."""
    fields = {c: F.col(c) for c in outcomes.columns}
    fields |= {
        "timestamp": iso_micros(at), "level": level, "service": F.lit(service),
        "event": F.lit(event),
    }
    return outcomes.select(level.alias("level"), frames.canonical_json(**fields).alias("entry"))
