"""Queries of the event bus, dead letters and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.functions import errors, frames
from presswork.operators import bus, dlq, lookup, routing
from presswork.sources import carriers as C
from presswork.sources.dlq_carrier import dlq_rows
from presswork.sources.tables import table

REGISTERED_IDS = {
    "article_fetched": (1, 2, 3),
    "article_extracted": (1, 2),
    "dlq": (1, 2, 3, 4),
    "pipeline_metric": (1, 4),
}


def registry(spark):
    """Registered schema versions per subject (configuration)."""
    rows = [(f"news.{k}-value", i) for k, ids in REGISTERED_IDS.items() for i in ids]
    return spark.createDataFrame(rows, "subject string, schema_id int")


def decode_framed_events(spark, folder):
    decoded = bus.decode(C.framed_events(spark, folder))
    return decoded.select(
        "topic", "offset", "schema_id", "verdict",
        F.get_json_object("json", "$.article_id").alias("article_id"),
    )


def schema_id_allowlist(spark, folder):
    decoded = bus.decode(C.framed_events(spark, folder), registry(spark))
    return decoded.groupBy("topic", F.coalesce("verdict", F.lit("decoded")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("records")
    )


def schema_unknown(spark, folder):
    return bus.unknown_schema_ids(C.framed_events(spark, folder), registry(spark))


def encode_framed_events(spark, folder):
    pe = C.bus_events(spark, folder)
    body = frames.canonical_json(
        source_id=F.col("source_id"), article_id=F.col("article_id"), k=F.col("k"),
        note=F.when(F.col("k") % 2 == 0, F.lit('say "é"')),
    )
    return pe.select(
        "event_id", body.alias("json"), frames.wire_bytes(body).alias("wire_bytes"),
        F.sha2(frames.frame(F.col("k") + 1, body), 256).alias("frame_sha256"),
    )


def routable(spark, folder):
    """Bus events with the columns message keys are made of."""
    key = F.when(F.col("k") == 99, F.lit("mystery")).otherwise(F.col("topic_key"))
    return C.bus_events(spark, folder).select(
        "event_id", key.alias("topic_key"),
        F.concat(F.lit("feed_item_"), F.col("event_id")).alias("feed_item_id"), "article_id",
        F.concat(F.lit("news."), F.col("topic_key")).alias("source_topic"),
        F.when(F.col("k") % 4 != 0, F.col("partition")).alias("source_partition"),
        F.when(F.col("k") % 6 != 0, F.col("offset")).alias("source_offset"),
        "service", "metric_name",
    )


def route_events(spark, folder):
    return bus.route(routable(spark, folder)).select("event_id", "topic", "message_key", "verdict")


def topic_lookup(spark, folder):
    named = C.bus_events(spark, folder).select("event_id", bus.topic_name(F.col("topic_key")).alias("topic"))
    key = bus.topic_key(F.col("topic"))
    return named.select("event_id", "topic", key.alias("topic_key"),
                        bus.schema_version(key).alias("schema_version"))


def metric_event_build(spark, folder):
    pe = C.bus_events(spark, folder)
    observed = pe.select(
        "service", "metric_name", F.col("value").alias("metric_value"),
        F.lit("count").alias("metric_unit"), F.col("ts").alias("observed_at"),
        F.create_map(
            F.lit("stage"), F.col("stage"),
            F.lit("empty"), F.lit(""),
            F.lit("missing"), F.lit(None).cast("string"),
            F.lit("attempt"), F.col("k").cast("string"),
        ).alias("dimensions"),
    )
    return bus.metric_events(observed).withColumn("dimensions", F.to_json("dimensions"))


def run_log_rows(spark, folder):
    log = C.crawl_log(spark, folder).withColumn("class", errors.status_class(F.col("status")))
    level = F.when(F.col("class") == "ok", "info").when(
        F.col("class") == "retryable", "warning").otherwise("error")
    fields = log.select(
        "event_id", "source_id", "status", "class", "ts",
        F.when(F.col("class") != "ok", F.concat(F.lit("status "), "status")).alias("error_message"),
    )
    return bus.log_rows(fields.drop("ts"), "fetcher", "article_fetch_completed", level,
                        F.lit("2024-02-01").cast("timestamp"))


def dlq_event_build(spark, folder):
    """Every record that does not decode, as a dead letter."""
    decoded = bus.decode(C.framed_events(spark, folder), registry(spark))
    failed = decoded.filter(F.col("verdict").isNotNull()).select(
        F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"), "value",
        F.lit("event_decode").alias("stage"), F.lit("ValueError").alias("error_class"),
        F.col("verdict").alias("error_message"),
    )
    return dlq.dlq_events(failed, F.lit("fetcher"), F.lit("2024-02-01").cast("timestamp"))


def dlq_source_stage(spark, folder):
    return dlq.read_payload(dlq_rows(spark, folder)).select("event_id", "source_id", "stage")


def replay_eligibility(spark, folder):
    return dlq.replay_verdict(dlq_rows(spark, folder)).select(
        "event_id", "source_topic", "replay_topic_key", "failed_schema", "verdict"
    )


def dlq_take_n(spark, folder):
    return dlq.take_in_order(dlq_rows(spark, folder), 25).select(
        "event_id", "source_partition", "source_offset"
    )


def dlq_disposition(spark, folder):
    """A replay of everything, then a commit of ValueErrors; what stays open."""
    letters = dlq_rows(spark, folder)
    replayed = dlq.dispose(letters, "replay", "desk", "source fixed")
    rest = dlq.still_open(letters, replayed)
    closed = dlq.dispose(
        rest.filter(F.col("error_class") == "ValueError"), "commit", "desk", "not needed"
    )
    seen = dlq.dispose(dlq.still_open(rest, closed), "inspect", "desk", None)
    return replayed.filter("committed").unionByName(closed).unionByName(seen)


def staged_events(spark, folder):
    return C.bus_events(spark, folder, *lookup.STAGE_TOPICS.values())


def stage_union(spark, folder):
    return lookup.stage_records(staged_events(spark, folder)).select(
        "event_id", "article_id", "stage"
    )


def latest_per_stage(spark, folder):
    latest = lookup.latest_per_stage(lookup.stage_records(staged_events(spark, folder)))
    return latest.select("article_id", "stage", "event_id")


def time_range_read(spark, folder):
    since = F.lit("2024-01-10").cast("timestamp")
    return lookup.read_since(
        C.bus_events(spark, folder), since, lookup.lookup_id("article_13_3", None)
    ).select("event_id", "topic_key", "article_id")


def article_lineage(spark, folder):
    paths = lookup.lineage(lookup.stage_records(staged_events(spark, folder)))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return paths.select("article_id", "fetched", "extracted", stamp("first_fetched"),
                        stamp("last_extracted"))


def record_summary(spark, folder):
    pe = C.bus_events(spark, folder, "article_extracted")
    block = F.struct(F.lit("paragraph").alias("type"), F.lit("text").alias("text"))
    records = lookup.stage_records(pe, "extracted").select(
        "stage", bus.topic_name(F.col("topic_key")).alias("topic"), "partition", "offset",
        "event_id", "source_id", "article_id", F.col("service").alias("internal"),
        F.array_repeat(block, F.col("k") % 5).alias("content_blocks"),
        F.array_repeat(F.lit("image"), F.col("k") % 3).alias("images"),
    )
    return lookup.record_summary(records)


def article_content_select(spark, folder):
    """documents as extracted articles (bodies without a label lie in the side
    table) and pages as fetched ones, half of them under the same articles."""
    docs = table(spark, folder, "documents").join(
        table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    side_uri = F.concat(F.lit("side/"), F.col("doc_id"))
    none = F.lit(None).cast("string")
    extracted = docs.select(
        F.concat(F.lit("a"), F.col("doc_id")).alias("article_id"), F.lit("extracted").alias("stage"),
        F.when(F.col("quality").isNotNull(), F.col("text")).otherwise("").alias("body_text"),
        side_uri.alias("extracted_payload_uri"), none.alias("payload_uri"),
    )
    pages = table(spark, folder, "pages")
    page_uri = F.concat(F.lit("page/"), F.col("page_id"))
    fetched = pages.select(
        F.concat(F.when(F.col("page_id") % 2 == 0, "a").otherwise("p"), F.col("page_id"))
        .alias("article_id"),
        F.lit("fetched").alias("stage"), none.alias("body_text"),
        none.alias("extracted_payload_uri"), page_uri.alias("payload_uri"),
    )
    return lookup.select_content(
        extracted.unionByName(fetched),
        docs.select(side_uri.alias("extracted_payload_uri"), F.col("text").alias("side_text")),
        pages.select(page_uri.alias("payload_uri"), "html"),
    )


def as_consumed(log, offset=None):
    """Crawl results as consumed records with their error structs."""
    log = log.withColumn("cls", errors.status_class(F.col("status")))
    error = errors.error_struct(
        F.lit("article_fetch"), F.lit("HTTPStatusError"), F.concat(F.lit("status "), "status"),
        F.col("cls") == "retryable", F.col("status"), F.col("untyped"),
    )
    return log.select(
        "event_id", "ts", "source_id", F.lit("news.article_fetch_requested").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset") if offset is None else offset,
        "untyped", F.when(F.col("cls") != "ok", error).alias("error"),
        F.col("ts").alias("observed_at"),
    )


def consumed_records(spark, folder):
    return as_consumed(C.crawl_log(spark, folder))


def three_way_route(spark, folder):
    return routing.with_route(consumed_records(spark, folder)).select(
        "event_id", "route", "advances", F.col("error.stage").alias("stage")
    )


def retry_metric_emit(spark, folder):
    retried = routing.with_route(consumed_records(spark, folder)).filter(F.col("route") == "retry")
    emitted = routing.retry_metrics(retried, "consumer_retry_count", F.lit("fetcher"))
    return emitted.withColumn("dimensions", F.to_json("dimensions"))


QUERIES = {
    f.__name__: f
    for f in (
        decode_framed_events, schema_id_allowlist, schema_unknown, encode_framed_events,
        route_events, topic_lookup, metric_event_build, run_log_rows, dlq_event_build,
        dlq_source_stage, replay_eligibility, dlq_take_n, dlq_disposition, stage_union,
        latest_per_stage, time_range_read, article_lineage, record_summary,
        article_content_select, three_way_route, retry_metric_emit,
    )
}
