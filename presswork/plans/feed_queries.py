"""Queries of the feed path."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.functions import errors, ids
from presswork.operators import feeds as X
from presswork.plans.feed_scan import scan_feeds
from presswork.sources import carriers as C
from presswork.sources import rss
from presswork.sources.state import state_verdict, upsert
from presswork.sources.tables import table


def now():
    return F.lit("2024-02-01").cast("timestamp")


def domains(spark, folder):
    sources = table(spark, folder, "documents").select(F.col("source").alias("source_id")).distinct()
    return sources.withColumn("domain", F.concat("source_id", F.lit(".example.com")))


def hashed_current(spark, folder):
    return X.with_hashes(C.current_snapshot(spark, folder))


def remembered(spark, folder):
    return X.with_hashes(C.previous_snapshot(spark, folder)).select(*X.ITEM, "record_hash")


def checkpoints(spark, folder):
    """Validators of the last poll together with the hash of what it saw."""
    before = X.semantic_hash(X.with_hashes(C.previous_snapshot(spark, folder)))
    return before.drop("items").join(C.feed_validators(spark, folder), X.FEED)


def scan(spark, folder):
    return scan_feeds(
        C.raw_feed_items(spark, folder), C.feed_responses(spark, folder), domains(spark, folder),
        remembered(spark, folder), checkpoints(spark, folder), now(),
    )


def feed_items_from_xml(spark, folder):
    parsed = rss.parse_feeds(C.feed_payloads(spark, folder))
    rows = rss.feed_item_rows(parsed)
    return rows.select(
        "source_id", "feed_id", "pos", "article_url", "title",
        F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
        "published_iso",
    )


def feed_parse_verdict(spark, folder):
    parsed = rss.parse_feeds(C.feed_payloads(spark, folder))
    return parsed.select("source_id", "feed_id", "verdict", "parsed", "skipped", "duplicates")


def feed_item_validity(spark, folder):
    items = X.classify_items(C.raw_feed_items(spark, folder))
    return items.groupBy(*X.FEED).agg(
        F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("skipped")
    )


def feed_all_or_nothing(spark, folder):
    kept = X.all_or_nothing(C.current_snapshot(spark, folder), domains(spark, folder))
    return kept.select(*X.FEED, "pos", "article_url")


def feed_item_diff(spark, folder):
    changed = X.diff_items(hashed_current(spark, folder), remembered(spark, folder))
    return changed.select(*X.ITEM, "record_hash", "change")


def feed_semantic_hash(spark, folder):
    return X.semantic_hash(hashed_current(spark, folder))


def feed_change_status(spark, folder):
    return scan(spark, folder).outcomes


def feed_run_rollup(spark, folder):
    log = C.crawl_log(spark, folder)
    cls = errors.status_class(F.col("status"), feed=True)
    return X.run_rollup(
        log.select(
            "source_id",
            (~cls.isin("ok", "not_modified")).alias("failed"),
            (cls == "retryable").alias("retryable"),
            "untyped",
        )
    )


def conditional_request(spark, folder):
    return X.conditional_request(C.feed_responses(spark, folder), checkpoints(spark, folder))


def first_wins_dedupe(spark, folder):
    """Lines of all documents of a source as items; equal lines are one item."""
    lines = C.document_lines(spark, folder).select(
        F.col("source").alias("source_id"), F.lit("all").alias("feed_id"),
        F.struct("doc_id", "pos").alias("pos"), F.lit(True).alias("valid"),
        F.concat(F.lit("https://news.example.com/"), F.md5("line")).alias("article_url"),
    )
    return X.dedupe_items(lines).select("source_id", "article_url", "pos.doc_id", "pos.pos")


def item_map_merge(spark, folder):
    merged = X.merge_items(remembered(spark, folder), hashed_current(spark, folder))
    return merged.select(*X.ITEM, "record_hash", "is_new")


def checkpoint_retention(spark, folder):
    """With room for eight items per feed, so that the limit shows."""
    merged = X.merge_items(remembered(spark, folder), hashed_current(spark, folder))
    return X.retain_items(merged, 8).select(*X.ITEM, "record_hash")


def checkpoint_upsert(spark, folder):
    """Checkpoints of an earlier poll, overwritten by the poll's results; rows
    without a publish flag are invalid."""
    old = checkpoints(spark, folder).select(
        *X.FEED, "content_hash", F.lit(1).alias("round"),
        F.when(F.col("feed_id") != "es", F.col("events_published")).alias("events_published"),
    )
    new = X.semantic_hash(hashed_current(spark, folder)).filter(F.col("feed_id") != "es").select(
        *X.FEED, "content_hash", F.lit(2).alias("round"), F.lit(True).alias("events_published")
    )
    state = upsert(old, new, X.FEED, [F.desc("round")])
    return state.withColumn("verdict", state_verdict(["content_hash", "events_published"]))


def discovery_events_build(spark, folder):
    found = scan(spark, folder).discovered
    return found.select(
        "schema_version", "event_id", "event_time", "run_id", "source_id",
        F.col("ingest_date").cast("string").alias("ingest_date"), "feed_item_id", "article_id",
        "feed_id", "category", "article_url", "title", "published_at", "discovered_at",
        "payload_uri", "record_hash",
    )


def fetch_requests_build(spark, folder):
    asked = scan(spark, folder).requests
    return asked.withColumn("ingest_date", F.col("ingest_date").cast("string"))


def feed_state_after_poll(spark, folder):
    """The items remembered once the poll is over."""
    return scan(spark, folder).items.select(*X.ITEM, "record_hash", "is_new")


def feed_checkpoints_after_poll(spark, folder):
    kept = scan(spark, folder).checkpoints
    return kept.select(
        *X.FEED, "content_hash", F.date_format("observed_at", "yyyy-MM-dd").alias("observed_on"),
        "events_published", "etag", "last_modified", "payload_uri",
    )


def dedupe_by_event_id(spark, folder):
    """Every request sent twice, as a retry would; ids tell the copies apart."""
    asked = X.fetch_requests(
        hashed_current(spark, folder).withColumn("run_id", F.lit("run"))
        .withColumn("observed_at", now())
    )
    return asked.unionByName(asked).dropDuplicates(["event_id"]).select(
        "event_id", "article_id", "request_revision"
    )


QUERIES = {
    f.__name__: f
    for f in (
        feed_items_from_xml, feed_parse_verdict, feed_item_validity, feed_all_or_nothing,
        feed_item_diff, feed_semantic_hash, feed_change_status, feed_run_rollup,
        conditional_request, first_wins_dedupe, item_map_merge, checkpoint_retention,
        checkpoint_upsert, discovery_events_build, fetch_requests_build, dedupe_by_event_id,
        feed_state_after_poll, feed_checkpoints_after_poll,
    )
}
