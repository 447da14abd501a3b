"""Queries that run the streaming jobs over the driver tables to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.functions import ids
from presswork.operators import bus, routing
from presswork.plans import event_queries, feed_queries
from presswork.plans.article_queries import fetched_pages, site_config
from presswork.plans.metric_queries import day, metric_records
from presswork.operators.extraction import compile_config
from presswork.sources import carriers as C
from presswork.sources.tables import stream_events
from presswork.session import new_run_folder
from presswork.streaming import jobs


def _folders(spark, job):
    root = new_run_folder(spark, job)
    return f"{root}/out", f"{root}/state", f"{root}/checkpoint"


def _bus(spark, folder):
    return C.as_bus_events(stream_events(spark, folder))


def stream_metric_flush(spark, folder):
    out, _, checkpoint = _folders(spark, "flush")
    jobs.flush_metrics(metric_records(_bus(spark, folder)), out, checkpoint)
    return spark.read.parquet(out).select(day(), "name", "value", "unit", "dimensions")


def stream_skip_malformed(spark, folder):
    out, _, checkpoint = _folders(spark, "decode")
    framed = C.as_framed(_bus(spark, folder))
    jobs.decode_stream(framed, event_queries.registry(spark), out, checkpoint)
    return spark.read.parquet(out).groupBy("topic").agg(
        F.count(F.lit(1)).alias("consumed"), F.count_if("skipped").alias("skipped")
    )


def stream_three_way_route(spark, folder):
    out, _, checkpoint = _folders(spark, "route")
    records = event_queries.as_consumed(C.as_crawl_log(_bus(spark, folder)))
    jobs.route_stream(records, out, checkpoint, park_unclaimed=True)
    return spark.read.parquet(out).select("event_id", "route", "advances")


def stream_retry_state(spark, folder):
    """Every (user, k % 10) is one message, its events are the tries."""
    _, root, checkpoint = _folders(spark, "retry")
    records = event_queries.as_consumed(
        C.as_crawl_log(_bus(spark, folder)),
        (F.col("user_id") * 10 + F.col("k") % 10).alias("offset"),
    )
    tries = routing.with_route(records).select(
        *jobs.RETRY_KEY, F.col("event_id").alias("seq"), "route"
    )
    jobs.retry_state_stream(tries, root, checkpoint)
    state = jobs.retry_runs(root)
    return state.read(spark, state.latest(spark))


def stream_feed_diff(spark, folder):
    """Two polls of all feeds; what the second one finds new or changed."""
    run = new_run_folder(spark, "feeds")
    polls, schema = f"{run}/polls", C.current_snapshot(spark, folder).schema
    for n, poll in enumerate((C.previous_snapshot(spark, folder), C.current_snapshot(spark, folder))):
        poll.select(*schema.names).write.mode("append").parquet(polls)
        jobs.feed_diff_stream(
            spark.readStream.schema(schema).parquet(polls), f"{run}/state", f"{run}/out{n}",
            f"{run}/checkpoint",
        )
    return spark.read.parquet(f"{run}/out1").select(
        *feed_queries.X.ITEM, "record_hash", "change"
    )


def stream_fetch_completion(spark, folder):
    out, root, checkpoint = _folders(spark, "completion")
    requests = _bus(spark, folder).filter(F.col("topic_key") == "article_fetch_requested").select(
        "event_id", "article_id", F.concat(F.lit("rev"), F.col("k") % 2).alias("request_revision")
    )
    jobs.completion_stream(requests, root, out, checkpoint)
    return spark.read.parquet(out).select("event_id", *jobs.fetching.COMPLETION, "status")


def stream_extract(spark, folder):
    """Fetched page events from a bus folder through extraction."""
    run = new_run_folder(spark, "extract")
    fetched, landed = fetched_pages(spark, folder)
    events = fetched.drop("extraction", "extractor", "attribution_policy")
    events.write.parquet(f"{run}/fetched")
    jobs.extract_stream(
        spark.readStream.schema(events.schema).parquet(f"{run}/fetched"), landed,
        compile_config(site_config(spark)), f"{run}/out", f"{run}/checkpoint",
    )
    return spark.read.parquet(f"{run}/out").select(
        "page_id", "verdict", F.size("content_blocks").alias("blocks"),
        ids.content_sha256(F.col("body_text")).alias("body_sha256"),
    )


def multi_topic_scan(spark, folder):
    """The four topics the metrics job follows, out of a bus folder with all."""
    run = new_run_folder(spark, "topics")
    routed = bus.route(event_queries.routable(spark, folder)).filter(F.col("verdict").isNull())
    shown = routed.select("event_id", "message_key", "topic")
    bus.write_topics(shown, f"{run}/bus")
    followed = [
        bus.TOPIC_PREFIX + k
        for k in ("article_fetched", "article_extracted", "pipeline_metric", "dlq")
    ]
    stream = bus.read_topics(
        spark, f"{run}/bus", "event_id bigint, message_key string, topic string", followed
    )
    jobs.run_batches(
        stream, f"{run}/checkpoint",
        lambda batch, batch_id: jobs.write_batch(batch, f"{run}/out", batch_id),
    )
    return spark.read.parquet(f"{run}/out").select("topic", "event_id", "message_key")


QUERIES = {
    f.__name__: f
    for f in (
        stream_metric_flush, stream_skip_malformed, stream_three_way_route, stream_retry_state,
        stream_feed_diff, stream_fetch_completion, stream_extract, multi_topic_scan,
    )
}
