"""Streaming jobs: the batch operators applied to micro-batches.

State that has to outlive a batch sits in keyed runs (sources.runs), versioned by
batch id, so any executor can be lost at any time and a repeated batch reads the
same previous version and writes the same next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.errors import consumer_retry_delay
from presswork.operators import bus, feeds, fetching, metrics, routing
from presswork.plans import article_flow, extract_flow, fetch_flow
from presswork.sources.runs import KeyedRuns
from presswork.streaming import manifest
from presswork.streaming.runner import run_batches, write_batch


def flush_metrics(records: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> None:
    """Every micro-batch is one flush: its counters become points, numbered into
    publishing batches, and the next flush starts from zero."""
    def flush(batch: DataFrame, batch_id: int) -> None:
        points = metrics.batched_points(metrics.metric_points(batch))
        write_batch(points.drop("entries"), out, batch_id)

    run_batches(records, checkpoint, flush, trigger)


def windowed_counts(records: DataFrame) -> DataFrame:
    """Event-time form of the counters for append mode. The caller sets the
    watermark on the event time before taking its window; Spark then drops a
    window's state once it is closed."""
    return metrics.metric_counts(records)


def decode_stream(
    records: DataFrame, registry: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> None:
    """Decodes framed records; bad ones are kept apart and never stop the stream.

    The registry is read again for every batch, so a schema version registered
    meanwhile is known to the next one.
    """
    def decode(batch: DataFrame, batch_id: int) -> None:
        decoded = bus.decode(batch, registry).withColumn("skipped", F.col("verdict").isNotNull())
        write_batch(decoded.drop("value"), out, batch_id, "skipped")

    run_batches(records, checkpoint, decode, trigger)


class StreamStopped(RuntimeError):
    """An error no stage claimed: the batch is not committed."""


def route_stream(
    records: DataFrame, out: str, checkpoint: str, park_unclaimed: bool = False,
    trigger: dict | None = None,
) -> None:
    """Writes ok, dlq and retry records apart, in one pass.

    Records with an unclaimed error stop the stream before its position moves,
    unless ``park_unclaimed`` sets them aside for inspection.
    """
    def split(batch: DataFrame, batch_id: int) -> None:
        routed = routing.with_route(batch)
        if not park_unclaimed and not routed.filter(F.col("route") == "stop").isEmpty():
            raise StreamStopped(f"unclaimed errors in batch {batch_id}")
        write_batch(routed, out, batch_id, "route")

    run_batches(records, checkpoint, split, trigger)


def route_records(
    records: DataFrame, root: str, service: str, observed_at: Column | None = None,
    park_unclaimed: bool = False, trigger: dict | None = None,
) -> None:
    """Processed records to what becomes of them: accepted ones, dead letters, records to
    be tried again with their retry metrics, and parked ones (sinks of ``root``, shown
    together).

    records: topic, partition, offset, value, source_id, error, untyped. An unclaimed
    error stops the stream before anything of its batch is shown, unless
    ``park_unclaimed`` sets it aside; the batch is judged once in either case.
    """
    at = F.current_timestamp() if observed_at is None else observed_at

    def judge(batch: DataFrame, batch_id: int) -> DataFrame:
        return routing.with_route(batch.withColumn("observed_at", at))

    def parked(judged: DataFrame, batch_id: int) -> DataFrame:
        stray = judged.filter("route = 'stop'")
        if not park_unclaimed and not stray.isEmpty():
            raise StreamStopped(f"unclaimed errors in batch {batch_id}")
        return stray

    def metric_rows(judged: DataFrame, batch_id: int) -> DataFrame:
        emitted = routing.retry_metrics(judged.filter("route = 'retry'"), "consumer_retry_count", F.lit(service))
        return emitted.withColumn("dimensions", F.to_json("dimensions"))

    manifest.run_judged(records, root, judge, {
        "parked": parked,
        "accepted": lambda judged, _: judged.filter("route = 'ok'"),
        "dead": lambda judged, _: routing.dead_letters(judged, service),
        "retries": lambda judged, _: judged.filter("route = 'retry'"),
        "metrics": metric_rows,
    }, trigger=trigger)


RETRY_KEY = ["topic", "partition", "offset"]
RETRY_STATE = "topic string, partition int, offset bigint, attempts bigint, delay_seconds double"


def retry_attempts(state: DataFrame, tries: DataFrame) -> DataFrame:
    """Open attempts per record after a batch of tries.

    tries: RETRY_KEY, seq (order of the tries) and route. A try that gets
    through clears the attempts before it; retries after it count again.
    """
    done = tries.groupBy(*RETRY_KEY).agg(
        F.max(F.when(F.col("route") != "retry", F.col("seq"))).alias("done_at")
    )
    since = tries.join(done, RETRY_KEY).filter(
        F.col("done_at").isNull() | (F.col("seq") > F.col("done_at"))
    )
    counted = since.groupBy(*RETRY_KEY).agg(
        F.count_if(F.col("route") == "retry").alias("more")
    )
    tried = done.join(counted, RETRY_KEY, "left")
    merged = state.select(*RETRY_KEY, F.col("attempts").alias("before")).join(
        tried.withColumn("tried", F.lit(True)), RETRY_KEY, "full_outer"
    )
    kept = F.when(F.col("done_at").isNull(), F.coalesce("before", F.lit(0))).otherwise(0)
    return (
        merged.withColumn("attempts", (kept + F.coalesce("more", F.lit(0))).cast("bigint"))
        .filter(F.col("attempts") > 0)
        .select(*RETRY_KEY, "attempts",
                consumer_retry_delay(F.col("attempts")).alias("delay_seconds"))
    )


def retry_runs(root: str) -> KeyedRuns:
    """Open attempts per record."""
    return KeyedRuns(root, tuple(RETRY_KEY), RETRY_STATE)


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What turns the looked-up rows ``before`` into ``after``, for KeyedRuns.write."""
    ended = before.join(after.select(*keys), keys, "left_anti").withColumn("gone", F.lit(True))
    new = after.select(*before.columns).subtract(before)
    return new.withColumn("gone", F.lit(False)).unionByName(ended)


def retry_state_stream(
    tries: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> None:
    """Keeps the open attempts per record (retry_runs) up to date: a batch reads and
    writes the records it has tries of."""
    state = retry_runs(root)

    def update(batch: DataFrame, batch_id: int) -> None:
        before = state.read(batch.sparkSession, batch_id - 1, batch)
        state.write(changed_rows(before, retry_attempts(before, batch), RETRY_KEY), batch_id)

    run_batches(tries, checkpoint, update, trigger)


ITEM_STATE = "source_id string, feed_id string, feed_item_id string, record_hash string"


def feed_diff_stream(
    items: DataFrame, root: str, out: str, checkpoint: str, keep: int | None = None,
    trigger: dict | None = None,
) -> None:
    """New and changed items of every poll against what earlier polls saw. A batch reads
    the remembered items of its feeds and writes those that changed."""
    state = KeyedRuns(root, tuple(feeds.ITEM), ITEM_STATE, group=tuple(feeds.FEED))

    def diff(batch: DataFrame, batch_id: int) -> None:
        before = state.read(batch.sparkSession, batch_id - 1, batch.select(*feeds.FEED))
        current = feeds.with_hashes(batch)
        write_batch(feeds.diff_items(current, before).drop("known_hash"), out, batch_id)
        after = feeds.retain_items(feeds.merge_items(before, current), keep)
        after = after.select(*feeds.ITEM, "record_hash")
        state.write(changed_rows(before, after, feeds.ITEM), batch_id)

    run_batches(items, checkpoint, diff, trigger)


COMPLETION_STATE = "article_id string, request_revision string, completed_by bigint"


def completion_stream(
    requests: DataFrame, root: str, out: str, checkpoint: str, trigger: dict | None = None
) -> None:
    """First request per (article, revision) is processed; later ones answer
    already_processed. For fetches with an outcome see fetch_requests."""
    state = KeyedRuns(root, tuple(fetching.COMPLETION), COMPLETION_STATE)

    def complete(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = state.read(spark, batch_id - 1, batch)
        firsts = fetching.new_fetches(batch, done).select(
            *fetching.COMPLETION, F.col("event_id").alias("completed_by")
        )
        state.write(firsts, batch_id)
        answered = batch.join(state.read(spark, batch_id, batch), fetching.COMPLETION).withColumn(
            "status",
            F.when(F.col("completed_by") == F.col("event_id"), F.lit("published"))
            .otherwise("already_processed"),
        )
        write_batch(answered, out, batch_id)

    run_batches(requests, checkpoint, complete, trigger)


def extract_stream(
    fetched: DataFrame, landed: DataFrame, settings: DataFrame, out: str, checkpoint: str,
    trigger: dict | None = None,
) -> None:
    """Fetched events to extracted articles and rejects, written in one pass
    and told apart by the folder ``accepted``. Events of sources without
    settings are rejects.

    ``landed`` is partitioned by ingest_date, which is part of the lookup.
    """
    def extract(batch: DataFrame, batch_id: int) -> None:
        known = batch.join(settings.withColumn("_known", F.lit(True)), "source_id", "left")
        stopped = F.when(
            F.col("_known").isNull(),
            F.concat(F.lit("unknown source: "), F.coalesce("source_id", F.lit(""))),
        )
        judged = article_flow.extract_fetched(
            known.withColumn("stopped", stopped).drop("_known"), landed
        ).drop("stopped")
        shown = judged.withColumn("accepted", F.col("verdict").isNull())
        write_batch(shown, out, batch_id, "accepted")

    run_batches(fetched, checkpoint, extract, trigger)


def extract_records(
    records: DataFrame, landed: DataFrame, settings: DataFrame, root: str,
    observed_at: Column | None = None, registry: DataFrame | None = None,
    limit: int = article_flow.MAX_INLINE_BYTES, trigger: dict | None = None,
) -> None:
    """Framed article_fetched records to extracted events, side payloads, dead letters,
    retries and retry metrics (sinks of ``root``, read with manifest.committed).

    Records that may succeed later are tried again by the next batch, ahead of which
    nothing waits: ``attempts`` counts their tries.
    """
    at = F.current_timestamp() if observed_at is None else observed_at

    def judge(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        again = manifest.committed(spark, root, "retries", extract_flow.RETRIES).filter(
            F.col("batch") == batch_id - 1
        )
        new = batch.select(*extract_flow.POSITION, "ts", "value", F.lit(0).cast("bigint").alias("attempts"))
        return extract_flow.judge(
            new.unionByName(again.select(*new.columns)), landed, settings, at, registry, limit
        )

    def side(judged: DataFrame, batch_id: int) -> DataFrame:
        return extract_flow.side_rows(
            judged, manifest.committed(judged.sparkSession, root, "side", extract_flow.SIDE)
        )

    manifest.run_judged(records, root, judge, {
        "events": lambda judged, _: extract_flow.event_rows(judged),
        "side": side,
        "dead": lambda judged, _: extract_flow.dead_rows(judged),
        "retries": lambda judged, _: extract_flow.retry_rows(judged),
        "metrics": lambda judged, _: extract_flow.metric_rows(judged),
    }, trigger=trigger)


def fetch_requests(
    records: DataFrame, responses: DataFrame, settings: DataFrame, root: str,
    observed_at: Column | None = None, registry: DataFrame | None = None, attempts: int = 3,
    max_bytes: int = 5_000_000, trigger: dict | None = None, empty_ok: bool = False,
) -> None:
    """Framed article_fetch_requested records to landed payloads, fetched events, answers,
    dead letters, retries and retry metrics (sinks of ``root``), and the state of every
    article and revision (fetch_flow.states).

    ``responses`` are what the addresses answered (fetch_flow.RESPONSE); requests that may
    succeed later are tried again by the next batch.
    """
    at = F.current_timestamp() if observed_at is None else observed_at

    def judge(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        again = manifest.committed(spark, root, "retries", fetch_flow.RETRIES).filter(
            F.col("batch") == batch_id - 1
        )
        new = batch.select(*fetch_flow.POSITION, "ts", "value", F.lit(0).cast("bigint").alias("attempts"))
        return fetch_flow.judge(
            new.unionByName(again.select(*new.columns)),
            lambda events: fetch_flow.completions(root).read(spark, batch_id - 1, events),
            settings, responses, at, registry, attempts, max_bytes, empty_ok,
        )

    def landing(judged: DataFrame, batch_id: int) -> DataFrame:
        before = manifest.committed(judged.sparkSession, root, "landing", fetch_flow.LANDING)
        return fetch_flow.landing_rows(judged, before)

    manifest.run_judged(records, root, judge, {
        "landing": landing,
        "events": lambda judged, _: fetch_flow.event_rows(judged),
        "dead": lambda judged, _: fetch_flow.dead_rows(judged),
        "retries": lambda judged, _: fetch_flow.retry_rows(judged),
        "metrics": lambda judged, _: fetch_flow.metric_rows(judged),
        "answers": lambda judged, _: fetch_flow.answer_rows(judged),
    }, fetch_flow.keep(root), trigger)
