"""Fetch requests to landed payloads, fetched events, completions, dead letters, retries.

judge() decides every request of a batch once: decoding, source, completion lookup,
redirects, HTTP attempts, size and document checks. The sinks below are selections of its
result. Per article and revision one request publishes; the others, now or later, answer
with its outcome. A fetch that failed stays open.

Answers come as a table of responses, one row per address and attempt (status null: the
connection failed). An address either redirects or answers, for all of its attempts. The
attempt that decides is chosen by the statuses alone; only its content is looked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions import errors, frames
from presswork.operators import bus, fetching, routing
from presswork.operators.ordering import first_per_key
from presswork.operators.records import POSITION, RECORD, decoded_events, failed, with_source
from presswork.operators.screening import document_verdict, size_verdict
from presswork.operators.settle import settle
from presswork.sources.landing import absent_payloads
from presswork.sources.runs import KeyedRuns
from presswork.streaming import manifest

SERVICE = "fetcher"
SCHEMA = "article.fetch_requested.v3"
KEY = fetching.COMPLETION
REQUEST = (
    "run_id string, source_id string, ingest_date string, article_id string, requested_url string, "
    "request_revision string"
)
RESPONSE = (
    "url string, attempt int, status_code int, location string, content_type string, "
    "declared_length string, payload binary"
)
OUTCOME = ("source_document_id", "payload_uri", "status_code", "content_type", "content_length_bytes", "content_hash")
STATE = (
    "article_id string, request_revision string, level int, source_document_id string, payload_uri string, "
    "status_code int, content_type string, content_length_bytes bigint, content_hash string"
)
#: How far a fetch has come; a key never goes back.
LEVELS = ("open", "landed", "published", "completed")
EVENTS = "topic string, message_key string, event_id string, json string"
LANDING = "payload_uri string, content_hash string, source_id string, ingest_date string, payload binary"
ANSWERS = (
    "topic string, partition int, offset bigint, attempts bigint, article_id string, request_revision string, "
    "status string, error_class string, error_message string, source_document_id string, payload_uri string"
)
RETRIES = f"{RECORD}, source_id string, attempts bigint, error_message string"
REDIRECTS = (301, 302, 303, 307, 308)


def completions(root: str) -> KeyedRuns:
    """The state of fetches, one row per article and revision."""
    return KeyedRuns(f"{root}/state", tuple(KEY), STATE)


def _apart(responses: DataFrame, attempts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Redirect edges, per address the statuses of its attempts in order, and the content
    of the attempts that were answered with a page."""
    moved = F.coalesce(F.col("status_code").isin(*REDIRECTS), F.lit(False))
    redirects = responses.filter(moved).groupBy("url").agg(F.min_by("location", "attempt").alias("location"))
    tried = responses.filter(~moved & (F.col("attempt") <= attempts))
    answers = tried.groupBy(F.col("url").alias("final_url")).agg(
        F.sort_array(F.collect_list(F.struct("attempt", "status_code"))).alias("answers")
    )
    content = tried.filter(F.col("status_code").between(200, 299)).select(
        F.col("url").alias("final_url"), "attempt", "content_type", "declared_length", "payload"
    )
    return fetching.redirect_edges(redirects), answers, content


def _with_answer(requests: DataFrame, answers: DataFrame, content: DataFrame) -> DataFrame:
    """Requests with the answer that decides and those that were tried again before it:
    the first that is worth no retry, or the last."""
    asked = F.when(F.col("error").isNull() & F.col("done").isNull() & F.col("verdict").isNull(), F.col("final_url"))
    nowhere = F.concat(F.lit("\0"), F.concat_ws("/", *POSITION))
    keyed = requests.withColumn("_at", F.coalesce(asked, nowhere))
    found = keyed.join(answers.withColumnRenamed("final_url", "_at"), "_at", "left").drop("_at")
    blocked = F.col("blocked_status_codes")

    def judged(a: Column) -> Column:
        kind = F.when(a["status_code"].isNull(), F.lit("transport")).otherwise(
            errors.status_class(a["status_code"], blocked)
        )
        return F.struct(kind.alias("kind"), a.alias("answer"))

    tried = F.transform("answers", judged)
    again = lambda t: t["kind"].isin("transport", "retryable")
    held = found.withColumn("_tried", tried).drop("answers")
    firm = F.array_position(F.transform("_tried", again), F.lit(False)).cast("int")
    place = F.when(firm > 0, firm).otherwise(F.size("_tried"))
    chosen = held.withColumn("_place", place)
    decided = chosen.withColumns({
        "_last": F.get("_tried", F.col("_place") - 1),
        "retried": F.transform(
            F.slice("_tried", 1, F.greatest(F.col("_place") - 1, F.lit(0))),
            lambda t: F.struct(
                F.when(t["kind"] == "transport", "TransportError").otherwise("HTTPStatusError").alias("error_class"),
                t["answer"]["status_code"].alias("status_code"),
            ),
        ),
    }).select(
        *requests.columns, "retried", F.col("_last.kind").alias("kind"), "_last.answer.*"
    )
    # an answer that is no page is judged by its status, and looks nothing up
    at = decided.withColumn("_at", F.when(F.col("kind") == "ok", F.col("final_url")).otherwise(nowhere))
    return at.join(content.withColumnRenamed("final_url", "_at"), ["_at", "attempt"], "left").drop("_at")


def _fetch_error(max_bytes: int, empty_ok: bool = False) -> Column:
    """Why a request without earlier error or completion was not fetched."""
    status, verdict = F.col("status_code"), F.col("verdict")
    said = F.concat(F.lit("status "), status)
    size = size_verdict(F.col("declared_length"), F.col("payload"), max_bytes, empty_ok)
    document = document_verdict(F.col("content_type"), F.col("payload"), F.col("invalid_document_markers"))
    fetch = lambda *a: failed("article_fetch", *a)
    return (
        F.when(verdict == "malformed_redirect", fetch(verdict, "MalformedRedirect", True))
        .when(verdict.isNotNull(), fetch(verdict, "HttpFetchError", False))
        .when(F.col("kind").isNull() | (F.col("kind") == "transport"),
              fetch(F.lit("no answer"), "TransportError", True))
        .when(F.col("kind") == "blocked",
              fetch(F.concat(F.lit("blocked "), said), "SourceHttpPolicyBlocked", False, status))
        .when(F.col("kind") != "ok", fetch(said, "HTTPStatusError", F.col("kind") == "retryable", status))
        .when(size.isNotNull(), fetch(size, "HttpFetchError", False, status))
        .when(document.isNotNull(), fetch(document, "InvalidArticleDocument", False, status))
    )


def judge(
    records: DataFrame, state: Callable[[DataFrame], DataFrame], settings: DataFrame,
    responses: DataFrame, observed_at: Column,
    registry: DataFrame | None = None, attempts: int = 3, max_bytes: int = 5_000_000, empty_ok: bool = False,
) -> DataFrame:
    """Requests with ``error``, ``route``, the stored outcome of those ``done`` before,
    and the payload and event columns of those fetched now.

    ``state`` looks up the stored fetches (columns of STATE) of some events.
    ``settings``: enabled, domain, redirect_domains, blocked_status_codes and
    invalid_document_markers per source. ``empty_ok``: an empty page is fetched like any
    other instead of being refused.
    """
    events = with_source(decoded_events(records, SCHEMA, REQUEST, registry), settings)
    stored = state(events.filter(F.col("error").isNull()))
    done = stored.filter(F.col("level") == len(LEVELS) - 1).select(*KEY, F.struct(*OUTCOME).alias("done"))
    known = events.join(done, KEY, "left")
    edges, answers, content = _apart(responses, attempts)
    open_ = F.col("error").isNull() & F.col("done").isNull()
    starts = known.withColumns({
        # not an address, but one of its own, where nothing is fetched
        "url": F.when(open_, F.col("requested_url")).otherwise(F.concat_ws("/", *POSITION)),
        "domains": F.array("domain"),
        "redirect_domains": F.coalesce("redirect_domains", F.array().cast("array<string>")),
    })
    found = _with_answer(fetching.follow_redirects(starts, edges), answers, content)
    wrong = F.when(open_, _fetch_error(max_bytes, empty_ok))
    judged = settle(found, error=F.coalesce("error", wrong))
    good = F.col("error").isNull() & F.col("done").isNull()
    fetched = fetching.fetched_columns(judged.withColumn("payload", F.when(good, F.col("payload"))), observed_at)
    again = F.struct(F.lit("MalformedRedirect").alias("error_class"), F.lit(None).cast("int").alias("status_code"))
    lost = F.array_repeat(again, attempts - 1)
    shown = fetched.select(
        *records.columns, "run_id", "source_id", "ingest_date", "article_id", "requested_url", "request_revision",
        "error", "done",
        F.when(F.col("error.error_class") == "MalformedRedirect", lost).otherwise(F.col("retried")).alias("retried"),
        *[F.when(good, F.col(c)).alias(c) for c in fetching.FETCHED_FIELDS if c not in (
            "run_id", "source_id", "ingest_date", "article_id", "requested_url")],
        "payload", observed_at.alias("observed_at"), F.lit(False).alias("untyped"),
    )
    return routing.with_route(shown)


def _fetched(judged: DataFrame) -> DataFrame:
    """The request that publishes, per article and revision."""
    now = judged.filter((F.col("route") == "ok") & F.col("done").isNull())
    return first_per_key(now, KEY, ["partition", "offset"])


def landing_rows(judged: DataFrame, before: DataFrame) -> DataFrame:
    """Payloads whose address holds nothing yet."""
    return absent_payloads(_fetched(judged), before).select(
        "payload_uri", "content_hash", "source_id", "ingest_date", "payload"
    )


def event_rows(judged: DataFrame) -> DataFrame:
    body = frames.canonical_json(**{c: F.col(c) for c in fetching.FETCHED_FIELDS})
    return _fetched(judged).select(
        bus.topic_name(F.lit("article_fetched")).alias("topic"), F.col("article_id").alias("message_key"),
        "event_id", body.alias("json"),
    )


def dead_rows(judged: DataFrame) -> DataFrame:
    return routing.dead_letters(judged, SERVICE)


def retry_rows(judged: DataFrame) -> DataFrame:
    return judged.filter("route = 'retry'").select(
        *POSITION, "ts", "value", "source_id", (F.coalesce("attempts", F.lit(0)) + 1).cast("bigint").alias("attempts"),
        F.col("error.error_message").alias("error_message"),
    )


def metric_rows(judged: DataFrame) -> DataFrame:
    """consumer_retry_count per request to be tried again, article_fetch_retry_count per
    HTTP attempt that was followed by another."""
    consumer = routing.retry_metrics(judged.filter("route = 'retry'"), "consumer_retry_count", F.lit(SERVICE))
    attempts = judged.select("source_id", "observed_at", F.explode("retried").alias("try")).select(
        F.lit(SERVICE).alias("service"), F.lit("article_fetch_retry_count").alias("metric_name"),
        F.lit(1.0).alias("metric_value"), F.lit("count").alias("metric_unit"),
        F.create_map(
            F.lit("source_id"), F.col("source_id"), F.lit("stage"), F.lit("article_fetch"),
            F.lit("error_class"), F.col("try.error_class"),
            F.lit("status_code"), F.col("try.status_code").cast("string"),
        ).alias("dimensions"),
        "observed_at",
    )
    return consumer.unionByName(bus.metric_events(attempts)).withColumn("dimensions", F.to_json("dimensions"))


def answer_rows(judged: DataFrame) -> DataFrame:
    """What every request is answered with: published, already_processed, retry or dlq."""
    narrow = judged.select(*POSITION, "attempts", *KEY, "route", "error", "done", *OUTCOME)
    place = F.struct("partition", "offset", F.struct(*OUTCOME).alias("outcome"))
    first = narrow.filter((F.col("route") == "ok") & F.col("done").isNull()).groupBy(*KEY).agg(F.min(place).alias("_first"))
    known = narrow.join(first, KEY, "left")
    own = (F.col("_first.partition") == F.col("partition")) & (F.col("_first.offset") == F.col("offset"))
    outcome = F.coalesce("done", "_first.outcome")
    status = F.when(F.col("route") != "ok", F.col("route")).when(
        F.col("done").isNull() & own, F.lit("published")).otherwise("already_processed")
    return known.select(
        *POSITION, (F.coalesce("attempts", F.lit(0)) + 1).cast("bigint").alias("attempts"), *KEY, status.alias("status"),
        F.col("error.error_class").alias("error_class"), F.col("error.error_message").alias("error_message"),
        F.when(F.col("route") == "ok", outcome["source_document_id"]).alias("source_document_id"),
        F.when(F.col("route") == "ok", outcome["payload_uri"]).alias("payload_uri"),
    )


def _levels(judged: DataFrame, reached: int) -> DataFrame:
    """One row per key a batch worked on: its highest level and that one's outcome."""
    worked = judged.filter(F.col("done").isNull() & F.col("article_id").isNotNull() & F.col("request_revision").isNotNull())
    good = F.col("route") == "ok"
    row = F.struct(
        F.when(good, F.lit(reached)).otherwise(F.lit(0)).alias("level"),
        (-F.col("partition")).alias("p"), (-F.col("offset")).alias("o"), *OUTCOME,
    )
    return worked.groupBy(*KEY).agg(F.max(row).alias("_top")).select(*KEY, "_top.level", *[f"_top.{c}" for c in OUTCOME])


def keep(root: str):
    """The step that brings the state of fetches to a batch's version."""
    def write(judged: DataFrame, batch_id: int) -> None:
        completions(root).write(_levels(judged, len(LEVELS) - 1), batch_id)

    return write


def states(spark: SparkSession, root: str) -> DataFrame:
    """Article, revision and how far its fetch has come, a batch that is being worked on
    included: its payloads may have landed, its events may be out."""
    upto = manifest.visible_upto(spark, root)
    held = completions(root).read(spark, upto).select(*KEY, "level")
    steps = manifest.steps(spark, root, upto + 1)
    if manifest.JUDGED in steps:
        judged = spark.read.parquet(manifest.batch_folder(f"{root}/{manifest.JUDGED}", upto + 1))
        held = held.unionByName(
            _levels(judged, 2 if "events" in steps else 1 if "landing" in steps else 0).select(*KEY, "level")
        )
    top = held.groupBy(*KEY).agg(F.max("level").alias("level"))
    return top.select(*KEY, F.element_at(F.array(*map(F.lit, LEVELS)), F.col("level") + 1).alias("state"))
