"""Article fetches: redirects, completions and fetched events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions import ids, urls
from presswork.functions.binding import let
from presswork.functions.text import iso_micros
from presswork.operators.ordering import first_per_key
from presswork.sources.landing import article_payload_uri

MAX_REDIRECTS = 5


def redirect_edges(responses: DataFrame) -> DataFrame:
    """Redirect responses (url, location) with their absolute target.

    Each Location is resolved once, here, however many chains pass through it.
    """
    target = urls.resolve_url(F.col("url"), F.col("location"))
    return responses.select(
        F.col("url").alias("from_url"),
        (F.coalesce("location", F.lit("")) == "").alias("malformed"),
        F.when(F.coalesce("location", F.lit("")) != "", target).alias("target"),
    )


def _nowhere(url: Column) -> Column:
    """A key of its own that no URL has, for a row that looks nothing up."""
    return F.concat(F.lit("\0"), url)


def _joined_paths(first: DataFrame, then: DataFrame) -> DataFrame:
    """Paths of ``first`` continued by those of ``then`` where they go on."""
    more = then.select(F.col("from_url").alias("_at"), F.col("path").alias("_path"), F.col("end").alias("_end"))
    at = F.coalesce("end", _nowhere(F.col("from_url")))
    return first.join(more, at == F.col("_at"), "left").select(
        "from_url", F.concat("path", F.coalesce("_path", F.array().cast(first.schema["path"].dataType))).alias("path"),
        F.col("_end").alias("end"),
    )


def redirect_paths(edges: DataFrame, steps: int) -> DataFrame:
    """(from_url, path) with up to ``steps`` redirects in a row from every edge on.

    Paths double with each join, so it takes about log2(steps) joins of the edges with
    themselves, whatever the number of requests. A path ends where no edge goes on, and
    at a malformed redirect.
    """
    hop = F.struct(F.col("malformed"), F.col("target"))
    of = {1: edges.select("from_url", F.array(hop).alias("path"),
                          F.when(~F.col("malformed"), F.col("target")).alias("end"))}
    reach = 1
    while reach < steps:
        step = max(k for k in of if k <= min(reach, steps - reach))
        of[reach + step] = _joined_paths(of[reach], of[step])
        reach += step
    return of[reach].select("from_url", "path")


def follow_redirects(starts: DataFrame, edges: DataFrame, limit: int = MAX_REDIRECTS) -> DataFrame:
    """Where each request ends up, at most ``limit`` hops away.

    starts: any columns plus url, domains (array of allowed domains) and
    redirect_domains (allowed for targets only). Adds final_url, hops, verdict
    and retryable. Requests are joined once, with the paths that the edges form (every
    edge has a distinct ``from_url``), and judge the targets on theirs in order.
    """
    allowed = F.concat("domains", "redirect_domains")
    paths = redirect_paths(edges, limit + 1)
    begun = starts.withColumn("_verdict", urls.url_verdict(F.col("url"), F.col("domains")))
    asked = F.when(F.col("_verdict").isNull(), F.col("url"))
    found = begun.join(paths, F.coalesce(asked, _nowhere(F.col("url"))) == F.col("from_url"), "left")

    def step(at, hop):
        verdict = (
            F.when(at["hops"] == limit, F.lit("redirect_limit"))
            .when(hop["malformed"], F.lit("malformed_redirect"))
            .otherwise(urls.url_verdict(F.coalesce(hop["target"], F.lit("")), allowed))
        )
        return let(verdict, lambda v: F.when(at["verdict"].isNotNull(), at).when(
            v.isNull(), F.struct(hop["target"].alias("final_url"), (at["hops"] + 1).alias("hops"), v.alias("verdict"))
        ).otherwise(F.struct(at["final_url"].alias("final_url"), at["hops"].alias("hops"), v.alias("verdict"))))

    begin = F.struct(F.col("url").alias("final_url"), F.lit(0).alias("hops"), F.col("_verdict").alias("verdict"))
    end = F.when(F.col("path").isNull(), begin).otherwise(F.aggregate("path", begin, step))
    return found.select(*starts.columns, F.inline(F.array(end))).withColumn(
        "retryable", F.coalesce(F.col("verdict") == "malformed_redirect", F.lit(False))
    )


COMPLETION = ["article_id", "request_revision"]


def split_completed(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """Requests with status ``already_processed`` and the stored outcome, or
    ``new``. ``completions`` has one row per (article_id, request_revision)."""
    done = completions.withColumn("_done", F.lit(True))
    return requests.join(done, COMPLETION, "left").withColumn(
        "status", F.when(F.col("_done"), F.lit("already_processed")).otherwise("new")
    ).drop("_done")


def new_fetches(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """Open requests, one per (article_id, request_revision)."""
    fresh = requests.join(completions.select(*COMPLETION), COMPLETION, "left_anti")
    return first_per_key(fresh, COMPLETION, ["event_id"])


#: Fields of an article_fetched event, in order.
FETCHED_FIELDS = (
    "schema_version", "event_id", "event_time", "run_id", "source_id", "ingest_date", "article_id",
    "requested_url", "source_document_id", "fetched_at", "status_code", "content_type",
    "content_length_bytes", "payload_uri", "content_hash", "fetch_status",
)


def fetched_columns(responses: DataFrame, observed_at: Column) -> DataFrame:
    """``responses`` with the columns of their article_fetched event.

    responses: run_id, source_id, ingest_date, article_id, requested_url,
    status_code, content_type, payload.
    """
    digest = ids.content_sha256(F.col("payload"))
    document = ids.stable_id("source_doc", F.col("article_id"), F.col("content_hash"))
    return responses.withColumn("content_hash", digest).withColumn("source_document_id", document).withColumns({
        "schema_version": F.lit("article.fetched.v2"),
        "event_id": ids.stable_id("event", "article.fetched.v2", F.col("article_id"), F.col("content_hash")),
        "event_time": iso_micros(observed_at),
        "fetched_at": iso_micros(observed_at),
        "content_type": F.nullif("content_type", F.lit("")),
        "content_length_bytes": F.octet_length("payload").cast("bigint"),
        "payload_uri": article_payload_uri(F.col("source_id"), F.col("ingest_date"), F.col("article_id"),
                                           F.col("source_document_id")),
        "fetch_status": F.lit("success"),
    })


def fetched_events(responses: DataFrame, observed_at: Column) -> DataFrame:
    """article_fetched rows of landed responses."""
    return fetched_columns(responses, observed_at).select(*FETCHED_FIELDS)
