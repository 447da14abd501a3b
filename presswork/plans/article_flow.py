"""Fetched events to extracted events: gates, extraction, event and size split.

Every record ends up in one frame with a ``verdict`` (null: accepted), so the
costly extraction runs once however many sinks the result feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from presswork.functions import frames, ids, urls
from presswork.functions.text import iso_micros
from presswork.operators.extraction import extract_articles
from presswork.operators.screening import fetch_gate
from presswork.operators.settle import settle
from presswork.sources.landing import extracted_payload_uri

MAX_INLINE_BYTES = 524_288
EVENT_FIELDS = (
    "schema_version", "event_id", "event_time", "run_id", "source_id", "ingest_date",
    "article_id", "requested_url", "canonical_url", "title", "summary", "body_text",
    "content_blocks", "images", "author", "published_at", "content_hash", "source_document_id",
    "source_payload_uri", "extractor_version", "extraction_status", "extracted_payload_uri",
    "extracted_payload_hash",
)


#: Columns extraction adds; null for records a gate stops before it.
ARTICLE = (
    "canonical_url", "title", "summary", "author", "published_at", "content_blocks", "images",
    "body_text", "rejection_reason", "extractor_version",
)


def early_gates(fetched: DataFrame, landed: DataFrame) -> DataFrame:
    """Fetched events with payload and the ``verdict`` of the checks that need no
    HTML: ``stopped`` (what the caller found, if there is such a column), fetch
    status, payload hash, extractor name.

    fetched carries extractor and attribution_policy of its source. Only events that
    pass the fetch gate have an address to look up; the others get keys of their own,
    so that they neither find a payload nor meet in one task.
    """
    gate = fetch_gate(F.col("fetch_status"), F.col("payload_uri"))
    if "stopped" in fetched.columns:
        gate = F.coalesce("stopped", gate)
    plain = [f.name for f in fetched.schema if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    nowhere = F.concat(F.lit("nowhere/"), F.xxhash64(*plain))
    keyed = fetched.withColumn("_gate", gate).withColumn(
        "_uri", F.when(F.col("_gate").isNull(), F.col("payload_uri")).otherwise(nowhere)
    )
    # the address holds its day; where both sides have it, only the days in question are read
    stored, keys = [F.col("payload_uri").alias("_uri"), "payload"], ["_uri"]
    if "ingest_date" in landed.columns and "ingest_date" in fetched.columns:
        kind = landed.schema["ingest_date"].dataType
        keyed = keyed.withColumn("_day", F.col("ingest_date").try_cast(kind))
        stored, keys = [*stored, F.col("ingest_date").alias("_day")], ["_uri", "_day"]
    extractor = F.coalesce("extractor", F.lit("html_article"))
    verdict = F.coalesce(
        F.col("_gate"),
        F.when(F.col("payload").isNull(), F.lit("missing_payload"))
        .when(F.sha2("payload", 256) != F.col("content_hash"), F.lit("hash_mismatch"))
        .when(extractor != "html_article", F.concat(F.lit("unsupported extractor: "), extractor)),
    )
    found = keyed.join(landed.select(*stored), keys, "left")
    return settle(found, verdict=verdict).drop("_gate", "_uri", "_day")


def gate_stage(verdict: Column) -> Column:
    """Stage a verdict is reported under."""
    return F.when(verdict.isin("missing_payload", "hash_mismatch"), "payload_read").otherwise(
        "article_extract"
    )


def extract_fetched(fetched: DataFrame, landed: DataFrame) -> DataFrame:
    """Fetched events with article columns and the verdict of all gates.

    One frame from end to end: a record that an early gate stops goes through the HTML
    stage without its payload, where it costs nothing, and has null article columns.
    """
    gated = early_gates(fetched, landed).withColumns({
        "payload": F.when(F.col("verdict").isNull(), F.col("payload")),
        "require_canonical": F.coalesce(
            F.col("attribution_policy") == "canonical_link_required", F.lit(False)
        ),
        "fallback_url": F.col("requested_url"),
    })
    passed = extract_articles(gated.withColumnRenamed("verdict", "_early"))
    resolved = urls.norm_url(
        urls.resolve_url(F.col("requested_url"), F.coalesce("canonical_url", "requested_url"))
    )
    late = (
        F.when(
            F.col("require_canonical") & F.col("canonical_url").isNull(), F.lit("no_canonical_url")
        )
        .when(F.col("rejection_reason").isNotNull(),
              F.concat(F.lit("rejected: "), "rejection_reason"))
        .when(
            (F.coalesce("title", F.lit("")) == "") | (F.coalesce("body_text", F.lit("")) == ""),
            F.lit("no_title_or_body"),
        )
        .when(F.col("resolved_url").isNull(), F.lit("invalid_canonical_url"))
    )
    judged = settle(passed, resolved_url=resolved).withColumn("verdict", F.coalesce("_early", late))
    shown = judged.withColumn("canonical_url", F.col("resolved_url")).drop("resolved_url")
    open_ = F.col("_early").isNull()
    return shown.withColumns({c: F.when(open_, F.col(c)) for c in ARTICLE}).drop("_early")


def event_columns(articles: DataFrame, observed_at: Column) -> DataFrame:
    """``articles`` (fetched identity and article columns) with the columns of their
    article_extracted event, not yet size-checked."""
    content_hash = ids.content_sha256(F.encode("body_text", "UTF-8"))
    blocks = F.transform("content_blocks", lambda b: F.struct(
        b["ordinal"].alias("ordinal"), b["text"].alias("text"), b["type"].alias("type")))
    images = F.transform("images", lambda i: F.struct(
        i["alt"].alias("alt"), i["caption"].alias("caption"), i["ordinal"].alias("ordinal"),
        i["url"].alias("url")))
    none = F.lit(None).cast("string")
    return articles.withColumn("content_hash", content_hash).withColumns({
        "schema_version": F.lit("article.extracted.v3"),
        "event_id": ids.stable_id("event", "article.extracted.v3", F.col("article_id"),
                                  F.col("source_document_id"), F.col("content_hash")),
        "event_time": iso_micros(observed_at),
        "ingest_date": F.col("ingest_date").cast("string"),
        "content_blocks": blocks,
        "images": images,
        "published_at": iso_micros(F.col("published_at")),
        "source_payload_uri": F.col("payload_uri"),
        "extraction_status": F.lit("success"),
        "extracted_payload_uri": none,
        "extracted_payload_hash": none,
    })


def extracted_events(articles: DataFrame, observed_at: Column) -> DataFrame:
    """article_extracted events of accepted articles, not yet size-checked."""
    return event_columns(articles, observed_at).select(*EVENT_FIELDS)


def event_json(events: DataFrame, **replaced: Column) -> Column:
    """Canonical JSON of an extracted event, some columns replaced."""
    fields = {c: F.col(c) for c in EVENT_FIELDS if c in events.columns}
    return frames.canonical_json(**{**fields, **replaced})


def split_oversize(events: DataFrame, limit: int = MAX_INLINE_BYTES) -> DataFrame:
    """Events small enough for the bus, as ``json``; what does not fit is in ``side_json``.

    An oversize event keeps empty text, blocks and images and points to its
    full JSON by address and hash. One that is still too large gets a verdict.
    """
    sized = events.withColumn("_full", event_json(events)).withColumn(
        "_big", frames.wire_bytes(F.col("_full")) > limit
    )
    digest = F.when(F.col("_big"), F.sha2(F.encode("_full", "UTF-8"), 256))
    pointed = sized.withColumn("extracted_payload_hash", digest).withColumn(
        "extracted_payload_uri",
        F.when(
            F.col("_big"),
            extracted_payload_uri(F.col("source_id"), F.col("ingest_date"), F.col("article_id"),
                                  F.col("source_document_id"), F.col("extracted_payload_hash")),
        ),
    )
    empty = F.lit(0)
    slim = pointed.withColumns(
        {
            "body_text": F.when(F.col("_big"), F.lit("")).otherwise(F.col("body_text")),
            "content_blocks": F.when(F.col("_big"), F.slice("content_blocks", 1, empty))
            .otherwise(F.col("content_blocks")),
            "images": F.when(F.col("_big"), F.slice("images", 1, empty)).otherwise(F.col("images")),
        }
    )
    return (
        slim.withColumn("json", F.when(F.col("_big"), event_json(slim)).otherwise(F.col("_full")))
        .withColumn("inline_event_bytes", frames.wire_bytes(F.col("json")))
        .withColumn("side_json", F.when(F.col("_big"), F.col("_full")))
        .withColumn(
            "size_verdict",
            F.when(F.col("inline_event_bytes") > limit,
                   F.concat(F.lit("slim event too large: "), "inline_event_bytes",
                            F.lit(f" > {limit}"))),
        )
        .drop("_full", "_big")
    )


def side_payloads(split: DataFrame) -> DataFrame:
    """Payload rows of oversize events, for write_if_absent."""
    return split.filter(F.col("side_json").isNotNull()).select(
        F.col("extracted_payload_uri").alias("payload_uri"),
        F.col("extracted_payload_hash").alias("content_hash"),
        "source_id", "ingest_date", F.encode("side_json", "UTF-8").alias("payload"),
    )


def outcome_stats(articles: DataFrame) -> DataFrame:
    """How much was extracted per article."""
    return articles.select(
        "article_id", F.char_length("body_text").alias("body_length"),
        F.size("content_blocks").alias("block_count"), F.size("images").alias("image_count"),
    )
