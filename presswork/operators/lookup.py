"""Reading back what is known of an article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions import ids, urls
from presswork.operators.ordering import first_per_key

# Lookup stages in output order, and their topic keys.
STAGE_TOPICS = {"fetched": "article_fetched", "extracted": "article_extracted"}

# Event fields a summary shows when the record has them.
SUMMARY_FIELDS = (
    "event_id", "event_time", "source_id", "article_id", "requested_url", "canonical_url",
    "title", "published_at", "source_document_id", "source_payload_uri", "content_hash",
    "payload_uri", "extracted_payload_uri", "extracted_payload_hash", "extractor_version",
)


def lookup_id(article_id: str | None, url: str | None) -> Column:
    """The id asked for, or the one that belongs to a URL."""
    if article_id:
        return F.lit(article_id)
    if not url:
        raise ValueError("a lookup needs an id or an address")
    return ids.article_id(urls.norm_url(F.lit(url)))


def stage_of(topic_key: Column) -> Column:
    out = F.lit(None).cast("string")
    for stage, key in STAGE_TOPICS.items():
        out = F.when(topic_key == key, F.lit(stage)).otherwise(out)
    return out


def stage_rank(stage: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STAGE_TOPICS]), stage)


def stage_records(events: DataFrame, stage: str = "all") -> DataFrame:
    """Records of one stage, or of both together, tagged with their stage."""
    if stage != "all" and stage not in STAGE_TOPICS:
        raise ValueError(f"unknown stage: {stage}")
    tagged = events.withColumn("stage", stage_of(F.col("topic_key")))
    return tagged.filter(
        F.col("stage").isNotNull() if stage == "all" else F.col("stage") == stage
    )


def read_since(events: DataFrame, since: Column, article: Column) -> DataFrame:
    """Records of an article from a point in time on. Both conditions are plain
    comparisons, so they reach the scan."""
    return events.filter((F.col("ts") >= since) & (F.col("article_id") == article))


def latest_per_stage(records: DataFrame) -> DataFrame:
    """Newest record per article and stage; on equal times the first one read."""
    return first_per_key(
        records, ["article_id", "stage"], [F.desc("ts"), F.col("partition"), F.col("offset")]
    )


def lineage(records: DataFrame) -> DataFrame:
    """Per article the path of its records through the stages."""
    return records.groupBy("article_id").agg(
        F.count_if(F.col("stage") == "fetched").alias("fetched"),
        F.count_if(F.col("stage") == "extracted").alias("extracted"),
        F.min(F.when(F.col("stage") == "fetched", F.col("ts"))).alias("first_fetched"),
        F.max(F.when(F.col("stage") == "extracted", F.col("ts"))).alias("last_extracted"),
    )


def record_summary(records: DataFrame) -> DataFrame:
    """Position and identity of records, and how much they hold.

    Fields a stage does not have are left out of the select; counts come from
    the block and image arrays when there are any.
    """
    shown = [c for c in SUMMARY_FIELDS if c in records.columns]
    counts = [
        F.size(c).alias(name)
        for c, name in (("content_blocks", "block_count"), ("images", "image_count"))
        if c in records.columns
    ]
    return records.select("stage", "topic", "partition", "offset", *shown, *counts)


def select_content(latest: DataFrame, side: DataFrame, pages: DataFrame) -> DataFrame:
    """Readable content per article: inline body, else the side payload's body,
    else the fetched page. The extracted record is preferred.

    latest: latest_per_stage rows with body_text, extracted_payload_uri,
    payload_uri. side: extracted_payload_uri, side_text. pages: payload_uri, html.
    verdict tells of a side payload or page that is missing.
    """
    extracted = F.col("stage") == "extracted"
    inline = F.coalesce(F.col("body_text"), F.lit("")) != ""
    # The choice shuffles keys only; bodies of the chosen records follow.
    keys = latest.groupBy("article_id").agg(F.max(stage_rank(F.col("stage"))).alias("_rank"))
    best = latest.join(keys, "article_id").filter(stage_rank(F.col("stage")) == F.col("_rank")).drop("_rank")
    # Three branches, so that rows without an address are not all sent to the
    # one partition where null join keys meet.
    here = best.filter(extracted & inline).select(
        "article_id", "stage", F.col("body_text").alias("content"), F.lit(None).cast("string").alias("verdict")
    )
    aside = best.filter(extracted & ~inline).join(side, "extracted_payload_uri", "left").select(
        "article_id", "stage", F.col("side_text").alias("content"),
        F.when(F.col("side_text").isNull(), F.lit("missing_side_payload")).alias("verdict"),
    )
    raw = best.filter(~extracted).join(pages, "payload_uri", "left").select(
        "article_id", "stage", F.col("html").alias("content"),
        F.when(F.col("html").isNull(), F.lit("missing_payload")).alias("verdict"),
    )
    return here.unionByName(aside).unionByName(raw)
