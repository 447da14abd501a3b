"""The whole feed poll as one plan: items and state in, events and state out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.operators import feeds as X
from presswork.sources.landing import feed_payload_uri


@dataclass
class FeedScan:
    """Lazy results of one poll over all feeds."""

    outcomes: DataFrame
    discovered: DataFrame
    requests: DataFrame
    items: DataFrame
    checkpoints: DataFrame


def scan_feeds(
    raw: DataFrame, responses: DataFrame, domains: DataFrame, remembered: DataFrame,
    checkpoints: DataFrame, now: Column, category: Column | None = None,
    keep: int | None = None,
) -> FeedScan:
    """Polls every feed in ``responses``.

    raw: source_id, feed_id, pos, link, title, summary, published_iso.
    remembered: item hashes of earlier polls. checkpoints: content_hash,
    observed_at, events_published, etag and last_modified per feed.
    """
    # Items are matched once, by hash, with what is remembered of them; counts, hash,
    # off-domain items and news of a feed are sums over the result.
    items = X.poll_items(raw, remembered)
    totals = X.poll_totals(items, domains)
    outcomes = X.poll_outcomes(responses, totals, checkpoints)
    published = outcomes.filter(F.col("status") == "published").select(*X.FEED, "content_hash")
    seen = X.observed_at(published, checkpoints, now).withColumn(
        "payload_uri", feed_payload_uri(F.col("source_id"), F.col("feed_id"),
                                        F.to_date("observed_at"), F.col("run_id"))
    )
    changed = items.filter(
        F.col("record_hash").isNotNull() & ~F.col("known_hash").eqNullSafe(F.col("record_hash"))
    ).select(*X.ITEM, "known_hash").join(seen.drop("content_hash"), X.FEED)
    # only now the texts, of the items that are news
    texts = X.dedupe_items(X.with_hashes(X.classify_items(raw).filter("valid")))
    news = texts.join(changed, X.ITEM).withColumns({
        "change": F.when(F.col("known_hash").isNull(), F.lit("new")).otherwise("changed"),
        "category": F.lit("news") if category is None else category,
    })
    fresh = items.filter(F.col("feed_item_id").isNotNull()).join(
        published.select(*X.FEED, F.lit(True).alias("_new")), X.FEED, "left"
    ).withColumn("record_hash", F.when(F.col("_new"), F.col("record_hash")))
    merged = fresh.filter(F.coalesce("record_hash", "known_hash").isNotNull()).select(
        *X.ITEM, F.coalesce("record_hash", "known_hash").alias("record_hash"),
        F.col("known_hash").isNull().alias("is_new"), "pos",
    )
    state = X.retain_items(merged, keep)
    old = [c for c in ("content_hash", "observed_at", "events_published", "etag", "last_modified",
                       "payload_uri") if c in checkpoints.columns]
    # Only an accepted poll brings new validators: a rejected, empty or 304 answer, or
    # no answer at all, leaves those of the content that was last accepted.
    accepted = outcomes.filter(F.col("status").isin("published", "unchanged")).select(*X.FEED)
    marks = responses.join(accepted, X.FEED, "left_semi").select(
        *X.FEED, F.col("etag").alias("_etag"), F.col("last_modified").alias("_last"),
        F.lit(True).alias("_fresh"),
    )
    kept = (
        checkpoints.join(published, X.FEED, "left_anti").select(*X.FEED, *old)
        .join(marks, X.FEED, "left")
        .withColumns({
            "etag": F.when(F.col("_fresh"), F.col("_etag")).otherwise(F.col("etag")),
            "last_modified": F.when(F.col("_fresh"), F.col("_last")).otherwise(F.col("last_modified")),
        })
        .drop("_etag", "_last", "_fresh")
    )
    written = (
        seen.select(*X.FEED, "content_hash", "observed_at",
                    F.lit(True).alias("events_published"), "payload_uri")
        .join(responses.select(*X.FEED, "etag", "last_modified"), X.FEED, "left")
    )
    return FeedScan(
        outcomes=outcomes,
        discovered=X.discovery_events(news),
        requests=X.fetch_requests(news),
        items=state,
        checkpoints=kept.unionByName(written, allowMissingColumns=True),
    )
