"""Feed change detection: item hashes, diffs, feed status, state and events.

A feed is keyed by (source_id, feed_id). No step gathers a whole feed in one
place: counts and hashes are combined before the shuffle, and joins run on the
item key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from presswork.functions import ids
from presswork.functions.text import iso_micros
from presswork.functions.urls import ascii_host, norm_url, url_host, url_part, url_verdict
from presswork.operators.ordering import first_per_key
from presswork.operators.settle import settle
from presswork.sources.rss import item_valid

FEED = ["source_id", "feed_id"]
ITEM = [*FEED, "feed_item_id"]
# The fixed number of items that a bounded checkpoint remembers.
MAX_REMEMBERED = 1000


def classify_items(raw: DataFrame) -> DataFrame:
    """raw items with ``valid`` and the normalised ``article_url`` of valid ones."""
    valid = item_valid(F.col("title"), F.col("link"))
    return settle(raw, valid=valid, article_url=F.when(valid, norm_url(F.col("link"))))


def dedupe_items(classified: DataFrame) -> DataFrame:
    """First valid item per normalised URL, in document order."""
    return first_per_key(classified.filter("valid"), [*FEED, "article_url"], ["pos"])


def item_counts(classified: DataFrame) -> DataFrame:
    """parsed, skipped and duplicate items per feed."""
    per_url = classified.groupBy(*FEED, "article_url").agg(F.count(F.lit(1)).alias("n"))
    no_url = F.col("article_url").isNull()
    return per_url.groupBy(*FEED).agg(
        F.count("article_url").alias("parsed"),
        F.coalesce(F.sum(F.when(no_url, F.col("n"))), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(~no_url, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )


def off_domain_feeds(items: DataFrame, domains: DataFrame) -> DataFrame:
    """Feeds with an item outside their source's domain, and how many."""
    own = domains.withColumn("domain", ascii_host(F.lower("domain")))
    checked = items.withColumn("_host", url_host(F.col("article_url"))).join(own, "source_id", "left")
    plain = F.coalesce(F.col("_host"), F.lit("")).rlike(r"^[\x00-\x7f]*$")

    def count_off(rows, host):
        verdict = url_verdict(F.col("article_url"), F.array("domain"), host)
        return rows.filter(verdict.isNotNull()).groupBy(*FEED).agg(F.count(F.lit(1)).alias("off_domain"))

    # only hosts outside ASCII go through Python
    both = count_off(checked.filter(plain), F.col("_host")).unionByName(
        count_off(checked.filter(~plain).withColumn("_host", ascii_host(F.col("_host"))), F.col("_host"))
    )
    return both.groupBy(*FEED).agg(F.sum("off_domain").alias("off_domain"))


def all_or_nothing(items: DataFrame, domains: DataFrame) -> DataFrame:
    """Items of feeds that keep to their domain; one stray item drops its feed."""
    return items.join(off_domain_feeds(items, domains), FEED, "left_anti")


def with_hashes(items: DataFrame) -> DataFrame:
    """Items with their stable id and the hash of what readers see."""
    return settle(
        items,
        feed_item_id=ids.feed_item_id(F.col("source_id"), F.col("feed_id"), F.col("article_url")),
        record_hash=ids.record_hash(F.col("article_url"), F.col("title"), F.col("summary"),
                                    F.col("published_iso")),
    )


def semantic_hash(hashed: DataFrame) -> DataFrame:
    """Hash of a feed's set of (item, record hash), blind to item order.

    It covers the item count and the sums of the items' own digests, which combine
    before the shuffle; the same definition holds for feeds of any size.
    """
    sums = _digest_sums(F.col("feed_item_id"), F.col("record_hash"))
    totals = hashed.groupBy(*FEED).agg(
        F.count(F.lit(1)).alias("items"), *[c.alias(n) for n, c in sums.items()]
    )
    return totals.select(*FEED, "items", _digest_of(F.col("items").cast("string")).alias("content_hash"))


def diff_items(hashed: DataFrame, remembered: DataFrame) -> DataFrame:
    """Current items that are new or whose record hash changed.

    ``remembered``: source_id, feed_id, feed_item_id, record_hash.
    """
    before = remembered.select(*ITEM, F.col("record_hash").alias("known_hash"))
    return (
        hashed.join(before, ITEM, "left")
        .filter(~F.col("known_hash").eqNullSafe(F.col("record_hash")))
        .withColumn(
            "change", F.when(F.col("known_hash").isNull(), F.lit("new")).otherwise("changed")
        )
    )


def merge_items(remembered: DataFrame, hashed: DataFrame) -> DataFrame:
    """Union of remembered and current items, the current hash wins.

    ``is_new`` and ``pos`` tell where an item stands: known items keep their
    place, new ones follow in document order.
    """
    before = remembered.select(*ITEM, F.col("record_hash").alias("known_hash"))
    now = hashed.select(*ITEM, "record_hash", "pos")
    return before.join(now, ITEM, "full_outer").select(
        *ITEM,
        F.coalesce("record_hash", "known_hash").alias("record_hash"),
        F.col("known_hash").isNull().alias("is_new"),
        "pos",
    )


def retain_items(merged: DataFrame, keep: int | None = MAX_REMEMBERED) -> DataFrame:
    """The last ``keep`` items of each feed; None keeps them all.

    State is saved with sorted keys, so known items stand in id order, before
    the new ones in document order. The rank limit is applied before the
    shuffle as well, so a huge feed sends ``keep`` rows per partition.
    """
    if keep is None:
        return merged
    old_place = F.when(~F.col("is_new"), F.col("feed_item_id"))
    new_place = F.when(F.col("is_new"), F.col("pos"))
    back = Window.partitionBy(*FEED).orderBy(
        F.desc("is_new"), F.desc_nulls_last(new_place), F.desc_nulls_last(old_place)
    )
    return (
        merged.withColumn("_back", F.row_number().over(back))
        .filter(F.col("_back") <= keep)
        .drop("_back")
    )


def poll_items(raw: DataFrame, remembered: DataFrame) -> DataFrame:
    """One narrow row per item that a poll shows or earlier polls left, and one per feed
    for all its invalid items (null feed_item_id).

    raw rows of an item are counted (``n``) and its first one in document order gives
    record_hash, pos and ``origin`` (scheme and host); known_hash is what is remembered.
    Texts stay behind: only hashes travel.
    """
    hashed = with_hashes(classify_items(raw))
    url = F.col("article_url")
    origin = F.concat(F.coalesce(url_part(url, "scheme"), F.lit("")), F.lit("://"), F.coalesce(url_host(url), F.lit("")))
    narrow = hashed.select(
        *FEED, F.when(F.col("valid"), F.col("feed_item_id")).alias("feed_item_id"),
        F.when(F.col("valid"), F.struct("pos", "record_hash", origin.alias("origin"))).alias("_row"),
    )
    shown = narrow.groupBy(*ITEM).agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_row"))
    before = remembered.select(*ITEM, F.col("record_hash").alias("known_hash"))
    return shown.join(before, ITEM, "full_outer").select(*ITEM, "n", "_row.*", "known_hash")


def _digest_sums(feed_item_id: Column, record_hash: Column) -> dict[str, Column]:
    """Sums that a feed's semantic hash is made of, over its items."""
    digest = F.sha2(F.concat_ws(":", feed_item_id, record_hash), 256)
    return {
        f"_s{i}": F.sum(F.when(
            record_hash.isNotNull(), F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")))
        for i in range(4)
    }


def _digest_of(items: Column) -> Column:
    """The semantic hash from the item count and the digest sums."""
    return F.sha2(F.concat_ws(":", items, *[F.col(f"_s{i}").cast("string") for i in range(4)]), 256)


def poll_totals(items: DataFrame, domains: DataFrame) -> DataFrame:
    """Counts, semantic hash and off-domain items of every feed, of poll_items().

    Items are added up per feed and origin first, so domains are compared once per
    origin and only those outside ASCII go through Python.
    """
    changed = F.col("record_hash").isNotNull() & ~F.col("known_hash").eqNullSafe(F.col("record_hash"))
    valid = F.col("feed_item_id").isNotNull()
    sums = {
        "parsed": F.count("record_hash"),
        "skipped": F.coalesce(F.sum(F.when(~valid, F.col("n"))), F.lit(0)),
        "duplicates": F.coalesce(F.sum(F.when(valid, F.col("n") - 1)), F.lit(0)),
        "discovered": F.count_if(changed),
        **_digest_sums(F.col("feed_item_id"), F.col("record_hash")),
    }
    origins = items.groupBy(*FEED, "origin").agg(*[c.alias(n) for n, c in sums.items()])
    own = domains.withColumn("domain", ascii_host(F.lower("domain")))
    placed = origins.withColumn("_host", F.substring_index("origin", "://", -1)).join(own, "source_id", "left")
    plain = F.coalesce(F.col("_host"), F.lit("")).rlike(r"^[\x00-\x7f]*$")

    def judged(rows, host):
        verdict = url_verdict(F.concat("origin", F.lit("/")), F.array("domain"), host)
        off = F.when(F.col("origin").isNotNull() & verdict.isNotNull(), F.col("parsed")).otherwise(0)
        return rows.select(*FEED, *sums, off.alias("off_domain"))

    odd = placed.filter(~plain).withColumn("_host", ascii_host(F.col("_host")))
    both = judged(placed.filter(plain), F.col("_host")).unionByName(judged(odd, F.col("_host")))
    added = both.groupBy(*FEED).agg(*[F.sum(c).alias(c) for c in (*sums, "off_domain")])
    return added.select(
        *FEED, "parsed", "skipped", "duplicates", "discovered",
        F.nullif("off_domain", F.lit(0)).alias("off_domain"),
        F.when(F.col("parsed") > 0, _digest_of(F.col("parsed").cast("string"))).alias("content_hash"),
    )


def poll_outcomes(responses: DataFrame, totals: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Outcome of one poll per feed, all inputs one row per feed.

    not_modified: a 304 that a published checkpoint backs. unchanged: same
    content as the published checkpoint. rejected: an off-domain item. Anything
    else with valid items is published.
    """
    before = checkpoints.select(
        *FEED, F.col("content_hash").alias("known_hash"),
        F.coalesce("events_published", F.lit(False)).alias("events_published"),
    )
    is_304 = F.col("status_code") == 304
    published_before = F.coalesce("events_published", F.lit(False))
    status = (
        F.when(is_304 & published_before, F.lit("not_modified"))
        .when(is_304, F.lit("unbacked_304"))
        .when(F.coalesce("parsed", F.lit(0)) == 0, F.lit("no_valid_items"))
        .when(F.col("off_domain").isNotNull(), F.lit("rejected"))
        .when(published_before & (F.col("known_hash") == F.col("content_hash")), F.lit("unchanged"))
        .otherwise(F.lit("published"))
    )
    counted = F.col("status").isin("unchanged", "published")
    number = lambda c, when: F.when(when, F.coalesce(c, F.lit(0))).otherwise(0).cast("bigint")
    return (
        responses.select(*FEED, "status_code").join(totals, FEED, "left").join(before, FEED, "left")
        .withColumn("status", status)
        .select(
            *FEED, "status", "content_hash",
            number(F.col("parsed"), counted).alias("parsed"),
            number(F.col("discovered"), F.col("status") == "published").alias("discovered"),
            number(F.col("skipped"), counted).alias("skipped"),
            number(F.col("duplicates"), counted).alias("duplicates"),
        )
    )


def feed_status(
    responses: DataFrame, counts: DataFrame, hashes: DataFrame, changed: DataFrame,
    checkpoints: DataFrame, rejected: DataFrame,
) -> DataFrame:
    """poll_outcomes() from single results, all one row per feed but ``changed``."""
    discovered = changed.groupBy(*FEED).agg(F.count(F.lit(1)).alias("discovered"))
    totals = (
        counts.join(hashes.drop("items"), FEED, "full_outer").join(discovered, FEED, "full_outer")
        .join(rejected, FEED, "full_outer")
    )
    return poll_outcomes(responses, totals, checkpoints)


def conditional_request(feeds: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Validators to send: only those of a poll whose events were published."""
    usable = F.coalesce("events_published", F.lit(False))
    return feeds.select(*FEED).join(checkpoints, FEED, "left").select(
        *FEED,
        F.when(usable, F.nullif("etag", F.lit(""))).alias("if_none_match"),
        F.when(usable, F.nullif("last_modified", F.lit(""))).alias("if_modified_since"),
    )


def run_id(content_hash: Column) -> Column:
    return ids.stable_id("rss_run", F.col("source_id"), F.col("feed_id"), content_hash)


def discovery_events(changed: DataFrame) -> DataFrame:
    """feed_item_discovered rows of new and changed items.

    ``changed`` brings run_id, observed_at, category and payload_uri along.
    """
    at = iso_micros(F.col("observed_at"))
    return changed.select(
        F.lit("feed_item.discovered.v2").alias("schema_version"),
        ids.stable_id("event", "feed_item.discovered.v2", F.col("feed_item_id"),
                      F.col("record_hash")).alias("event_id"),
        at.alias("event_time"), "run_id", "source_id",
        F.to_date("observed_at").alias("ingest_date"),
        "feed_item_id", ids.article_id(F.col("article_url")).alias("article_id"),
        "feed_id", "category", "article_url", "title",
        F.nullif("summary", F.lit("")).alias("summary"),
        F.nullif("published_iso", F.lit("")).alias("published_at"),
        at.alias("discovered_at"), "payload_uri", "record_hash",
    )


def fetch_requests(changed: DataFrame) -> DataFrame:
    """article_fetch_requested rows; the revision is the item's record hash."""
    article = ids.article_id(F.col("article_url"))
    return changed.select(
        F.lit("article.fetch_requested.v3").alias("schema_version"),
        ids.stable_id("event", "article.fetch_requested.v3", article, F.col("record_hash"))
        .alias("event_id"),
        iso_micros(F.col("observed_at")).alias("event_time"),
        "run_id", "source_id", F.to_date("observed_at").alias("ingest_date"),
        article.alias("article_id"), F.col("article_url").alias("requested_url"),
        F.col("record_hash").alias("request_revision"),
    )


def observed_at(hashes: DataFrame, checkpoints: DataFrame, now: Column) -> DataFrame:
    """Per feed the time its events carry: a repeated, not yet published content
    keeps the time of its first sighting, so its events come out equal."""
    before = checkpoints.select(
        *FEED, F.col("content_hash").alias("known_hash"), F.col("observed_at").alias("known_at")
    )
    return hashes.join(before, FEED, "left").select(
        *FEED, "content_hash", run_id(F.col("content_hash")).alias("run_id"),
        F.when(F.col("known_hash") == F.col("content_hash"), F.col("known_at"))
        .otherwise(now).alias("observed_at"),
    )


def run_rollup(polls: DataFrame) -> DataFrame:
    """Feeds of a source that succeeded, failed and failed fatally, and the
    run's outcome. ``polls``: source_id, failed, retryable, untyped."""
    fatal = F.col("failed") & (F.col("untyped") | F.col("retryable"))
    return polls.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("feed_count"),
        F.count_if(~F.col("failed")).alias("successful"),
        F.count_if(F.col("failed")).alias("failed"),
        F.count_if(fatal).alias("fatal"),
    ).withColumn(
        "outcome",
        F.when(
            (F.col("fatal") > 0) | ((F.col("failed") > 0) & (F.col("successful") == 0)),
            F.lit("failed"),
        ).otherwise("success"),
    )
