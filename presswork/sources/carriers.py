"""Views that give the driver tables the shape of news-ingestion records.

Every view keeps all rows of its table; numbers in the tables only decide
which *kind* of record a row becomes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions import text, urls
from presswork.functions.binding import literal_array, literal_map
from presswork.functions.frames import frame
from presswork.sources.tables import events, spread_table, table

TOPIC_BY_EVENT_TYPE = {
    "view": "article_fetched",
    "purchase": "article_extracted",
    "error": "dlq",
    "click": "pipeline_metric",
    "signup": "article_fetch_requested",
}


def pick(index: Column, *values: str) -> Column:
    """values[index] as a Column, cycling."""
    return F.element_at(literal_array(values), (index % len(values) + 1).cast("int"))


def bus_events(spark: SparkSession, folder: str, *topics: str) -> DataFrame:
    """events as records of the event bus, of some topics or of all.

    Topics are told apart by a plain column of the table, so choosing some is a
    filter the parquet scan applies.
    """
    rows = events(spark, folder)
    if topics:
        rows = rows.filter(
            F.col("event_type").isin([t for t, key in TOPIC_BY_EVENT_TYPE.items() if key in topics])
        )
    return as_bus_events(rows)


def as_bus_events(rows: DataFrame) -> DataFrame:
    """Batch or streaming rows of events as bus records."""
    topics = literal_map(TOPIC_BY_EVENT_TYPE.items())
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        k.alias("k"),
        topics[F.col("event_type")].alias("topic_key"),
        F.concat(F.lit("src"), F.col("user_id")).alias("source_id"),
        pick(k, "article_extract", "article_extract", "article_extract", "article_fetch",
             "event_decode").alias("stage"),
        pick(k, "ValueError", " KeyError ", "HttpFetchError", "TypeError").alias("error_class"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.concat(F.lit("article_"), F.col("user_id"), F.lit("_"), k % 10).alias("article_id"),
        pick(k, "fetcher", "extractor").alias("service"),
        pick(k, "consumer_retry_count", "article_fetch_retry_count", "other_count")
        .alias("metric_name"),
    )


def framed_events(spark: SparkSession, folder: str) -> DataFrame:
    """bus_events as framed bytes, some of them damaged in different ways."""
    return as_framed(bus_events(spark, folder))


def as_framed(pe: DataFrame) -> DataFrame:
    body = F.concat(
        F.lit('{"article_id":"'), F.col("article_id"), F.lit('","k":'), F.col("k"),
        F.lit(',"source_id":"'), F.col("source_id"), F.lit('"}'),
    )
    body = (
        F.when(F.col("event_id") % 79 == 0, F.lit("not-json"))
        .when(F.col("event_id") % 73 == 0, F.lit("[1]"))
        .otherwise(body)
    )
    good = frame(F.col("k") % 5, body)
    value = (
        F.when(F.col("event_id") % 89 == 0, F.lit(None).cast("binary"))
        .when(F.col("event_id") % 97 == 0, F.substring(good, 1, 3))
        .when(F.col("event_id") % 101 == 0, F.encode(body, "UTF-8"))
        .when(F.col("event_id") % 83 == 0, F.concat(good, F.unhex(F.lit("FF"))))
        .otherwise(good)
    )
    return pe.select(
        F.concat(F.lit("news."), F.col("topic_key")).alias("topic"),
        "partition", "offset", "ts", value.alias("value"),
    )


def feed_items(spark: SparkSession, folder: str) -> DataFrame:
    """documents as the items of one feed per (source, language)."""
    docs = spread_table(spark, folder, "documents").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    off_domain = (F.col("toxic") == 1) & (F.col("lang") == "de")
    return docs.select(
        F.col("source").alias("source_id"),
        F.col("lang").alias("feed_id"),
        F.col("doc_id").alias("pos"),
        F.concat(
            F.when(off_domain, F.lit("https://Evil.example/"))
            .otherwise(F.concat(F.lit("https://WWW."), F.col("source"), F.lit(".example.com/"))),
            F.col("lang"), F.lit("/"), F.col("doc_id"),
            F.lit("?utm_source=rss&ref="), F.col("lang"), F.lit("#top"),
        ).alias("link"),
        text.norm_text(F.split("text", "\n", 2)[0]).alias("title"),
        text.norm_text(F.col("text")).alias("summary"),
        text.iso_utc(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60))
        .alias("published_iso"),
        F.col("quality"),
    )


def current_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return feed_items(spark, folder).drop("quality").withColumn(
        "article_url", urls.norm_url(F.col("link"))
    )


UNCHANGED_SOURCES = ("src5", "src6")


def previous_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier poll saw: labelled documents (poor ones under an old
    title) and the benchmark items, which are gone by now. Two sources have not
    changed since."""
    same = F.col("source_id").isin(*UNCHANGED_SOURCES)
    seen = (
        feed_items(spark, folder)
        .filter(F.col("quality").isNotNull() | same)
        .withColumn(
            "title",
            F.when((F.col("quality") == 0) & ~same, F.concat("title", F.lit(" (old)")))
            .otherwise(F.col("title")),
        )
        .drop("quality")
    )
    gone = table(spark, folder, "benchmark").select(
        F.lit("src0").alias("source_id"),
        F.lit("en").alias("feed_id"),
        F.col("item_id").alias("pos"),
        F.concat(F.lit("https://www.src0.example.com/gone/"), F.col("item_id")).alias("link"),
        text.norm_text(F.col("text")).alias("title"),
        F.lit("").alias("summary"),
        F.lit("").alias("published_iso"),
    )
    return seen.unionByName(gone).withColumn("article_url", urls.norm_url(F.col("link")))


def raw_feed_items(spark: SparkSession, folder: str) -> DataFrame:
    """The current poll before any cleaning: labelled documents come twice (once
    under a tracking link) and conversations are items without a link."""
    cur = current_snapshot(spark, folder).drop("article_url")
    again = cur.join(table(spark, folder, "labels").select(F.col("doc_id").alias("pos")), "pos",
                     "left_semi").select(
        "source_id", "feed_id", (F.col("pos") + 10**12).alias("pos"),
        F.concat(F.split("link", "#")[0], F.lit("&utm_medium=again")).alias("link"),
        F.concat(F.lit("again "), "title").alias("title"), "summary", "published_iso",
    )
    unlinked = table(spark, folder, "conversations").select(
        F.lit("src1").alias("source_id"), F.lit("en").alias("feed_id"),
        (F.col("conv_id") * 1000 + F.col("turn") + 2 * 10**12).alias("pos"),
        F.lit("").alias("link"), text.norm_text(F.col("text")).alias("title"),
        F.lit("").alias("summary"), F.lit("").alias("published_iso"),
    )
    return cur.unionByName(again).unionByName(unlinked)


def feed_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One poll result per feed: status code and validators."""
    feeds = table(spark, folder, "documents").select(
        F.col("source").alias("source_id"), F.col("lang").alias("feed_id")
    ).distinct()
    return feeds.select(
        "source_id", "feed_id",
        F.when(F.col("source_id").isin("src3", "src4"), 304).otherwise(200).alias("status_code"),
        F.concat(F.lit("etag-"), "source_id").alias("etag"),
        F.lit("Mon, 01 Jan 2024 00:00:00 GMT").alias("last_modified"),
    )


def feed_validators(spark: SparkSession, folder: str) -> DataFrame:
    """What the last poll of each feed left behind besides its item hashes:
    French feeds were stored but never published, English ones have no etag and
    src9 was never polled."""
    feeds = table(spark, folder, "documents").select(
        F.col("source").alias("source_id"), F.col("lang").alias("feed_id")
    ).distinct()
    return feeds.filter(F.col("source_id") != "src9").select(
        "source_id", "feed_id",
        (F.col("feed_id") != "fr").alias("events_published"),
        F.when(F.col("feed_id") != "en", F.lit("etag-old")).alias("etag"),
        F.lit("Sun, 31 Dec 2023 00:00:00 GMT").alias("last_modified"),
        F.lit("2023-12-31").cast("timestamp").alias("observed_at"),
    )


def feed_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One RSS payload per document; its lines are the feed's items.

    Lines below 20 characters carry no link, repeated lines repeat their link,
    and a one-line document stands for a page that is no feed at all.
    """

    def escaped(value):
        for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            value = F.replace(value, F.lit(raw), F.lit(entity))
        return value

    lines = F.split("text", "\n")
    items = F.transform(
        lines,
        lambda line: F.concat(
            F.lit("<item><title>"), escaped(line), F.lit("</title>"),
            F.when(
                F.char_length(line) >= 20,
                F.concat(F.lit("<link>https://news.example.com/"), F.md5(line),
                         F.lit("?utm_medium=rss</link>")),
            ).otherwise(""),
            F.lit("<pubDate>Mon, 01 Jan 2024 05:00:00 +0700</pubDate></item>"),
        ),
    )
    rss = F.concat(F.lit('<rss version="2.0"><channel>'), F.array_join(items, ""),
                   F.lit("</channel></rss>"))
    return spread_table(spark, folder, "documents").select(
        F.col("source").alias("source_id"),
        F.col("doc_id").alias("feed_id"),
        F.when(F.size(lines) == 1, F.lit("<html><body>Blocked</body></html>"))
        .otherwise(rss).alias("payload"),
    )


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """pages as fetched responses; the claimed hash of every tenth is wrong."""
    html = F.encode("html", "UTF-8")
    claimed = F.when(F.col("page_id") % 10 == 0, F.concat(html, F.encode(F.lit("x"), "UTF-8")))
    return spread_table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract(urls.url_host(F.col("url")), r"(example\.[a-z]+)$", 1).alias("source_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int"))
        .alias("ingest_date"),
        urls.norm_url(F.col("url")).alias("requested_url"),
        F.concat(F.lit("rev"), F.col("page_id") % 3).alias("request_revision"),
        html.alias("payload"),
        F.sha2(F.coalesce(claimed, html), 256).alias("content_hash"),
        F.when(F.col("page_id") % 7 == 0, F.lit("failed")).otherwise("success")
        .alias("fetch_status"),
        pick(F.col("page_id"), "text/html; charset=utf-8", " TEXT/HTML ", "application/xhtml+xml",
             "application/json", "").alias("content_type"),
    )


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """documents exploded to lines with their position."""
    return spread_table(spark, folder, "documents").select(
        "doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )


def crawl_log(spark: SparkSession, folder: str) -> DataFrame:
    """bus_events as responses of feed and article requests."""
    return as_crawl_log(bus_events(spark, folder))


def as_crawl_log(pe: DataFrame) -> DataFrame:
    status = F.element_at(
        literal_array((200, 200, 200, 304, 404, 408, 425, 428, 429, 500, 503)),
        (F.col("k") % 11 + 1).cast("int"),
    )
    return pe.select(
        "event_id", "ts", "user_id", "source_id", "k", status.alias("status"),
        F.concat(F.lit("feed"), F.col("k") % 4).alias("feed_id"),
        (F.col("k") % 17 == 0).alias("untyped"),
    )


def source_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """One configuration row per user with an early sign-up; some are switched
    off, and users without such a sign-up have none."""
    users = (
        table(spark, folder, "events")
        .filter(
            (F.col("event_type") == "signup")
            & (F.get_json_object("props", "$.k").cast("int") < 10)
        )
        .select("user_id")
        .distinct()
    )
    feed = lambda name: F.struct(
        F.lit(name).alias("feed_id"), F.lit("news").alias("category"),
        F.concat(F.lit("https://www.src"), F.col("user_id"), F.lit(f".example.com/{name}.rss"))
        .alias("url"),
    )
    return users.select(
        F.concat(F.lit("src"), F.col("user_id")).alias("source_id"),
        (F.col("user_id") % 7 != 0).alias("enabled"),
        F.concat(F.lit("src"), F.col("user_id"), F.lit(".example.com")).alias("domain"),
        F.when(F.col("user_id") % 2 == 0, F.array(F.lit(428), F.lit(404)))
        .otherwise(F.array(F.lit(428))).alias("blocked_status_codes"),
        F.array(feed("feed0"), feed("feed1"), feed("feed2")).alias("feeds"),
    )


def committed_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Offsets that consumer groups had committed by 25 January."""
    e = bus_events(spark, folder)
    seen = e.groupBy(
        F.concat(F.lit("group"), F.col("user_id") % 5).alias("group_id"),
        F.concat(F.lit("news."), F.col("topic_key")).alias("topic"),
        "partition",
    ).agg(
        F.max(F.when(F.col("ts") < F.lit("2024-01-25").cast("timestamp"), F.col("offset")))
        .alias("committed")
    )
    return seen.withColumn(
        "committed",
        F.when((F.col("group_id") == "group3") & (F.col("partition") == 1), F.lit(-1))
        .otherwise(F.col("committed")).cast("bigint"),
    )


def latest_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return (
        bus_events(spark, folder)
        .groupBy(F.concat(F.lit("news."), F.col("topic_key")).alias("topic"), "partition")
        .agg((F.max("offset") + 1).alias("latest"))
    )


def resolved_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """events as name-resolution answers, public and not; some empty."""
    e = bus_events(spark, folder)
    last = F.col("event_id") % 250 + 1
    network = F.element_at(
        F.array(*[F.lit(x) for x in (
            "8.8.4.", "10.1.2.", "127.0.0.", "192.168.7.", "172.20.1.", "93.184.216.",
            "100.64.3.", "169.254.9.", "203.0.113.", "1.1.1.", "151.101.1.")]),
        (F.col("k") % 11 + 1).cast("int"),
    )
    return e.select(
        F.concat(F.lit("host"), F.col("user_id"), F.lit("-"), F.col("k") % 10,
                 F.lit(".example.com")).alias("host"),
        F.when(F.col("k") % 13 != 0, F.concat(network, last)).alias("address"),
    )
