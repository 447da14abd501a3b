"""Queries that put the scalar functions to work on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.functions import dims, errors, frames, ids, text, urls
from presswork.functions.summary import summary_text as summary_of
from presswork.operators.ordering import number_rows
from presswork.operators.settle import settle
from presswork.sources import carriers as C
from presswork.sources.tables import table


def norm_text(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", text.norm_text(F.concat(F.lit(" \t"), "text", F.lit("  \x1c"))).alias("norm")
    )


def summary_text(spark, folder):
    """Document lines wrapped in the markup of feed summaries."""
    escaped = F.replace(F.col("text"), F.lit("&"), F.lit("&amp;amp;"))
    markup = F.concat(
        F.lit('<a href="https://news.example.com/a"><img src="a.jpg"></a></br><p>'),
        F.replace(escaped, F.lit("\n"), F.lit("<br>")), F.lit("</p>"),
    )
    return table(spark, folder, "documents").select("doc_id", summary_of(markup).alias("summary"))


def norm_url(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.norm_url(F.col("url")).alias("url"))


def stable_id(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id",
        ids.article_id(urls.norm_url(F.col("url"))).alias("article_id"),
        ids.stable_id("event", "article.fetched.v2", F.col("page_id"),
                      F.lit(None).cast("string")).alias("event_id"),
    )


def record_hash(spark, folder):
    items = C.current_snapshot(spark, folder)
    return items.select(
        "source_id", "feed_id", "pos",
        ids.record_hash(F.col("article_url"), F.col("title"), F.nullif("summary", F.lit("")),
                        F.col("published_iso")).alias("record_hash"),
        ids.feed_item_id(F.col("source_id"), F.col("feed_id"), F.col("article_url"))
        .alias("feed_item_id"),
    )


def content_sha256(spark, folder):
    return C.landed_pages(spark, folder).select(
        "page_id", ids.content_sha256(F.col("payload")).alias("sha256")
    )


def _rfc2822_text(pe):
    """Event times in the date styles feeds use; one style is no date."""
    day = F.concat(F.dayofmonth("ts"), F.lit(" "), F.date_format("ts", "MMM yyyy"))
    clock = F.date_format("ts", "HH:mm:ss")
    k = F.col("k") % 6
    return (
        F.when(k == 0, F.concat(F.lit("Mon, "), day, F.lit(" "), clock, F.lit(" +0700")))
        .when(k == 1, F.concat(day, F.lit(" "), clock, F.lit(" GMT")))
        .when(k == 2, F.concat(F.lit("Tue, "), day, F.lit(" "), clock, F.lit(" EST")))
        .when(k == 3, F.concat(day, F.lit(" "), clock))
        .when(k == 4, F.concat(day, F.lit(" "), clock, F.lit(" -0330")))
        .otherwise(F.concat(F.lit("soon, "), clock))
    )


def rss_datetime(spark, folder):
    pe = C.bus_events(spark, folder)
    parsed = text.rfc2822_datetime(_rfc2822_text(pe))
    return pe.select(
        "event_id", text.iso_utc(parsed["at"]).alias("published_at"),
        parsed["iso"].alias("published_iso"),
    )


def article_datetime(spark, folder):
    pe = C.bus_events(spark, folder)
    iso = F.when(
        F.col("k") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+07:00'")
    ).when(F.col("k") % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(
        F.col("k") % 4 == 2, F.date_format("ts", "yyyy-MM-dd")
    ).otherwise(F.lit("yesterday"))
    found = text.article_datetime(F.lit(None).cast("string"), F.lit(""), iso, _rfc2822_text(pe))
    return pe.select("event_id", text.iso_utc(found).alias("published_at"))


def clean_title(spark, folder):
    tail = C.pick(F.col("doc_id"), " - Site", " | Site - News", "-Site", "")
    return table(spark, folder, "documents").select(
        "doc_id",
        text.clean_title(F.concat(F.split("text", "\n", 2)[0], tail)).alias("title"),
    )


def first_present(spark, folder):
    pe = C.bus_events(spark, folder)
    return pe.select(
        "event_id",
        text.first_present(
            F.when(F.col("k") % 3 == 0, F.col("article_id")).when(F.col("k") % 3 == 1, ""),
            F.when(F.col("k") % 2 == 0, F.col("source_id")),
            F.lit(""),
        ).alias("found"),
    )


def resolve_url(spark, folder):
    pages = table(spark, folder, "pages")
    candidate = C.pick(
        F.col("page_id"), "/a/b.html", "https://cdn.example.org/x.jpg", "//cdn.example.org/y.jpg",
        "mailto:desk@example.org", "next.html", "",
    )
    return pages.select(
        "page_id", urls.norm_url(urls.resolve_url(F.col("url"), candidate)).alias("resolved")
    )


def srcset_first(spark, folder):
    pages = table(spark, folder, "pages")
    value = F.when(
        F.col("page_id") % 3 == 0, F.concat(F.lit(" "), "url", F.lit(" 1x, "), "url", F.lit("2 2x"))
    ).when(F.col("page_id") % 3 == 1, F.col("url")).otherwise(F.lit(" , b.jpg 2x"))
    return pages.select("page_id", urls.srcset_first(value).alias("first_url"))


def clean_dimensions(spark, folder):
    pe = C.bus_events(spark, folder)
    raw = F.create_map(
        F.lit("source_id"), F.concat(F.lit(" "), "source_id", F.lit("\t")),
        F.lit("error_CLASS_name"), F.col("error_class"),
        F.lit(" plain "), F.repeat(F.lit("x"), F.col("k") + 100),
        F.lit("blank"), F.lit("  "),
        F.lit("missing"), F.lit(None).cast("string"),
    )
    return pe.select("event_id", dims.entries_json(dims.clean_dimensions(raw)).alias("dimensions"))


def retry_delay(spark, folder):
    """Attempts numbered per user in time order; the day is the parallel bucket."""
    log = C.crawl_log(spark, folder).withColumn("day", F.to_date("ts"))
    tried = number_rows(log, ["user_id"], ["day"], ["event_id"], "attempt")
    return tried.select(
        "event_id", "attempt",
        errors.http_retry_delay(F.col("attempt"), 1.5).alias("http_delay"),
        errors.consumer_retry_delay(F.col("attempt"), 2, 60).alias("consumer_delay"),
    )


def error_struct(spark, folder):
    log = C.crawl_log(spark, folder).withColumn("cls", errors.status_class(F.col("status")))
    failed = log.filter(F.col("cls") != "ok")
    record = errors.error_struct(
        C.pick(F.col("k"), "feed_fetch", "article_fetch", "payload_read", "event_decode"),
        F.lit("HTTPStatusError"),
        F.concat(F.lit("status "), "status"),
        F.when(F.col("k") % 4 < 2, F.col("cls") == "retryable"),
        F.when(F.col("k") % 4 < 2, F.col("status")),
        F.col("untyped"),
    )
    return failed.select("event_id", record.alias("error")).select("event_id", "error.*")


def base64_payload(spark, folder):
    framed = C.framed_events(spark, folder)
    return settle(framed, verdict=frames.frame_verdict(F.col("value"))).filter(
        F.col("verdict").isNotNull()
    ).select(
        "offset", "verdict",
        frames.base64_text(F.col("value")).alias("base64"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        norm_text, summary_text, norm_url, stable_id, record_hash, content_sha256, rss_datetime,
        article_datetime, clean_title, first_present, resolve_url, srcset_first, clean_dimensions,
        retry_delay, error_struct, base64_payload,
    )
}
