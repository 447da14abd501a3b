"""Queries of the landing and fetch path."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.functions import errors, ids, urls
from presswork.operators import fetching, screening
from presswork.sources import carriers as C
from presswork.sources import landing
from presswork.sources.tables import table


def now():
    return F.lit("2024-02-01").cast("timestamp")


def sites(spark):
    """Configuration of the three page sites."""
    return spark.createDataFrame(
        [
            ("example.com", True, "example.com", ["example.net"], [428], ["casino", " "]),
            ("example.net", True, "example.net", [], [], ["<h1>Is "]),
            ("example.org", False, "sub.example.org", ["example.com"], [403], []),
        ],
        "source_id string, enabled boolean, domain string, redirect_domains array<string>, "
        "blocked_status_codes array<int>, invalid_document_markers array<string>",
    )


def responses(spark, folder):
    """Landed pages as answers to fetch requests."""
    pages = C.landed_pages(spark, folder)
    return pages.select(
        "page_id", F.lit("run").alias("run_id"), "source_id", "ingest_date",
        ids.article_id(F.col("requested_url")).alias("article_id"), "requested_url",
        "request_revision", F.lit(200).alias("status_code"), "content_type", "payload",
    )


def fetched(spark, folder):
    return fetching.fetched_events(responses(spark, folder), now())


def url_allowlist(spark, folder):
    pages = C.landed_pages(spark, folder).join(sites(spark), "source_id", "left")
    return screening.screen_urls(pages, "requested_url", F.array("domain")).select(
        "page_id", "source_id", "verdict"
    )


def address_screen(spark, folder):
    screened = screening.address_screen(C.resolved_addresses(spark, folder))
    return screened.select(
        "host", "addresses", F.array_join("blocked", ",").alias("blocked"), "verdict", "retryable"
    )


def http_status_class(spark, folder):
    log = C.crawl_log(spark, folder).join(
        C.source_dimension(spark, folder).select("source_id", "blocked_status_codes"),
        "source_id", "left",
    )
    return log.select(
        "event_id", "status",
        errors.status_class(F.col("status"), F.col("blocked_status_codes")).alias("article_class"),
        errors.status_class(F.col("status"), feed=True).alias("feed_class"),
    )


def payload_size_limit(spark, folder):
    pages = C.landed_pages(spark, folder)
    declared = F.when(F.col("page_id") % 4 == 0, F.lit("chunked")).when(
        F.col("page_id") % 4 == 1, F.octet_length("payload").cast("string")
    )
    body = F.when(F.col("page_id") % 9 != 0, F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    return pages.select(
        "page_id", screening.size_verdict(declared, body, 4000).alias("verdict")
    )


def document_validity(spark, folder):
    pages = C.landed_pages(spark, folder).join(sites(spark), "source_id", "left")
    return pages.select(
        "page_id",
        screening.document_verdict(
            F.col("content_type"), F.col("payload"), F.col("invalid_document_markers")
        ).alias("verdict"),
    )


def fetch_success_gate(spark, folder):
    pages = C.landed_pages(spark, folder)
    uri = F.when(F.col("page_id") % 11 != 0, F.col("requested_url")).otherwise("")
    return pages.select("page_id", screening.fetch_gate(F.col("fetch_status"), uri).alias("verdict"))


def source_enrich(spark, folder):
    joined = screening.enrich_source(
        C.bus_events(spark, folder), C.source_dimension(spark, folder)
    )
    return joined.select("event_id", "source_id", "domain", "source_verdict")


def feed_select(spark, folder):
    wanted = C.crawl_log(spark, folder).select("source_id", "feed_id").distinct()
    return screening.select_feeds(wanted, C.source_dimension(spark, folder))


def redirect_chain(spark, folder):
    """Page p redirects to page p // 3; every fiftieth redirect lost its target."""
    def address(number):
        return F.concat(F.lit("https://"), number)

    pages = table(spark, folder, "pages").select(
        "page_id", F.concat(address(urls.url_host(F.col("url"))), F.lit("/p/"), "page_id").alias("url")
    )
    targets = pages.select(F.col("page_id").alias("to_id"), F.col("url").alias("location"))
    hops = pages.filter(F.col("page_id") > 0).withColumn(
        "to_id", F.floor(F.col("page_id") / 3)
    ).join(targets, "to_id").select(
        "url",
        F.when(F.col("page_id") % 50 != 49, F.col("location")).alias("location"),
    )
    starts = pages.select(
        "*",
        F.array(F.lit("example.com"), F.lit("example.net")).alias("domains"),
        F.array(F.lit("example.org")).alias("redirect_domains"),
    )
    ends = fetching.follow_redirects(starts, fetching.redirect_edges(hops))
    return ends.select("page_id", "final_url", "hops", "verdict", "retryable")


def _requests(spark, folder):
    return C.bus_events(spark, folder, "article_fetch_requested").select(
        "event_id", "article_id", F.concat(F.lit("rev"), F.col("k") % 2).alias("request_revision")
    )


def _completions(spark, folder):
    """Per article and revision the outcome of its first fetch."""
    pe = C.bus_events(spark, folder, "article_fetched")
    return pe.groupBy(
        "article_id", F.concat(F.lit("rev"), F.col("k") % 2).alias("request_revision")
    ).agg(F.concat(F.lit("doc_"), F.min("event_id")).alias("source_document_id"))


def fetch_already_done(spark, folder):
    return fetching.split_completed(_requests(spark, folder), _completions(spark, folder))


def fetch_new_work(spark, folder):
    return fetching.new_fetches(_requests(spark, folder), _completions(spark, folder))


def fetched_event_build(spark, folder):
    return fetched(spark, folder).withColumn("ingest_date", F.col("ingest_date").cast("string"))


def storage_layout(spark, folder):
    pages = responses(spark, folder)
    document = ids.stable_id("source_doc", F.col("article_id"), F.sha2("payload", 256))
    return pages.select(
        "page_id",
        landing.article_payload_uri(F.col("source_id"), F.col("ingest_date"), F.col("article_id"),
                                    document).alias("payload_uri"),
        landing.fetch_checkpoint_uri(F.col("article_id"), F.col("request_revision"))
        .alias("checkpoint_uri"),
        landing.feed_checkpoint_uri(F.col("source_id"), F.lit("main")).alias("feed_checkpoint_uri"),
    )


def landing_write_if_absent(spark, folder):
    """All pages against a landing table that holds those fetched by https."""
    incoming = fetched(spark, folder).select("payload_uri", "content_hash", "requested_url")
    landed = incoming.filter(F.col("requested_url").startswith("https"))
    again = incoming.unionByName(incoming)
    return landing.absent_payloads(again, landed).select("payload_uri", "content_hash")


def landing_read_verified(spark, folder):
    """What the pages' events claim against what lies in the landing table."""
    pages = C.landed_pages(spark, folder)
    uri = F.concat(F.lit("page/"), F.col("page_id"))
    stored = pages.filter(F.col("fetch_status") == "success").select(uri.alias("payload_uri"), "payload")
    asked = pages.select(uri.alias("payload_uri"), "content_hash")
    return landing.read_verified(asked, stored).select("payload_uri", "verdict")


QUERIES = {
    f.__name__: f
    for f in (
        url_allowlist, address_screen, http_status_class, payload_size_limit, document_validity,
        fetch_success_gate, source_enrich, feed_select, redirect_chain, fetch_already_done,
        fetch_new_work, fetched_event_build, storage_layout, landing_write_if_absent,
        landing_read_verified,
    )
}
