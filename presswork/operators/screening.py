"""Checks that decide whether a URL, an address, a response or an event may go on."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions import urls
from presswork.functions.text import strip

# IPv4 networks that are not globally reachable.
NON_GLOBAL_NETWORKS = (
    "0.0.0.0/8",
    "10.0.0.0/8",
    "100.64.0.0/10",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "172.16.0.0/12",
    "192.0.0.0/24",
    "192.0.2.0/24",
    "192.168.0.0/16",
    "198.18.0.0/15",
    "198.51.100.0/24",
    "203.0.113.0/24",
    "240.0.0.0/4",
)
# Exceptions inside them.
GLOBAL_EXCEPTIONS = ("192.0.0.9/32", "192.0.0.10/32")

# Texts of challenge and error pages that come with status 200.
INVALID_DOCUMENT_MARKERS = (
    "<title>just a moment",
    "checking your browser before accessing",
    "/cdn-cgi/challenge-platform/",
    "cf-chl-",
    "__jsl_clearance",
    "<title>access denied</title>",
    "<title>request rejected</title>",
    "<title>403 forbidden</title>",
    "<title>404 not found</title>",
    "<title>not found</title>",
)
# Media types of article pages.
HTML_TYPES = ("text/html", "application/xhtml+xml")
# Challenge markers are looked for in the head of a page only.
MARKER_WINDOW_BYTES = 65_536


def screen_urls(frame: DataFrame, url: str, domains: Column) -> DataFrame:
    """Adds ``host`` (IDNA form) and the allow-list ``verdict`` of a URL column."""
    hosts = frame.withColumn("host", urls.ascii_host(urls.url_host(F.col(url))))
    return hosts.withColumn("verdict", urls.url_verdict(F.col(url), domains, F.col("host")))


def ipv4_number(address: Column) -> Column:
    """Dotted IPv4 as a number, null for anything else."""
    octets = F.split(address, r"\.")
    number = F.aggregate(
        octets, F.lit(0).cast("bigint"), lambda acc, o: acc * 256 + o.cast("bigint")
    )
    return F.when(address.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?!$)|$)){4}$"), number)


def _within(number: Column, networks: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for text in networks:
        network = ipaddress.ip_network(text)
        hit = hit | number.between(int(network[0]), int(network[-1]))
    return hit


@F.pandas_udf(T.BooleanType())
def _ipv6_global(addresses: pd.Series) -> pd.Series:
    def check(address):
        try:
            return ipaddress.ip_address(address).is_global
        except ValueError:
            return False

    return addresses.map(check, na_action="ignore")


def is_global_address(address: Column, ipv6: bool = False) -> Column:
    """Globally reachable? IPv4 is plain range arithmetic; ``ipv6`` adds a Python
    stage for addresses with colons, which otherwise count as not global."""
    number = ipv4_number(address)
    v4 = ~_within(number, NON_GLOBAL_NETWORKS) | _within(number, GLOBAL_EXCEPTIONS)
    other = _ipv6_global(address) if ipv6 else F.lit(False)
    return F.when(number.isNotNull(), v4).otherwise(other)


def address_screen(resolved: DataFrame, ipv6: bool = False) -> DataFrame:
    """Verdict per host from its resolved addresses.

    ``resolved``: host, address (null when resolution gave nothing). A host
    without addresses may be retried; one non-public address blocks it for
    good, and all its non-public addresses are listed.
    """
    is_global = is_global_address(F.col("address"), ipv6)
    once = resolved.distinct()
    seen = once.groupBy("host").agg(
        F.count("address").alias("addresses"),
        F.sort_array(F.collect_set(F.when(~is_global, F.col("address")))).alias("blocked"),
    )
    verdict = (
        F.when(F.col("addresses") == 0, F.lit("no_addresses"))
        .when(F.size("blocked") > 0, F.lit("non_public"))
    )
    return seen.withColumn("verdict", verdict).withColumn(
        "retryable", F.coalesce(F.col("verdict") == "no_addresses", F.lit(False))
    )


def size_verdict(declared: Column, payload: Column, limit: int, empty_ok: bool = False) -> Column:
    """Too large by declaration or in fact; articles must not be empty either.

    A declared length that is no number is ignored.
    """
    check = F.when(declared.try_cast("bigint") > limit, F.lit("declared_too_large")).when(
        F.octet_length(payload) > limit, F.lit("too_large")
    )
    return check if empty_ok else check.when(F.octet_length(payload) == 0, F.lit("empty"))


def media_type(content_type: Column) -> Column:
    return F.lower(strip(F.substring_index(content_type, ";", 1)))


def document_marker(
    payload: Column, extra: Column | None = None, window: int | None = MARKER_WINDOW_BYTES
) -> Column:
    """First marker of a challenge or error page, in list order, else null.

    Looked for in the first ``window`` bytes, None for the whole payload. Markers of
    ``extra`` count as written, with the blanks around them; blank ones are left out.
    """
    head = payload if window is None else F.substring(payload, 1, window)
    sample = F.lower(head.cast("string"))
    marker = F.lit(None).cast("string")
    if extra is not None:
        named = F.filter(extra, lambda m: strip(m) != "")
        marker = F.get(F.filter(named, lambda m: sample.contains(F.lower(m))), F.lit(0))
    fixed = F.coalesce(*[F.when(sample.contains(m), F.lit(m)) for m in INVALID_DOCUMENT_MARKERS])
    return F.coalesce(fixed, marker)


def document_verdict(
    content_type: Column, payload: Column, extra: Column | None = None,
    window: int | None = MARKER_WINDOW_BYTES,
) -> Column:
    """Why a response is no article page; null when it may be one."""
    wrong_type = (F.coalesce(content_type, F.lit("")) != "") & ~media_type(content_type).isin(
        *HTML_TYPES
    )
    marker = document_marker(payload, extra, window)
    return F.when(wrong_type, F.concat(F.lit("not_html: "), content_type)).when(
        marker.isNotNull(), F.concat(F.lit("marker: "), marker)
    )


def fetch_gate(fetch_status: Column, payload_uri: Column) -> Column:
    """Only successful fetches with a payload can be extracted."""
    good = (fetch_status == "success") & (F.coalesce(payload_uri, F.lit("")) != "")
    return F.when(~F.coalesce(good, F.lit(False)), F.lit("not_fetched"))


def enrich_source(events: DataFrame, sources: DataFrame) -> DataFrame:
    """Events with their source's configuration and a verdict.

    The join strategy is left to Spark, which broadcasts the configuration
    only when its measured size is small.
    """
    known = sources.withColumn("_known", F.lit(True))
    return events.join(known, "source_id", "left").withColumn(
        "source_verdict",
        F.when(F.col("_known").isNull(), F.concat(F.lit("unknown source: "), "source_id"))
        .when(~F.col("enabled"), F.concat(F.lit("disabled source: "), "source_id")),
    ).drop("_known")


def select_feeds(wanted: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_id, feed_id) pairs with their feed configuration and a verdict."""
    feeds = sources.select("source_id", F.explode("feeds").alias("feed")).select(
        "source_id", "feed.feed_id", "feed.category", "feed.url"
    )
    return wanted.join(feeds, ["source_id", "feed_id"], "left").withColumn(
        "verdict",
        F.when(
            F.col("url").isNull(),
            F.concat(F.lit("unknown feed of "), "source_id", F.lit(": "), "feed_id"),
        ),
    )
