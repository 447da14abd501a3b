"""RSS payloads to item rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.binding import let
from presswork.functions.summary import summary_text
from presswork.functions.text import norm_text, rfc2822_datetime
from presswork.functions.urls import is_http_url, norm_url
from presswork.operators.settle import settle

_RSS = (
    "channel array<struct<item: array<struct<title: array<string>, link: array<string>,"
    " description: array<string>, pubDate: array<string>>>>>"
)
# Name of the root element, past declarations, comments and the doctype.
_END = r"(?s)(?:</rss\s*>|<rss[^>]*/>)\s*(?:<!--.*?-->\s*|<\?.*?\?>\s*)*$"
_ROOT = r"(?s)^\s*(?:\x{FEFF})?(?:<\?.*?\?>\s*|<!--.*?-->\s*|<![^>]*>\s*)*<([^\s/>]+)"


def item_valid(title: Column, link: Column) -> Column:
    """An item needs a title and a web link."""
    return (title != "") & is_http_url(link)


def first_in_array(entries: Column, key: str) -> Column:
    """First entry per key of an array<struct<pos, ...>>, back in pos order.

    Sorting keeps it n log n, where comparing every pair would not.
    """
    def keyed(e):
        return F.struct(e[key].alias("k"), e["pos"].alias("p"), e.alias("e"))

    def firsts(ordered):
        return F.filter(ordered, lambda x, i: (i == 0) | (x["k"] != F.get(ordered, i - 1)["k"]))

    chosen = let(F.sort_array(F.transform(entries, keyed)), firsts)
    by_pos = F.sort_array(F.transform(chosen, lambda x: F.struct(x["p"].alias("p"), x["e"].alias("e"))))
    return F.transform(by_pos, lambda x: x["e"])


def parse_feeds(payloads: DataFrame) -> DataFrame:
    """One row per feed payload with its verdict, counts and item array.

    ``payloads``: key columns plus ``payload`` text. Parsing, checks and
    first-wins dedupe all happen inside the row, so nothing is shuffled.
    """
    keys = [c for c in payloads.columns if c != "payload"]
    rss = F.when(
        (F.regexp_extract("payload", _ROOT, 1) == "rss") & F.col("payload").rlike(_END),
        F.from_xml("payload", _RSS),
    )
    # Settled, so that the XML is parsed once whatever reads it below.
    read = settle(payloads, keys, channel=rss["channel"])

    def entry(it, i):
        return F.struct(
            i.cast("bigint").alias("pos"),
            # a repeated child counts once: the first one
            norm_text(F.get(it["title"], F.lit(0))).alias("title"),
            norm_text(F.get(it["link"], F.lit(0))).alias("link"),
            F.get(it["description"], F.lit(0)).alias("description"),
            F.get(it["pubDate"], F.lit(0)).alias("pub_date"),
        )

    def checked(entries):
        linked = F.transform(
            F.filter(entries, lambda it: item_valid(it["title"], it["link"])),
            lambda it: it.withField("article_url", norm_url(it["link"])),
        )
        return let(linked, lambda valid: F.struct(
            F.size(valid).alias("linked"), first_in_array(valid, "article_url").alias("items")))

    items_of = F.transform("channel", lambda c: F.coalesce(c["item"], F.array()))
    found = F.coalesce(F.flatten(items_of), F.array())
    counted = settle(
        read, [*keys, "channel"], seen=F.size(found),
        checked=let(F.transform(found, entry), checked),
    )
    items, linked = F.col("checked.items"), F.col("checked.linked")
    return counted.select(
        *keys,
        F.when(F.col("channel").isNull(), F.lit("not_rss"))
        .when(F.size(items) == 0, F.lit("no_valid_items"))
        .alias("verdict"),
        F.size(items).alias("parsed"),
        (F.col("seen") - linked).alias("skipped"),
        (linked - F.size(items)).alias("duplicates"),
        items.alias("items"),
    )


def feed_item_rows(parsed: DataFrame) -> DataFrame:
    """Item rows of accepted feeds, summaries as text and dates read."""
    keys = [c for c in parsed.columns
            if c not in ("verdict", "parsed", "skipped", "duplicates", "items")]
    rows = parsed.filter(F.col("verdict").isNull()).select(*keys, F.inline("items"))
    published = rfc2822_datetime(F.col("pub_date"))
    return rows.select(
        *keys, "pos", "article_url", "title",
        summary_text(F.col("description")).alias("summary"),
        published["at"].alias("published_at"),
        published["iso"].alias("published_iso"),
    )
