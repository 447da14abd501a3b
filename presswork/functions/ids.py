"""Content hashes and stable ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_SEPARATOR = "\x1f"
ID_HEX_CHARS = 32


def stable_id(prefix: str, *parts: Column | str) -> Column:
    """Same parts, same id: prefix + leading hex of a sha256 over the parts.

    Plain strings are literals. Nulls hash as '' so that a missing part keeps
    its place.
    """
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    joined = F.concat_ws(ID_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.concat(F.lit(prefix + "_"), F.left(F.sha2(joined, 256), F.lit(ID_HEX_CHARS)))


def content_sha256(payload: Column) -> Column:
    return F.sha2(payload, 256)


def feed_item_id(source_id: Column, feed_id: Column, url: Column) -> Column:
    return stable_id("feed_item", source_id, feed_id, url)


def article_id(url: Column) -> Column:
    return stable_id("article", url)


def record_hash(url: Column, title: Column, summary: Column, published_iso: Column) -> Column:
    """Changes whenever anything a reader sees of a feed item changes."""
    return stable_id("record", url, title, summary, published_iso)
