"""Articles out of HTML: metadata, text blocks, images and captions.

One page is one row from start to end: Python walks the markup and picks blocks, images
and possible captions out of the tree in linear time, array expressions judge their
texts and addresses, and nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from presswork.functions import text as tx
from presswork.functions import urls
from presswork.functions.binding import let
from presswork.functions.dom import Tree
from presswork.functions.selectors import Selectors, compiled, text_list
from presswork.operators.settle import settle
from presswork.sources.rss import first_in_array

EXTRACTOR_VERSION = "html_article_blocks_v1"

# Where article text lives when a source says nothing else.
CONTENT_SELECTORS = (
    "article",
    ".fck_detail",
    ".detail-content",
    ".afcbc-body",
    "#ContentDetail",
    "#mainContent",
    "#desktop-in-article",
    ".article__body",
    ".ct-edtior-web",
)
# Parts of a page that are never article text.
EXCLUDE_SELECTORS = (
    "script",
    "style",
    "noscript",
    "iframe",
    "form",
    "button",
    "nav",
    "header",
    "footer",
    "aside",
    ".ads",
    ".ads_detail",
    ".banner",
    ".social",
    ".social-wrapper",
    ".detail-social",
    ".article__social",
    ".related-news",
    ".article-relate",
    ".relationnews",
    ".kbwscwlrl",
    ".kbwscwlrl-content",
    ".link-source-detail",
    ".google-news",
    ".gg-news",
    ".tagdetail",
    ".detail-tag",
)
# Inline links whose text belongs to the sentence around them.
UNWRAP_SELECTORS = ("a.link-inline-content", "a.seo-suggest-link")
# Block elements, media elements, caption places, image sources.
BLOCK_TAGS = ("p", "h2", "h3", "li", "blockquote", "figcaption")
BLOCK_KINDS = {"h2": "heading", "h3": "heading", "li": "list_item", "blockquote": "quote"}
MEDIA_TAGS = ("img", "picture", "video", "iframe")
CAPTION_SELECTORS = (
    "figcaption",
    ".PhotoCMS_Caption",
    ".caption",
    ".image_desc",
    ".figcaption",
    ".detail__caption",
    ".expEdit",
    ".cms-desc",
)
CONTEXT_MARKERS = ("image", "photo", "picture", "caption", "sortable")
IMAGE_SOURCES = (
    "data-src",
    "data-original",
    "data-original-src",
    "data-lazy-src",
    "data-zoom-src",
    "data-thumb",
    "src",
    "data-srcset",
    "srcset",
)
MAX_CONTEXTS = 4
#: Pages whose findings a worker holds as Python objects.
PAGES_AT_ONCE = 64

CONFIG_FIELDS = (
    "content_selectors", "exclude_selectors", "unwrap_selectors", "boilerplate_markers",
    "min_text_chars", "min_blocks",
)


def compile_config(sources: DataFrame) -> DataFrame:
    """Source configuration with an ``extraction`` struct ready for pages.

    ``sources`` may lack any of CONFIG_FIELDS, and any of them may be null.
    """
    def given(name, kind):
        return F.col(name) if name in sources.columns else F.lit(None).cast(kind)

    lists = "array<string>"
    markers = text_list(given("boilerplate_markers", lists))
    extraction = F.struct(
        compiled(given("content_selectors", lists)).alias("content"),
        compiled(given("exclude_selectors", lists)).alias("exclude"),
        compiled(given("unwrap_selectors", lists)).alias("unwrap"),
        F.transform(markers, F.lower).alias("markers"),
        F.coalesce(given("min_text_chars", "int"), F.lit(80)).alias("min_text_chars"),
        F.coalesce(given("min_blocks", "int"), F.lit(1)).alias("min_blocks"),
    )
    rest = [c for c in sources.columns if c not in CONFIG_FIELDS]
    return sources.select(*rest, extraction.alias("extraction"))


# --- what the tree decides ----------------------------------------------------

_TEXT, _INT = T.StringType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_HEAD = _struct(
    title=_TEXT, metas=T.ArrayType(_struct(property=_TEXT, name=_TEXT, content=_TEXT)),
    links=T.ArrayType(_struct(rel=_TEXT, href=_TEXT)),
)
_CONTENT = _struct(
    head=_HEAD, blocks=T.ArrayType(_struct(type=_TEXT, text=_TEXT)),
    images=T.ArrayType(_struct(sources=T.ArrayType(_TEXT), alt=_TEXT, tries=T.ArrayType(_INT))),
    captions=T.ArrayType(_TEXT),
)
_PICTURES = T.StructType([f for f in _CONTENT if f.name in ("images", "captions")])
_HOMES = T.ArrayType(_struct(place=_INT, tag=_TEXT, text=_TEXT))
_SHOWN = _struct(removed_nodes=_INT, remaining=_TEXT)


class _Page:
    """A page's tree and what selectors make of it: elements that are cut, and where
    its content lies."""

    def __init__(self, tree: Tree, rules: _Rules) -> None:
        self.tree = tree
        element = list(zip(tree.tags, tree.ids, tree.classes, tree.attrs))
        # loose elements around plain text are unwrapped: their text stays, they do not
        holds_media = tree.holding([tag in MEDIA_TAGS for tag in tree.tags])
        self.gone = [rules.is_loose(*e) and not media for e, media in zip(element, holds_media)]
        unwanted = [not gone and rules.is_unwanted(*e) for e, gone in zip(element, self.gone)]
        self.cuts = tree.outermost(unwanted, 0, len(unwanted) - 1)
        cut = tree.within(unwanted)
        self.alive = [not c and not gone for c, gone in zip(cut, self.gone)]
        self.places = [rules.place(*e) if alive else None for e, alive in zip(element, self.alive)]
        tree.blank(self.cuts)
        self.named = [" ".join(c).lower() for c in tree.classes]

    def homes(self) -> list[tuple[int, int]]:
        """(place, element) of the content, by place. An element goes when one around it
        came no later; the body stands in when nothing matches."""
        never, least, found = float("inf"), [], []
        for n, (parent, place) in enumerate(zip(self.tree.parents, self.places)):
            least.append(never if parent < 0 else min(least[parent], self.places[parent] or never))
            if place is not None and least[n] > place:
                found.append((place, n))
        if found:
            return sorted(found)
        return [(0, n) for n, tag in enumerate(self.tree.tags) if tag == "body" and self.alive[n]][:1]

    def blocks(self, homes: list[tuple[int, int]]) -> list[dict]:
        """Outermost block elements of each home, white space of their texts as norm_text() leaves it."""
        tree = self.tree
        wanted = [tag in BLOCK_TAGS and alive for tag, alive in zip(tree.tags, self.alive)]
        in_caption = tree.within(["caption" in c and not gone for c, gone in zip(self.named, self.gone)])

        def kind(n):
            tag = tree.tags[n]
            if tag in BLOCK_KINDS:
                return BLOCK_KINDS[tag]
            return "caption" if tag == "figcaption" or in_caption[n] else "paragraph"

        return [
            {"type": kind(n), "text": " ".join(tree.text(n).split())}
            for _, home in homes for n in tree.outermost(wanted, home + 1, tree.ends[home])
        ]

    def images(self, homes: list[tuple[int, int]]) -> tuple[list[dict], list[str]]:
        """Images of each home with the captions to try for them, best first, as places
        in a list of texts: for each of the nearest contexts its caption places in
        order, then all of it."""
        tree = self.tree
        images = [n for n, tag in enumerate(tree.tags) if tag == "img" and self.alive[n]]
        if not images:
            return [], []
        context = tree.around([
            not gone and (tag == "figure" or any(m in named for m in CONTEXT_MARKERS))
            for tag, named, gone in zip(tree.tags, self.named, self.gone)
        ])
        spot_like = [
            (n, e) for n, e in enumerate(zip(tree.tags, tree.ids, tree.classes, tree.attrs))
            if self.alive[n] and _ANY_CAPTION.first(*e)
        ]
        spots = [[n for n, e in spot_like if selector.first(*e)] for selector in _CAPTIONS]
        texts, known, of_context = [], {}, {}

        def number(n):
            if n not in known:
                known[n] = len(texts)
                texts.append(tree.text(n))
            return known[n]

        def tries(n):
            if n not in of_context:
                inside = [spot[at] for spot in spots if (at := bisect_right(spot, n)) < len(spot) and spot[at] <= tree.ends[n]]
                of_context[n] = [number(x) for x in [*inside, n]]
            return of_context[n]

        out = []
        for _, home in homes:
            for n in images[bisect_right(images, home) : bisect_right(images, tree.ends[home])]:
                attrs, near, found = tree.attrs[n], context[n], []
                for _ in range(MAX_CONTEXTS):
                    if near >= 0:
                        found += tries(near)
                        near = context[near]
                out.append({"sources": [attrs.get(a, "") for a in IMAGE_SOURCES], "alt": attrs.get("alt"), "tries": found})
        return out, texts


def _head(tree: Tree) -> dict:
    """What metadata is read from."""
    at = {tag: [n for n, t in enumerate(tree.tags) if t == tag] for tag in ("title", "meta", "link")}
    take = lambda n, *keys: {k: tree.attrs[n].get(k) for k in keys}
    return {
        "title": tree.text(at["title"][0]) if at["title"] else None,
        "metas": [take(n, "property", "name", "content") for n in at["meta"]],
        "links": [take(n, "rel", "href") for n in at["link"]],
    }


class _Rules:
    """The fixed selectors with those of one source."""

    def __init__(self, settings: dict | None) -> None:
        own = {k: Selectors.configured((settings or {}).get(k)) for k in ("content", "exclude", "unwrap")}
        self.place = (own["content"] if (settings or {}).get("content") else _CONTENTS).first
        self.is_unwanted = lambda *e: bool(_EXCLUDES.first(*e) or own["exclude"].first(*e))
        self.is_loose = lambda *e: bool(_UNWRAPS.first(*e) or own["unwrap"].first(*e))


_CONTENTS, _EXCLUDES = Selectors.fixed(CONTENT_SELECTORS), Selectors.fixed(EXCLUDE_SELECTORS)
_UNWRAPS = Selectors.fixed(UNWRAP_SELECTORS)
_ANY_CAPTION, _CAPTIONS = Selectors.fixed(CAPTION_SELECTORS), [Selectors.fixed((s,)) for s in CAPTION_SELECTORS]


def _content(payload: bytes | None, rules: _Rules) -> dict:
    tree = Tree(payload)
    head = _head(tree)  # of the whole page, before anything is cut
    page = _Page(tree, rules)
    homes = page.homes()
    images, captions = page.images(homes)
    return {"head": head, "blocks": page.blocks(homes), "images": images, "captions": captions}


def _pictures(payload: bytes | None, rules: _Rules) -> dict:
    page = _Page(Tree(payload), rules)
    images, captions = page.images(page.homes())
    return {"images": images, "captions": captions}


def _homes(payload: bytes | None, rules: _Rules) -> list[dict]:
    page = _Page(Tree(payload), rules)
    return [{"place": place, "tag": page.tree.tags[n], "text": page.tree.text(n)} for place, n in page.homes()]


def _shown(payload: bytes | None, rules: _Rules) -> dict:
    page = _Page(Tree(payload), rules)
    return {"removed_nodes": len(page.cuts), "remaining": " ".join(filter(None, page.tree.texts))}


def _of_pages(make, kind: T.DataType):
    """Column function (payload, extraction settings) of what ``make`` finds in a page."""
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def found(payloads: pa.Array, settings: pa.Array) -> pa.Array:
        rules, done = {}, [pa.array([], arrow)]
        # Python objects take many times the room of what Arrow holds: few pages at a time
        for at in range(0, len(payloads), PAGES_AT_ONCE):
            rows, some = [], slice(at, at + PAGES_AT_ONCE)
            for payload, own in zip(payloads[some].to_pylist(), settings[some].to_pylist()):
                key = repr(own)
                if key not in rules:
                    rules[key] = _Rules(own)
                rows.append(make(payload, rules[key]))
            done.append(pa.array(rows, arrow))
        return pa.concat_arrays(done)

    own = ("content", "exclude", "unwrap")
    return lambda payload, cfg: found(payload, F.struct(*[cfg[f].alias(f) for f in own]))


# --- metadata ----------------------------------------------------------------


def _meta(metas: Column, key: str) -> Column:
    """Content of the first meta with this key, '' included; null if none."""
    return F.get(F.filter(metas, lambda m: m["key"] == key), F.lit(0))["content"]


def page_metadata(head: Column) -> Column:
    """title, summary, author, dates and canonical candidate of a page."""
    metas = F.transform(
        head["metas"],
        lambda x: F.struct(
            F.lower(tx.first_present(x["property"], x["name"])).alias("key"),
            tx.norm_text(x["content"]).alias("content"),
        ),
    )
    title = tx.norm_text(head["title"])
    canonical = F.filter(
        head["links"],
        lambda x: F.array_contains(F.split(F.lower(x["rel"]), r"\s+"), "canonical") & (x["href"] != ""),
    )
    link = tx.norm_text(F.get(canonical, F.lit(0))["href"])

    def read(m):
        pick = lambda *keys: [_meta(m, k) for k in keys]
        return F.struct(
            tx.first_present(*pick("og:title", "twitter:title"), title).alias("title"),
            tx.first_present(*pick("og:description", "description", "twitter:description"))
            .alias("summary"),
            tx.first_present(*pick("author", "article:author", "byl")).alias("author"),
            F.array(*pick("article:published_time", "pubdate", "publishdate", "date"))
            .alias("dates"),
            tx.first_present(link, *pick("og:url", "twitter:url")).alias("canonical"),
        )

    return let(metas, read)


# --- content -----------------------------------------------------------------


def distinct_blocks(blocks: Column) -> Column:
    """Blocks (an array of structs with ``text``, normalised) without boilerplate, the
    first of equal texts kept, with their place in the array and a dense ordinal."""
    names = ("type", "text")
    numbered = F.transform(blocks, lambda b, i: F.struct(i.alias("pos"), *[b[n].alias(n) for n in names]))
    plain = lambda b: F.struct(b["pos"], *[b[n].alias(n) for n in names])

    def firsts(kept):
        keyed = F.transform(
            kept, lambda b: F.struct(b["pos"], tx.block_key(b["text"]).alias("key"), *[b[n].alias(n) for n in names]))
        # a lone block equals no other and needs no key
        return F.when(F.size(kept) < 2, F.transform(kept, plain)).otherwise(
            F.transform(first_in_array(keyed, "key"), plain))

    return F.transform(
        let(F.filter(numbered, lambda b: ~tx.block_skip(b["text"])), firsts),
        lambda b, i: F.struct(
            b["type"].alias("type"), b["text"].alias("text"), i.alias("ordinal"), b["pos"].alias("pos")),
    )


def body_text(blocks: Column) -> Column:
    """The texts of blocks, a blank line between them; null without any."""
    return F.nullif(F.array_join(F.transform(blocks, lambda b: b["text"]), "\n\n"), F.lit(""))


def _blocks(found: Column) -> Column:
    """Text blocks of a page; the walk has normalised their texts."""
    return F.transform(distinct_blocks(found), lambda b: F.struct(b["type"], b["text"], b["ordinal"]))


def _images(found: Column, captions: Column) -> Column:
    """Images with their possible URLs, alt text and first valid caption."""
    valid = F.transform(
        captions, lambda text: let(tx.norm_text(text), lambda t: F.when(tx.caption_valid(t), t))
    )

    def with_captions(texts):
        def image(x):
            sources = [
                urls.srcset_first(x["sources"][i]) if "srcset" in a else x["sources"][i]
                for i, a in enumerate(IMAGE_SOURCES)
            ]
            tried = F.filter(F.transform(x["tries"], lambda i: F.get(texts, i)), lambda t: t.isNotNull())
            return F.struct(
                F.array(*sources).alias("sources"),
                F.nullif(tx.norm_text(x["alt"]), F.lit("")).alias("alt"),
                F.get(tried, F.lit(0)).alias("caption"),
            )

        return F.transform(found, image)

    # Most pages have no image at all; skip the caption machinery for them.
    return F.when(F.size(found) > 0, let(valid, with_captions))


def content_rejection(body: Column, blocks: Column, cfg: Column) -> Column:
    """Why extracted content is not good enough; null when it is."""
    def count(lowered, marker):
        removed = F.char_length(lowered) - F.char_length(F.replace(lowered, marker, F.lit("")))
        return F.floor(removed / F.char_length(marker)).cast("int")

    # Long bodies are never boilerplate dominated, so only short ones are searched.
    short = F.when(F.char_length(body) < 1000, F.lower(body))
    hits = let(
        short,
        lambda text: F.aggregate(cfg["markers"], F.lit(0), lambda acc, m: acc + count(text, m)),
    )
    return let(
        F.struct(F.char_length(body).alias("chars"), hits.alias("hits")),
        lambda m: quality_verdict(m["chars"], F.size(blocks), m["hits"], cfg),
    )


def quality_verdict(chars: Column, blocks: Column, marker_hits: Column, cfg: Column) -> Column:
    return (
        F.when(F.coalesce(chars, F.lit(0)) == 0,
               F.lit("no blocks"))
        .when(
            chars < cfg["min_text_chars"],
            F.concat(F.lit("short text: "), chars, F.lit(" < "),
                     cfg["min_text_chars"]),
        )
        .when(
            blocks < cfg["min_blocks"],
            F.concat(F.lit("few blocks: "), blocks, F.lit(" < "), cfg["min_blocks"]),
        )
        .when((marker_hits >= 3) & (chars < 1000),
              F.lit("mostly boilerplate"))
    )


def _with_urls(parts: DataFrame) -> DataFrame:
    """Pages with the addresses of their ``found_images``."""
    return parts.withColumn(
        "image_urls",
        urls.resolve_first_usable(
            F.col("fallback_url"), F.transform("found_images", lambda i: i["sources"])
        ),
    )


def _placed_images() -> Column:
    """Images with an address, the first of equal ones, of pages _with_urls()."""
    placed = F.zip_with(
        "found_images", "image_urls",
        lambda i, url: F.struct(url.alias("url"), i["alt"].alias("alt"), i["caption"].alias("caption")),
    )
    numbered = F.transform(
        F.filter(placed, lambda i: i["url"].isNotNull()),
        lambda i, at: F.struct(at.alias("pos"), i["url"].alias("url"), i["alt"].alias("alt"),
                               i["caption"].alias("caption")),
    )
    images = F.transform(
        first_in_array(numbered, "url"),
        lambda i, at: F.struct(i["url"].alias("url"), i["alt"].alias("alt"),
                               i["caption"].alias("caption"), at.alias("ordinal")),
    )
    return F.coalesce(images, F.array().cast("array<struct<url:string,alt:string,caption:string,ordinal:int>>"))


def extract_articles(pages: DataFrame) -> DataFrame:
    """Article columns for pages.

    pages: any columns plus payload (binary), fallback_url, extraction (see
    compile_config) and require_canonical. Adds canonical_url, title, summary,
    author, published_at, content_blocks, images, body_text and
    rejection_reason; drops payload and extraction.
    """
    rest = [c for c in pages.columns if c not in ("payload", "extraction")]
    walked = pages.select(
        *rest, "extraction", _content_of(F.col("payload"), F.col("extraction")).alias("page")
    )
    # inline() turns the struct into plain columns: whatever follows reads stored
    # values and cannot make Spark evaluate the extraction again.
    parts = walked.select(*rest, "extraction", F.inline(F.array(F.struct(
        page_metadata(F.col("page.head")).alias("meta"),
        _blocks(F.col("page.blocks")).alias("content_blocks"),
        _images(F.col("page.images"), F.col("page.captions")).alias("found_images"),
    ))))
    body = body_text(F.col("content_blocks"))
    found = _with_urls(parts).select(
        *rest, "extraction", "meta", "content_blocks", _placed_images().alias("images"), body.alias("body"),
    )
    fallback = F.when(~F.col("require_canonical"), F.col("fallback_url"))
    return settle(
        found,
        rejection_reason=content_rejection(
            F.col("body"), F.col("content_blocks"), F.col("extraction")
        ),
    ).select(
        *rest,
        F.coalesce("meta.canonical", fallback).alias("canonical_url"),
        tx.clean_title(F.col("meta.title")).alias("title"),
        F.col("meta.summary").alias("summary"),
        F.col("meta.author").alias("author"),
        tx.first_datetime(F.col("meta.dates")).alias("published_at"),
        "content_blocks", "images",
        F.when(F.col("rejection_reason").isNull(), F.col("body")).alias("body_text"),
        "rejection_reason",
        F.lit(EXTRACTOR_VERSION).alias("extractor_version"),
    )


def _rest(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in ("payload", "extraction")]


def remaining_text(pages: DataFrame) -> DataFrame:
    """Page text once unwanted nodes are gone."""
    shown = pages.select(
        *_rest(pages), F.inline(F.array(_shown_of(F.col("payload"), F.col("extraction"))))
    )
    return shown.withColumn("remaining", tx.norm_text(F.col("remaining")))


def container_rows(pages: DataFrame) -> DataFrame:
    """One row per content container, with its selector's place and its text."""
    homes = F.transform(
        _homes_of(F.col("payload"), F.col("extraction")),
        lambda h, i: F.struct(i.alias("ordinal"), h["place"].alias("place"), h["tag"].alias("tag"),
                              h["text"].alias("text")),
    )
    rows = pages.select(*_rest(pages), F.inline(homes))
    return rows.withColumn("text", tx.norm_text(F.col("text")))


def article_images(pages: DataFrame) -> DataFrame:
    """The ``images`` of extract_articles() alone: neither texts nor metadata are judged."""
    rest = _rest(pages)
    walked = pages.select(*rest, _pictures_of(F.col("payload"), F.col("extraction")).alias("page"))
    parts = walked.select(*rest, F.inline(F.array(F.struct(
        _images(F.col("page.images"), F.col("page.captions")).alias("found_images")))))
    return _with_urls(parts).select(*rest, _placed_images().alias("images"))


def metadata(pages: DataFrame) -> DataFrame:
    """Metadata columns of pages, without their content."""
    walked = pages.select(*_rest(pages), _head_of(F.col("payload"), F.col("extraction")).alias("head"))
    return walked.select(*_rest(pages), F.inline(F.array(page_metadata(F.col("head")))))


_content_of, _homes_of, _shown_of = _of_pages(_content, _CONTENT), _of_pages(_homes, _HOMES), _of_pages(_shown, _SHOWN)
_pictures_of = _of_pages(_pictures, _PICTURES)
_head_of = _of_pages(lambda payload, _: _head(Tree(payload)), _HEAD)
