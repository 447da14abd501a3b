"""Queries of the article extraction path."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.functions import ids, text
from presswork.operators import extraction as E
from presswork.plans import article_flow
from presswork.sources import carriers as C
from presswork.sources.landing import article_payload_uri
from presswork.sources.tables import spread_table, table


def now():
    return F.lit("2024-02-01").cast("timestamp")


def site_config(spark):
    """Extraction settings of the three page sites (configuration)."""
    return spark.createDataFrame(
        [
            ("example.com", None, None, None, None, None, None, "html_article", None),
            ("example.net", ["main", "article"], [" h1 ", ""], None, ["zzz"], 1200, 1,
             "html_article", None),
            ("example.org", None, None, None, None, None, 1, "pdf_article",
             "canonical_link_required"),
        ],
        "source_id string, content_selectors array<string>, exclude_selectors array<string>, "
        "unwrap_selectors array<string>, boilerplate_markers array<string>, min_text_chars int, "
        "min_blocks int, extractor string, attribution_policy string",
    )


def configured_pages(spark, folder):
    """pages with their site's compiled settings."""
    pages = C.landed_pages(spark, folder).select(
        "page_id", "source_id", "payload", F.col("requested_url").alias("fallback_url"),
        F.lit(False).alias("require_canonical"),
    )
    return pages.join(E.compile_config(site_config(spark)), "source_id").drop(
        "extractor", "attribution_policy"
    )


def document_pages(spark, folder):
    """documents as article pages: lines are paragraphs, list items and figures."""
    def escaped(value):
        return F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    def element(line, i):
        figure = F.concat(
            F.lit('<figure><img data-src="/img/'), F.md5(line), F.lit('.jpg" src="data:x" alt=" '),
            F.md5(line), F.lit('"><figcaption>'), escaped(line), F.lit("</figcaption></figure>"),
        )
        return (
            F.when(i % 5 == 3, figure)
            .when(i % 5 == 4, F.concat(F.lit("<li>"), escaped(line), F.lit("</li>")))
            .otherwise(F.concat(F.lit("<p>"), escaped(line), F.lit("</p>")))
        )

    html = F.concat(
        F.lit("<html><head><title>"), escaped(F.split("text", "\n", 2)[0]),
        F.lit('</title><meta name="author" content="'), F.col("source"),
        F.lit('"><link rel="canonical" href="/doc/'), F.col("doc_id"),
        F.lit('"></head><body><nav><p>Navigation text that is never kept</p></nav><article>'),
        F.array_join(F.transform(F.split("text", "\n"), element), ""),
        F.lit('</article><div class="banner"><p>Banner text that is never kept</p></div></body></html>'),
    )
    # no source sets anything here: the settings are one literal struct
    return E.compile_config(
        spread_table(spark, folder, "documents").select("doc_id", "source", F.encode(html, "UTF-8").alias("payload"),
                F.lit("https://news.example.com/x/y.html").alias("fallback_url"),
                F.lit(True).alias("require_canonical"))
    )


def extract_articles(spark, folder):
    found = E.extract_articles(configured_pages(spark, folder))
    return found.select(
        "page_id", "canonical_url", "title", F.size("content_blocks").alias("blocks"),
        F.size("images").alias("images"), "body_text", "rejection_reason",
    )


def page_metadata(spark, folder):
    return E.metadata(configured_pages(spark, folder)).select(
        "page_id", "title", "summary", "author", F.array_join("dates", ",").alias("dates")
    )


def page_canonical(spark, folder):
    return E.metadata(document_pages(spark, folder)).select("doc_id", "canonical", "author", "title")


def strip_boilerplate_nodes(spark, folder):
    return E.remaining_text(configured_pages(spark, folder)).select(
        "page_id", "removed_nodes", "remaining"
    )


def content_containers(spark, folder):
    return E.container_rows(configured_pages(spark, folder)).select(
        "page_id", "ordinal", "place", "tag", "text"
    )


def content_blocks(spark, folder):
    found = E.extract_articles(document_pages(spark, folder))
    return found.select("doc_id", F.inline("content_blocks"))


def article_images(spark, folder):
    found = E.article_images(document_pages(spark, folder))
    return found.select("doc_id", F.inline("images")).select("doc_id", "url", "alt", "ordinal")


def image_captions(spark, folder):
    found = E.article_images(document_pages(spark, folder))
    return found.select("doc_id", F.inline("images")).select("doc_id", "url", "caption")


def extraction_config_join(spark, folder):
    joined = configured_pages(spark, folder)
    return joined.select(
        "page_id", "source_id",
        F.array_join(F.transform("extraction.content", lambda s: s["tag"]), ",").alias("content"),
        F.array_join(F.transform("extraction.exclude", lambda s: s["tag"]), ",").alias("exclude"),
        "extraction.min_text_chars", "extraction.min_blocks",
    )


def fetched_pages(spark, folder):
    """Fetched events of pages with their site's settings, and the landing table."""
    pages = C.landed_pages(spark, folder)
    article = ids.article_id(F.col("requested_url"))
    document = ids.stable_id("source_doc", article, F.sha2("payload", 256))
    events = pages.select(
        "page_id", "source_id", "ingest_date", F.lit("run").alias("run_id"),
        article.alias("article_id"), "requested_url", document.alias("source_document_id"),
        article_payload_uri(F.col("source_id"), F.col("ingest_date"), article, document)
        .alias("payload_uri"),
        "content_hash", "fetch_status", "payload",
    )
    landed = events.select("payload_uri", "ingest_date", "payload")
    settings = E.compile_config(site_config(spark))
    return events.drop("payload").join(settings, "source_id"), landed


def extraction_gates(spark, folder):
    fetched, landed = fetched_pages(spark, folder)
    return article_flow.extract_fetched(fetched, landed).select(
        "page_id", "verdict", article_flow.gate_stage(F.col("verdict")).alias("stage")
    ).withColumn("stage", F.when(F.col("verdict").isNotNull(), F.col("stage")))


def _document_articles(spark, folder):
    """documents as extracted articles, their lines as blocks."""
    lines = F.split("text", "\n")
    block = lambda line, i: F.struct(
        F.lit("paragraph").alias("type"), line.alias("text"), i.cast("int").alias("ordinal"))
    none = F.lit(None).cast("string")
    return table(spark, folder, "documents").select(
        F.lit("run").alias("run_id"), F.col("source").alias("source_id"),
        F.lit("2024-01-02").cast("date").alias("ingest_date"),
        F.concat(F.lit("article_"), F.col("doc_id")).alias("article_id"),
        F.concat(F.lit("https://news.example.com/"), F.col("doc_id")).alias("requested_url"),
        F.concat(F.lit("https://news.example.com/"), F.col("doc_id")).alias("canonical_url"),
        F.concat(F.lit("Document "), F.col("doc_id")).alias("title"), none.alias("summary"),
        F.array_join(lines, "\n\n").alias("body_text"),
        F.transform(lines, block).alias("content_blocks"),
        F.array().cast("array<struct<url:string,alt:string,caption:string,ordinal:int>>")
        .alias("images"),
        none.alias("author"), F.lit(None).cast("timestamp").alias("published_at"),
        F.concat(F.lit("source_doc_"), F.col("doc_id")).alias("source_document_id"),
        F.concat(F.lit("uri/"), F.col("doc_id")).alias("payload_uri"),
        F.lit(E.EXTRACTOR_VERSION).alias("extractor_version"),
    )


def oversize_split(spark, folder):
    events = article_flow.extracted_events(_document_articles(spark, folder), now())
    split = article_flow.split_oversize(events, 3000)
    return split.select(
        "article_id", "inline_event_bytes", F.char_length("body_text").alias("body_length"),
        F.size("content_blocks").alias("blocks"), "extracted_payload_hash", "extracted_payload_uri",
        "size_verdict",
    )


def extracted_event_build(spark, folder):
    events = article_flow.extracted_events(_document_articles(spark, folder), now())
    return events.select(
        "schema_version", "event_id", "event_time", "source_id", "ingest_date", "article_id",
        "canonical_url", "title", "content_hash", "source_document_id", "source_payload_uri",
        "extractor_version", "extraction_status",
    )


def extract_outcome_stats(spark, folder):
    return article_flow.outcome_stats(_document_articles(spark, folder))


def _lines(spark, folder):
    return C.document_lines(spark, folder).select(
        "doc_id", "pos", text.norm_text(F.col("line")).alias("text")
    )


def block_skip(spark, folder):
    """Every third line gets a recommendation prefix first."""
    marked = F.when(
        F.col("pos") % 3 == 2, F.concat(C.pick(F.col("pos"), ">> ", "XEM THÊM ", "Nguồn : ", "sources: ",
                                               "Chia sẻ"), F.col("text"))
    ).otherwise(F.col("text"))
    return _lines(spark, folder).select("doc_id", "pos", text.block_skip(marked).alias("skip"))


def caption_validity(spark, folder):
    return _lines(spark, folder).select(
        "doc_id", "pos", text.caption_valid(F.col("text")).alias("valid")
    )


def _line_blocks(spark, folder):
    """documents with their lines as deduplicated blocks, every document in its row."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.lit("paragraph").alias("type"), text.norm_text(x).alias("text")))
    docs = spread_table(spark, folder, "documents").select("doc_id", lines.alias("lines"))
    return docs.select("doc_id", E.distinct_blocks(F.col("lines")).alias("blocks"))


def block_dedupe(spark, folder):
    return _line_blocks(spark, folder).select("doc_id", F.inline("blocks")).select(
        "doc_id", "pos", "ordinal", "text"
    )


def json_body_join(spark, folder):
    bodies = _line_blocks(spark, folder).filter(F.size("blocks") > 0)
    return bodies.select(
        "doc_id", E.body_text(F.col("blocks")).alias("body_text"), F.size("blocks").alias("block_count")
    )


def content_quality_reject(spark, folder):
    """Deduped lines of each document judged against tight settings."""
    bodies = _line_blocks(spark, folder).select("doc_id", "blocks", E.body_text(F.col("blocks")).alias("body_text"))
    cfg = F.struct(
        F.array(F.lit("the "), F.lit("und ")).alias("markers"),
        F.lit(200).alias("min_text_chars"), F.lit(2).alias("min_blocks"),
    )
    return bodies.select(
        "doc_id", E.content_rejection(F.col("body_text"), F.col("blocks"), cfg).alias("reason")
    )


QUERIES = {
    f.__name__: f
    for f in (
        extract_articles, page_metadata, page_canonical, strip_boilerplate_nodes,
        content_containers, content_blocks, article_images, image_captions,
        extraction_config_join, extraction_gates, oversize_split, extracted_event_build,
        extract_outcome_stats, block_skip, caption_validity, block_dedupe, json_body_join,
        content_quality_reject,
    )
}
