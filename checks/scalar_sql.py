"""DuckDB texts for the scalar queries."""

from checks.duck_views import (
    CRAWL, FEED_ITEMS, FRAMED, PE, frame_verdict, norm_text, norm_url, stable_id, url_part,
)

_DAY = "CAST(day(ts) AS VARCHAR) || ' ' || strftime(ts, '%b %Y %H:%M:%S')"
# The event time truncated to seconds, shifted by the style's offset.
_RSS = """CASE k % 6 WHEN 0 THEN 420 WHEN 1 THEN 0 WHEN 2 THEN -300 WHEN 3 THEN 0 WHEN 4 THEN -210 END"""
_ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
_RSS_AT = f"strftime(ts - to_minutes({_RSS}), {_ISO})"

SQL = {
    "norm_text": f"SELECT doc_id, {norm_text('text')} AS norm FROM documents",
    "summary_text": f"SELECT doc_id, {norm_text('text')} AS summary FROM documents",
    "norm_url": f"SELECT page_id, {norm_url('url')} AS url FROM pages",
    "stable_id": f"""SELECT page_id, {stable_id('article', norm_url('url'))} AS article_id,
      {stable_id('event', "'article.fetched.v2'", 'page_id', "''")} AS event_id FROM pages""",
    "record_hash": f"""WITH {FEED_ITEMS} SELECT source_id, feed_id, pos,
      {stable_id('record', 'article_url', 'title', 'summary', 'published_iso')} AS record_hash,
      {stable_id('feed_item', 'source_id', 'feed_id', 'article_url')} AS feed_item_id FROM cur""",
    "content_sha256": "SELECT page_id, sha256(encode(html)) AS sha256 FROM pages",
    "rss_datetime": f"""WITH {PE} SELECT event_id, {_RSS_AT} AS published_at,
      CASE WHEN k % 6 < 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || ['+07:00', '+00:00', '-05:00',
        '+00:00', '-03:30'][k % 6 + 1] END AS published_iso FROM pe""",
    "article_datetime": f"""WITH {PE} SELECT event_id, CASE k % 4
        WHEN 0 THEN strftime(ts - INTERVAL 7 HOUR, {_ISO}) WHEN 1 THEN strftime(ts, {_ISO})
        WHEN 2 THEN strftime(date_trunc('day', ts), {_ISO}) ELSE {_RSS_AT} END AS published_at
      FROM pe""",
    "clean_title": f"""SELECT doc_id, CASE WHEN t <> '' THEN
        {norm_text("regexp_replace(t, '[[:space:]]+[-|][[:space:]]+.*$', '')")} END AS title
      FROM (SELECT doc_id, split_part(text, chr(10), 1)
        || [' - Site', ' | Site - News', '-Site', ''][doc_id % 4 + 1] AS t FROM documents)""",
    "first_present": f"""WITH {PE} SELECT event_id, CASE WHEN k % 3 = 0 THEN article_id
        WHEN k % 2 = 0 THEN source_id END AS found FROM pe""",
    "resolve_url": f"""SELECT page_id, CASE page_id % 6
        WHEN 0 THEN origin || '/a/b.html' WHEN 1 THEN 'https://cdn.example.org/x.jpg'
        WHEN 2 THEN lower({url_part('url', 1)}) || '://cdn.example.org/y.jpg'
        WHEN 4 THEN origin || regexp_replace({url_part('url', 3)}, '[^/]*$', '') || 'next.html'
        WHEN 5 THEN {norm_url('url')} END AS resolved
      FROM (SELECT *, lower({url_part('url', 1)}) || '://' || lower({url_part('url', 2)}) AS origin
        FROM pages)""",
    "srcset_first": """SELECT page_id, CASE page_id % 3 WHEN 2 THEN '' ELSE url END AS first_url
      FROM pages""",
    "clean_dimensions": f"""WITH {PE} SELECT event_id, '{{"errorClassName":"' || trim(error_class)
        || '","plain":"' || repeat('x', least(k + 100, 128)) || '","sourceId":"' || source_id
        || '"}}' AS dimensions FROM pe""",
    "retry_delay": f"""WITH {CRAWL} SELECT event_id, attempt, attempt * CAST(1.5 AS DOUBLE) AS http_delay,
        least(CAST(60 AS DOUBLE), 2 * pow(CAST(2 AS DOUBLE), least(attempt, 40) - 1)) AS consumer_delay
      FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt
        FROM crawl)""",
    "error_struct": f"""WITH {CRAWL} SELECT event_id,
        CASE WHEN untyped THEN 'unexpected' ELSE
          ['feed_fetch', 'article_fetch', 'payload_read', 'event_decode'][k % 4 + 1] END AS stage,
        NOT untyped AND CASE k % 4 WHEN 2 THEN TRUE WHEN 3 THEN FALSE
          ELSE status IN (408, 425, 429, 500, 503) END AS retryable,
        'HTTPStatusError' AS error_class, 'status ' || status AS error_message,
        CASE WHEN NOT untyped AND k % 4 < 2 THEN status END AS status_code
      FROM crawl WHERE status <> 200""",
    "base64_payload": f"""WITH {FRAMED} SELECT "offset", verdict,
        to_base64(coalesce(from_hex(h), ''::BLOB)) AS base64
      FROM (SELECT *, {frame_verdict()} AS verdict FROM framed) WHERE verdict IS NOT NULL""",
}
