"""DuckDB texts of the carrier views, as common table expressions."""

PE = """pe AS (
  SELECT event_id, ts, user_id, value, k,
    CASE event_type WHEN 'view' THEN 'article_fetched' WHEN 'purchase' THEN 'article_extracted'
      WHEN 'error' THEN 'dlq' WHEN 'click' THEN 'pipeline_metric'
      WHEN 'signup' THEN 'article_fetch_requested' END AS topic_key,
    'src' || user_id AS source_id,
    CASE k % 5 WHEN 3 THEN 'article_fetch' WHEN 4 THEN 'event_decode' ELSE 'article_extract' END AS stage,
    CASE k % 4 WHEN 0 THEN 'ValueError' WHEN 1 THEN ' KeyError ' WHEN 2 THEN 'HttpFetchError'
      ELSE 'TypeError' END AS error_class,
    CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
    'article_' || user_id || '_' || (k % 10) AS article_id,
    CASE k % 2 WHEN 0 THEN 'fetcher' ELSE 'extractor' END AS service,
    CASE k % 3 WHEN 0 THEN 'consumer_retry_count' WHEN 1 THEN 'article_fetch_retry_count'
      ELSE 'other_count' END AS metric_name
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""



def exact_sum(value):
    """The sum of doubles from 0.001 to 1e6, exact and rounded once: as whole numbers of
    2**-60, of which all bits a double cannot hold become one sticky bit."""
    s = f"sum(CAST({value} * 1152921504606846976 AS HUGEINT))"

    def cut(unit):
        return (f"CAST(CAST({s} // {unit} + CASE WHEN {s} % {unit} > 0 AND ({s} // {unit}) % 2 = 0 THEN 1 ELSE 0 END "
                f"AS BIGINT) AS DOUBLE) * {unit}")

    return (f"(CASE WHEN {s} < {1 << 62} THEN CAST(CAST({s} AS BIGINT) AS DOUBLE) WHEN {s} < {1 << 70} THEN {cut(1 << 8)} "
            f"ELSE {cut(1 << 16)} END) / 1152921504606846976")


# One row per counter: (day, family, name, source, stage, error class, dims, value).
COUNTS = PE + """,
counts AS (
  SELECT CAST(ts AS DATE) AS d, 1 AS family, 'ArticleFetchSuccessCount' AS name, source_id,
    '' AS stage, '' AS error_class, CAST(count(*) AS DOUBLE) AS value,
    '{"sourceId":"' || source_id || '"}' AS dimensions
  FROM pe WHERE topic_key = 'article_fetched' GROUP BY ALL
  UNION ALL
  SELECT CAST(ts AS DATE), 2, 'ArticleExtractionSuccessCount', source_id, '', '',
    CAST(count(*) AS DOUBLE), '{"sourceId":"' || source_id || '"}'
  FROM pe WHERE topic_key = 'article_extracted' GROUP BY ALL
  UNION ALL
  SELECT CAST(ts AS DATE), f, CASE f WHEN 3 THEN 'ArticleRejectedCount' ELSE 'DlqEventCount' END,
    source_id, stage, trim(error_class), CAST(count(*) AS DOUBLE),
    '{"errorClass":"' || trim(error_class) || '","sourceId":"' || source_id || '","stage":"' || stage || '"}'
  FROM pe, (VALUES (3), (4)) v(f) WHERE topic_key = 'dlq' GROUP BY ALL
  UNION ALL
  SELECT CAST(ts AS DATE), 5, CASE metric_name WHEN 'consumer_retry_count' THEN 'ConsumerRetryCount'
      ELSE 'ArticleFetchRetryCount' END, '', '', '',
    """ + exact_sum("value") + """,
    '{"errorClass":"' || trim(error_class) || '","service":"' ||
      CASE WHEN k % 10 = 3 THEN 'override' ELSE service END || '","sourceId":"' || source_id || '"}'
  FROM pe WHERE topic_key = 'pipeline_metric' AND metric_name <> 'other_count' GROUP BY ALL
  UNION ALL
  SELECT d, 6, 'SourceExtractionFailure', source_id, '', '', 1.0, '{"sourceId":"' || source_id || '"}'
  FROM (SELECT CAST(ts AS DATE) AS d, source_id,
          count(*) FILTER (topic_key = 'dlq' AND stage = 'article_extract') AS bad,
          count(*) FILTER (topic_key = 'article_extracted') AS good
        FROM pe GROUP BY ALL) WHERE bad >= 3 AND good = 0
)"""

def url_part(url, index):
    """RFC 3986 component by regex group (1 scheme, 2 netloc, 3 path, 4 query)."""
    pattern = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
    return f"regexp_extract({url}, '{pattern}', {index})"


def norm_url(url):
    query = (
        f"array_to_string(list_filter(string_split({url_part(url, 4)}, '&'), "
        "lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_')), '&')"
    )
    return (
        f"(lower({url_part(url, 1)}) || '://' || lower({url_part(url, 2)}) || {url_part(url, 3)} || "
        f"CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END)"
    )


def url_host(url):
    return f"rtrim(lower(regexp_extract({url_part(url, 2)}, '^(?:.*@)?([^:]*)', 1)), '.')"


def stable_id(prefix, *parts):
    joined = " || chr(31) || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"'{prefix}_' || left(sha256({joined}), 32)"


WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def norm_text(value):
    return f"trim(regexp_replace({value}, '{WS}', ' ', 'g'))"


FEED_ITEMS = f"""items0 AS (
  SELECT source AS source_id, lang AS feed_id, doc_id AS pos,
    CASE WHEN toxic = 1 AND lang = 'de' THEN 'https://Evil.example/'
      ELSE 'https://WWW.' || source || '.example.com/' END
      || lang || '/' || doc_id || '?utm_source=rss&ref=' || lang || '#top' AS link,
    {norm_text("split_part(text, chr(10), 1)")} AS title, {norm_text('text')} AS summary,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%S+00:00') AS published_iso,
    quality
  FROM documents LEFT JOIN labels USING (doc_id)),
cur AS (SELECT * EXCLUDE (quality), {norm_url('link')} AS article_url FROM items0),
prev AS (SELECT *, {norm_url('link')} AS article_url FROM (
  SELECT source_id, feed_id, pos, link,
    CASE WHEN quality = 0 THEN title || ' (old)' ELSE title END AS title, summary, published_iso
  FROM items0 WHERE quality IS NOT NULL
  UNION ALL
  SELECT 'src0', 'en', item_id, 'https://www.src0.example.com/gone/' || item_id,
    {norm_text('text')}, '', '' FROM benchmark))"""

CRAWL = PE + """,
crawl AS (SELECT event_id, ts, user_id, source_id, k,
  CAST([200, 200, 200, 304, 404, 408, 425, 428, 429, 500, 503][k % 11 + 1] AS INTEGER) AS status,
  'feed' || (k % 4) AS feed_id, k % 17 = 0 AS untyped FROM pe)"""

SOURCES = """sources AS (SELECT 'src' || user_id AS source_id, user_id % 7 <> 0 AS enabled,
  'src' || user_id || '.example.com' AS domain,
  CASE WHEN user_id % 2 = 0 THEN [428, 404] ELSE [428] END AS blocked
  FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'
    AND CAST(json_extract_string(props, '$.k') AS INTEGER) < 10))"""

FRAMED = PE + """,
framed AS (SELECT 'news.' || topic_key AS topic, "partition", "offset", ts, body,
  CASE WHEN event_id % 89 = 0 THEN NULL
    WHEN event_id % 97 = 0 THEN left(hex(good), 6)
    WHEN event_id % 101 = 0 THEN hex(encode(body))
    WHEN event_id % 83 = 0 THEN hex(good) || 'FF'
    ELSE hex(good) END AS h
  FROM (SELECT *, from_hex('00' || lpad(hex(k % 5), 8, '0')) || encode(body) AS good FROM (
    SELECT *, CASE WHEN event_id % 79 = 0 THEN 'not-json' WHEN event_id % 73 = 0 THEN '[1]'
      ELSE '{"article_id":"' || article_id || '","k":' || k || ',"source_id":"' || source_id || '"}'
      END AS body FROM pe)))"""


def frame_verdict(known="TRUE"):
    """Verdict of the hex text h; every body but one ending in FF is UTF-8."""
    return f"""CASE WHEN h IS NULL THEN 'empty_payload'
      WHEN length(h) < 10 OR left(h, 2) <> '00' THEN 'bad_framing'
      WHEN CAST('0x' || substr(h, 3, 8) AS BIGINT) <= 0 THEN 'bad_schema_id'
      WHEN NOT ({known}) THEN 'unexpected_schema_id'
      WHEN right(h, 2) = 'FF' THEN 'not_utf8'
      WHEN NOT json_valid(decode(from_hex(substr(h, 11)))) THEN 'not_json'
      WHEN json_type(decode(from_hex(substr(h, 11)))) <> 'OBJECT' THEN 'not_an_object' END"""
