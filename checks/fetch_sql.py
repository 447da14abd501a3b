"""DuckDB texts for the landing and fetch queries."""

from checks.duck_views import CRAWL, PE, SOURCES, norm_url, stable_id, url_host

PAGES = f"""landed AS (SELECT page_id, url, html,
    regexp_extract({url_host('url')}, '(example\\.[a-z]+)$', 1) AS source_id,
    CAST(DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER) AS VARCHAR) AS ingest_date,
    {norm_url('url')} AS requested_url, 'rev' || (page_id % 3) AS request_revision,
    encode(html) AS payload, sha256(encode(html)) AS real_hash,
    CASE WHEN page_id % 10 = 0 THEN sha256(encode(html || 'x')) ELSE sha256(encode(html)) END AS content_hash,
    CASE WHEN page_id % 7 = 0 THEN 'failed' ELSE 'success' END AS fetch_status,
    ['text/html; charset=utf-8', ' TEXT/HTML ', 'application/xhtml+xml', 'application/json', ''][page_id % 5 + 1]
      AS content_type FROM pages),
fetched AS (SELECT *, {stable_id('source_doc', 'article_id', 'real_hash')} AS source_document_id
  FROM (SELECT *, {stable_id('article', 'requested_url')} AS article_id FROM landed)),
addressed AS (SELECT *, 'landing/articles/source_id=' || source_id || '/ingest_date=' || ingest_date
    || '/article_id=' || article_id || '/source_document_id=' || source_document_id AS payload_uri
  FROM fetched)"""

# Texts of challenge and error pages.
_MARKERS = (
    "<title>just a moment", "checking your browser before accessing",
    "/cdn-cgi/challenge-platform/", "cf-chl-", "__jsl_clearance", "<title>access denied</title>",
    "<title>request rejected</title>", "<title>403 forbidden</title>",
    "<title>404 not found</title>", "<title>not found</title>",
)
_MARKER_LIST = "[" + ", ".join(f"'{m}'" for m in _MARKERS) + "]"

_REQUESTS = PE + """,
requests AS (SELECT event_id, article_id, 'rev' || (k % 2) AS request_revision FROM pe
  WHERE topic_key = 'article_fetch_requested'),
completions AS (SELECT article_id, 'rev' || (k % 2) AS request_revision,
  'doc_' || min(event_id) AS source_document_id FROM pe WHERE topic_key = 'article_fetched' GROUP BY 1, 2)"""

SQL = {
    "url_allowlist": f"""WITH {PAGES} SELECT page_id, source_id,
        CASE WHEN NOT starts_with(requested_url, 'https://') THEN 'not_https'
          WHEN source_id = 'example.org' AND NOT ends_with({url_host('url')}, '.sub.example.org')
            AND {url_host('url')} <> 'sub.example.org' THEN 'outside_domain' END AS verdict
      FROM landed""",
    "address_screen": f"""WITH {PE}, a AS (SELECT DISTINCT
        'host' || user_id || '-' || (k % 10) || '.example.com' AS host, k % 11 AS n,
        CASE WHEN k % 13 <> 0 THEN ['8.8.4.', '10.1.2.', '127.0.0.', '192.168.7.', '172.20.1.',
          '93.184.216.', '100.64.3.', '169.254.9.', '203.0.113.', '1.1.1.', '151.101.1.'][k % 11 + 1]
          || (event_id % 250 + 1) END AS address FROM pe)
      SELECT *, CASE WHEN addresses = 0 THEN 'no_addresses' WHEN blocked <> '' THEN 'non_public' END
        AS verdict, addresses = 0 AS retryable
      FROM (SELECT host, count(DISTINCT address) AS addresses,
          coalesce(string_agg(DISTINCT address, ',' ORDER BY address)
            FILTER (n IN (1, 2, 3, 4, 6, 7, 8)), '') AS blocked FROM a GROUP BY host)""",
    "http_status_class": f"""WITH {CRAWL}, {SOURCES} SELECT event_id, status,
        CASE WHEN status = 200 THEN 'ok' WHEN list_contains(blocked, status) THEN 'blocked'
          WHEN status IN (408, 425, 429, 500, 503) THEN 'retryable' ELSE 'permanent' END AS article_class,
        CASE WHEN status = 200 THEN 'ok' WHEN status = 304 THEN 'not_modified'
          WHEN status IN (408, 425, 429, 500, 503) THEN 'retryable' ELSE 'permanent' END AS feed_class
      FROM crawl LEFT JOIN sources USING (source_id)""",
    "payload_size_limit": f"""WITH {PAGES} SELECT page_id, CASE
        WHEN page_id % 4 = 1 AND octet_length(payload) > 4000 THEN 'declared_too_large'
        WHEN page_id % 9 = 0 THEN 'empty' WHEN octet_length(payload) > 4000 THEN 'too_large' END AS verdict
      FROM landed""",
    "document_validity": f"""WITH {PAGES} SELECT page_id, CASE
        WHEN content_type = 'application/json' THEN 'not_html: application/json'
        ELSE 'marker: ' || list_filter(list_concat({_MARKER_LIST}, CASE source_id
            WHEN 'example.com' THEN ['casino'] WHEN 'example.net' THEN ['<h1>Is '] ELSE [] END),
          lambda m: contains(lower(html), lower(m)))[1] END AS verdict FROM landed""",
    "fetch_success_gate": f"""WITH {PAGES} SELECT page_id,
        CASE WHEN fetch_status <> 'success' OR page_id % 11 = 0 THEN 'not_fetched' END AS verdict FROM landed""",
    "source_enrich": f"""WITH {PE}, {SOURCES} SELECT event_id, source_id, domain,
        CASE WHEN domain IS NULL THEN 'unknown source: ' || source_id
          WHEN NOT enabled THEN 'disabled source: ' || source_id END AS source_verdict
      FROM pe LEFT JOIN sources USING (source_id)""",
    "feed_select": f"""WITH {CRAWL}, {SOURCES} SELECT source_id, feed_id,
        CASE WHEN ok THEN 'news' END AS category,
        CASE WHEN ok THEN 'https://www.' || source_id || '.example.com/' || feed_id || '.rss' END AS url,
        CASE WHEN NOT ok THEN 'unknown feed of ' || source_id || ': ' || feed_id END AS verdict
      FROM (SELECT DISTINCT source_id, feed_id, domain IS NOT NULL AND feed_id <> 'feed3' AS ok
        FROM crawl LEFT JOIN sources USING (source_id))""",
    "redirect_chain": f"""WITH RECURSIVE p AS (
        SELECT page_id, 'https://' || {url_host('url')} || '/p/' || page_id AS url,
          regexp_extract({url_host('url')}, 'example\\.([a-z]+)$', 1) AS tld FROM pages),
      walk AS (
        SELECT page_id, page_id AS here, 0 AS hops,
          CASE WHEN tld = 'org' THEN 'outside_domain' END AS verdict FROM p
        UNION ALL
        SELECT page_id, CASE WHEN hops < 5 AND here % 50 <> 49 THEN here // 3 ELSE here END,
          CASE WHEN hops < 5 AND here % 50 <> 49 THEN hops + 1 ELSE hops END,
          CASE WHEN hops = 5 THEN 'redirect_limit' WHEN here % 50 = 49 THEN 'malformed_redirect' END
        FROM walk WHERE verdict IS NULL AND here > 0)
      SELECT w.page_id, p.url AS final_url, CAST(hops AS INTEGER) AS hops, verdict,
        coalesce(verdict = 'malformed_redirect', FALSE) AS retryable
      FROM (SELECT *, row_number() OVER (PARTITION BY page_id
          ORDER BY (verdict IS NULL)::INT, hops DESC) AS nth FROM walk) w
      JOIN p ON p.page_id = w.here WHERE nth = 1""",
    "fetch_already_done": f"""WITH {_REQUESTS} SELECT event_id, article_id, request_revision,
        source_document_id,
        CASE WHEN source_document_id IS NULL THEN 'new' ELSE 'already_processed' END AS status
      FROM requests LEFT JOIN completions USING (article_id, request_revision)""",
    "fetch_new_work": f"""WITH {_REQUESTS} SELECT min(event_id) AS event_id, article_id, request_revision
      FROM requests ANTI JOIN completions USING (article_id, request_revision) GROUP BY 2, 3""",
    "fetched_event_build": f"""WITH {PAGES} SELECT 'article.fetched.v2' AS schema_version,
        {stable_id('event', "'article.fetched.v2'", 'article_id', 'real_hash')} AS event_id,
        '2024-02-01T00:00:00.000000Z' AS event_time, 'run' AS run_id, source_id, ingest_date, article_id,
        requested_url, source_document_id, '2024-02-01T00:00:00.000000Z' AS fetched_at,
        CAST(200 AS INTEGER) AS status_code, nullif(content_type, '') AS content_type,
        octet_length(payload) AS content_length_bytes, payload_uri, real_hash AS content_hash,
        'success' AS fetch_status FROM addressed""",
    "storage_layout": f"""WITH {PAGES} SELECT page_id, payload_uri,
        'checkpoints/fetches/article_id=' || article_id || '/request_revision=' || request_revision
          AS checkpoint_uri,
        'checkpoints/feeds/source_id=' || source_id || '/feed_id=main' AS feed_checkpoint_uri
      FROM addressed""",
    "landing_write_if_absent": f"""WITH {PAGES} SELECT DISTINCT payload_uri, real_hash AS content_hash
      FROM addressed WHERE payload_uri NOT IN (
        SELECT payload_uri FROM addressed WHERE starts_with(requested_url, 'https'))""",
    "landing_read_verified": f"""WITH {PAGES} SELECT 'page/' || page_id AS payload_uri,
        CASE WHEN fetch_status = 'failed' THEN 'missing_payload'
          WHEN real_hash <> content_hash THEN 'hash_mismatch' END AS verdict FROM landed""",
}
