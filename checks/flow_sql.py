"""DuckDB texts for the whole flows."""

from checks.article_sql import TEXT, _clean
from checks.duck_views import stable_id, url_host
from checks.event_sql import _AT, _ROUTED
from checks.event_sql import SQL as EVENT_SQL
from checks.fetch_sql import _MARKER_LIST, PAGES

_BODY = """'{"article_id":"' || article_id || '","content_hash":' ||
    CASE WHEN page_id % 23 = 5 THEN 'null' ELSE '"' || content_hash || '"' END ||
    ',"content_length_bytes":' || octet_length(payload) || ',"content_type":' || to_json(content_type) ||
    ',"event_id":"event_' || page_id || '","event_time":"2024-01-31T00:00:00.000000Z","fetch_status":"' || fetch_status ||
    '","fetched_at":"2024-01-31T00:00:00.000000Z","ingest_date":"' || ingest_date || '","payload_uri":"' || payload_uri ||
    '","requested_url":' || to_json(requested_url) || ',"run_id":"run","schema_version":"article.fetched.v' ||
    CASE WHEN page_id % 19 = 4 THEN '1' ELSE '2' END || '","source_document_id":"' || source_document_id ||
    '","source_id":"' || event_source || '","status_code":200}'"""

_RECORDS = TEXT + f""",
named AS (SELECT j.*, a.article_id, a.source_document_id, a.payload_uri,
    CASE WHEN j.page_id % 29 = 7 THEN 'nowhere.example' WHEN j.page_id % 31 = 8 THEN 'off.example'
      ELSE j.source_id END AS event_source
  FROM judged j JOIN addressed a USING (page_id)),
records AS (SELECT *, {_BODY} AS event_json, {_clean('raw_title')} AS title FROM named),
decided AS (SELECT *, CASE WHEN page_id % 17 = 3 THEN 'bad_framing'
    WHEN page_id % 19 = 4 THEN 'not an article.fetched.v2 event'
    WHEN page_id % 23 = 5 THEN 'missing fields: content_hash' END AS bad_event,
  CASE event_source WHEN 'nowhere.example' THEN 'unknown source: nowhere.example'
    WHEN 'off.example' THEN 'disabled source: off.example' END AS bad_source,
  CASE WHEN fetch_status = 'failed' THEN 'not_fetched' WHEN page_id % 13 = 6 THEN 'missing_payload'
    WHEN real_hash <> content_hash THEN 'hash_mismatch'
    WHEN source_id = 'example.org' THEN 'unsupported extractor: pdf_article'
    WHEN reason IS NOT NULL THEN 'rejected: ' || reason
    WHEN coalesce(title, '') = '' THEN 'no_title_or_body' END AS verdict FROM records),
failing AS (SELECT *, coalesce(bad_event, bad_source, verdict) AS message,
  CASE WHEN bad_event IS NOT NULL THEN 'event_decode' WHEN bad_source IS NOT NULL THEN 'source_select'
    WHEN verdict IN ('missing_payload', 'hash_mismatch') THEN 'payload_read' ELSE 'article_extract' END AS stage,
  CASE WHEN bad_event IS NULL AND bad_source IS NULL THEN 'IngestionError' ELSE 'ValueError' END AS error_class
  FROM decided)"""

_EVENT = """'{"article_id":"' || article_id || '","author":null,"body_text":' || {body} || ',"canonical_url":' ||
    to_json(requested_url) || ',"content_blocks":[' || {blocks} || '],"content_hash":"' || body_hash || '","event_id":"' ||
    event_id || '","event_time":"2024-02-01T00:00:00.000000Z","extracted_payload_hash":' || {hash} ||
    ',"extracted_payload_uri":' || {uri} ||
    ',"extraction_status":"success","extractor_version":"html_article_blocks_v1","images":[],"ingest_date":"' || ingest_date ||
    '","published_at":null,"requested_url":' || to_json(requested_url) ||
    ',"run_id":"run","schema_version":"article.extracted.v3","source_document_id":"' || source_document_id ||
    '","source_id":"' || source_id || '","source_payload_uri":"' || payload_uri || '","summary":null,"title":' ||
    to_json(title) || '}'"""


def _event(body, blocks, digest, uri):
    return (_EVENT.replace("{body}", body).replace("{blocks}", blocks).replace("{hash}", digest)
            .replace("{uri}", uri))


_BLOCKS = """'{"ordinal":0,"text":' || to_json(body) || ',"type":"paragraph"}'"""
_EVENTS = _RECORDS + f""",
good AS (SELECT *, sha256(encode(body)) AS body_hash FROM failing WHERE message IS NULL),
built AS (SELECT *, {stable_id('event', "'article.extracted.v3'", 'article_id', 'source_document_id', 'body_hash')}
  AS event_id FROM good),
whole AS (SELECT *, {_event('to_json(body)', _BLOCKS, "'null'", "'null'")} AS full_json FROM built),
sized AS (SELECT *, octet_length(encode(full_json)) + 5 AS full_bytes, sha256(encode(full_json)) AS digest FROM whole),
side AS (SELECT *, full_bytes > 2500 AS big, 'landing/extracted/source_id=' || source_id || '/ingest_date=' || ingest_date
  || '/article_id=' || article_id || '/source_document_id=' || source_document_id || '/extracted_payload_hash=' || digest
  AS uri FROM sized),
shown AS (SELECT *, CASE WHEN big THEN {_event("'\"\"'", "''", "'\"' || digest || '\"'", "'\"' || uri || '\"'")}
  ELSE full_json END AS json FROM side)"""

_MARKED = f"""list_filter(list_concat({_MARKER_LIST}, CASE p.source_id WHEN 'example.com' THEN ['casino']
    WHEN 'example.net' THEN ['<h1>Is '] ELSE [] END), lambda m: contains(lower(q.html), lower(m)))[1]"""

#: Every page's request: what its address answers and how the fetch ends.
_FETCH = PAGES + f""",
placed AS (SELECT * REPLACE (requested_url || CASE WHEN contains(requested_url, '?') THEN '&' ELSE '?' END || 'page=' || page_id
    AS requested_url) FROM landed),
titled AS (SELECT *, {stable_id('article', 'requested_url')} AS article_id FROM placed),
asked AS (SELECT p.*, p.page_id % 10 AS digit, q.page_id AS at_page, q.requested_url AS at_url, q.real_hash AS at_hash,
    q.payload AS at_payload, q.content_type AS at_type, {_MARKED} AS marker,
    regexp_extract({url_host('q.url')}, 'example\\.([a-z]+)$', 1) AS at_tld,
    CASE WHEN p.page_id % 29 = 7 THEN 'nowhere.example' ELSE p.source_id END AS event_source
  FROM titled p JOIN titled q ON q.page_id = CASE WHEN p.page_id % 10 = 1 THEN p.page_id - 1 ELSE p.page_id END),
judged AS (SELECT *, CASE
    WHEN page_id % 17 = 3 THEN ['dlq', 'ValueError', 'bad_framing']
    WHEN page_id % 23 = 5 THEN ['dlq', 'ValueError', 'missing fields: request_revision']
    WHEN page_id % 29 = 7 THEN ['dlq', 'ValueError', 'unknown source: nowhere.example']
    WHEN source_id = 'example.org' THEN ['dlq', 'ValueError', 'disabled source: example.org']
    WHEN NOT starts_with(requested_url, 'https://') THEN ['dlq', 'HttpFetchError', 'not_https']
    WHEN digit = 1 AND NOT starts_with(at_url, 'https://') THEN ['dlq', 'HttpFetchError', 'not_https']
    WHEN digit = 1 AND (at_tld = 'org' OR source_id = 'example.net' AND at_tld = 'com')
      THEN ['dlq', 'HttpFetchError', 'outside_domain']
    WHEN digit = 7 THEN ['retry', 'MalformedRedirect', 'malformed_redirect']
    WHEN digit = 3 THEN ['retry', 'HTTPStatusError', 'status 503']
    WHEN digit = 4 THEN ['dlq', 'HTTPStatusError', 'status 404']
    WHEN digit = 5 AND source_id = 'example.com' THEN ['dlq', 'SourceHttpPolicyBlocked', 'blocked status 428']
    WHEN digit = 5 THEN ['dlq', 'HTTPStatusError', 'status 428']
    WHEN octet_length(at_payload) > 4000 THEN ['dlq', 'HttpFetchError', 'too_large']
    WHEN at_type = 'application/json' THEN ['dlq', 'InvalidArticleDocument', 'not_html: application/json']
    WHEN marker IS NOT NULL THEN ['dlq', 'InvalidArticleDocument', 'marker: ' || marker]
    ELSE ['ok', NULL, NULL] END AS o FROM asked),
ended AS (SELECT *, {stable_id('source_doc', 'article_id', 'at_hash')} AS document FROM judged),
good AS (SELECT *, {stable_id('event', "'article.fetched.v2'", 'article_id', 'at_hash')} AS event_id,
    'landing/articles/source_id=' || source_id || '/ingest_date=' || ingest_date || '/article_id=' || article_id
      || '/source_document_id=' || document AS uri FROM ended WHERE o[1] = 'ok')"""

_TRIES = _FETCH + """,
-- a request to be tried again is one in both batches, and once more if it was repeated
runs AS (SELECT *, unnest(CASE WHEN page_id % 5 = 0 THEN [0, 1, 1] ELSE [0, 1] END) AS batch FROM ended WHERE o[1] = 'retry'),
-- HTTP attempts are made by requests that found no completion
fetches AS (SELECT *, CAST(0 AS BIGINT) AS batch FROM ended
  UNION ALL SELECT *, CAST(1 AS BIGINT) FROM ended WHERE o[1] = 'retry'
  UNION ALL SELECT *, CAST(1 AS BIGINT) FROM ended WHERE o[1] <> 'ok' AND page_id % 5 = 0),
again AS (SELECT *, unnest(CASE WHEN o[3] LIKE 'not_https%' OR o[2] = 'ValueError' OR o[3] = 'outside_domain' THEN []
    WHEN digit = 7 THEN [['MalformedRedirect', NULL], ['MalformedRedirect', NULL]]
    WHEN digit IN (2, 3) THEN [['HTTPStatusError', '503'], ['HTTPStatusError', '503']]
    WHEN digit = 6 THEN [['TransportError', NULL]] ELSE [] END) AS t FROM fetches)"""

SQL = {
    "route_flow_dead_letters": f"""WITH {_ROUTED} SELECT 'news.dlq.v1' AS schema_version,
        {stable_id('event', "'news.dlq.v1'", "'news.article_fetch_requested'", 'user_id % 3', 'event_id',
                   "'HTTPStatusError'", "'status ' || status")} AS event_id, {_AT} AS event_time,
        'news.article_fetch_requested' AS source_topic, CAST(user_id % 3 AS INTEGER) AS source_partition,
        event_id AS source_offset, 'HTTPStatusError' AS error_class, 'status ' || status AS error_message,
        '{{"failed_event":{{"encoding":"json","value":{{"event_id":' || event_id
          || '}}}},"service":"fetcher","stage":"article_fetch"}}' AS payload FROM routed WHERE route = 'dlq'""",
    "route_flow_retry_metrics": EVENT_SQL["retry_metric_emit"],
    "route_flow_sinks": f"""WITH {_ROUTED} SELECT event_id AS "offset", CASE route WHEN 'ok' THEN 'accepted'
        WHEN 'dlq' THEN 'dead' WHEN 'retry' THEN 'retries' ELSE 'parked' END AS sink FROM routed""",
    "fetch_flow_answers": f"""WITH {_FETCH}, rows AS (
        SELECT *, CAST(0 AS BIGINT) AS batch, CAST(2 * page_id AS BIGINT) AS "offset", CAST(1 AS BIGINT) AS attempts,
          'published' AS won FROM ended
        UNION ALL SELECT *, 1, 2 * page_id + 1, 1, 'already_processed' FROM ended WHERE page_id % 5 = 0
        UNION ALL SELECT *, 1, 2 * page_id, 2, '' FROM ended WHERE o[1] = 'retry')
      SELECT batch, "offset", attempts, CASE WHEN o[1] = 'ok' THEN won ELSE o[1] END AS status, o[2] AS error_class,
        o[3] AS error_message, CASE WHEN o[1] = 'ok' THEN document END AS source_document_id FROM rows""",
    "fetch_flow_events": f"""WITH {_FETCH} SELECT article_id AS message_key, event_id,
        sha256('{{"article_id":"' || article_id || '","content_hash":"' || at_hash || '","content_length_bytes":'
          || octet_length(at_payload) || ',"content_type":' || coalesce(to_json(nullif(at_type, '')), 'null') ||
          ',"event_id":"' || event_id || '","event_time":"2024-02-01T00:00:00.000000Z","fetch_status":"success",' ||
          '"fetched_at":"2024-02-01T00:00:00.000000Z","ingest_date":"' || ingest_date || '","payload_uri":"' || uri ||
          '","requested_url":' || to_json(requested_url) || ',"run_id":"run","schema_version":"article.fetched.v2",' ||
          '"source_document_id":"' || document || '","source_id":"' || source_id || '","status_code":200}}') AS json_sha256
      FROM good""",
    "fetch_flow_landing": f"""WITH {_FETCH} SELECT DISTINCT uri AS payload_uri, at_hash AS content_hash,
        CAST(octet_length(at_payload) AS INTEGER) AS payload_bytes FROM good""",
    "fetch_flow_states": f"""WITH {_FETCH} SELECT article_id, request_revision,
        CASE WHEN bool_or(o[1] = 'ok') THEN 'completed' ELSE 'open' END AS state
      FROM ended WHERE coalesce(o[3], '') NOT IN ('bad_framing', 'missing fields: request_revision') GROUP BY 1, 2""",
    "fetch_flow_retry_metrics": f"""WITH {_TRIES} SELECT metric_name, dimensions, count(*) AS observations FROM (
        SELECT 'consumer_retry_count' AS metric_name, '{{"error_class":"' || o[2] || '","partition":"' || (page_id % 3)
          || '","source_id":"' || event_source || '","stage":"article_fetch","topic":"news.article_fetch_requested"}}'
          AS dimensions FROM runs WHERE o[1] = 'retry'
        UNION ALL SELECT 'article_fetch_retry_count', '{{"error_class":"' || t[1] || '","source_id":"' || event_source
          || '","stage":"article_fetch"' || CASE WHEN t[2] IS NULL THEN '' ELSE ',"status_code":"' || t[2] || '"' END || '}}'
        FROM again) GROUP BY ALL""",
    "extract_flow_events": f"""WITH {_EVENTS} SELECT 'news.article_extracted' AS topic, article_id AS message_key, event_id,
        CAST(octet_length(encode(json)) + 5 AS INTEGER) AS inline_event_bytes, sha256(encode(json)) AS json_sha256 FROM shown""",
    "extract_flow_side_payloads": f"""WITH {_EVENTS} SELECT DISTINCT uri AS payload_uri, digest AS content_hash,
        CAST(full_bytes - 5 AS INTEGER) AS payload_bytes FROM shown WHERE big""",
    "extract_flow_dead_letters": f"""WITH {_RECORDS}, placed AS (SELECT *, 'news.article_fetched' AS topic,
          CAST(page_id % 3 AS INTEGER) AS "partition", CAST(page_id AS BIGINT) AS "offset" FROM failing
        WHERE message IS NOT NULL AND message <> 'missing_payload')
      SELECT {stable_id('event', "'news.dlq.v1'", 'topic', '"partition"', '"offset"', 'error_class', 'message')} AS event_id,
        '2024-02-01T00:00:00.000000Z' AS event_time, topic AS source_topic, "partition" AS source_partition,
        "offset" AS source_offset, error_class, message AS error_message,
        sha256('{{"failed_event":{{"encoding":"' || CASE WHEN message = 'bad_framing'
          THEN 'base64","value":"' || to_base64(encode(event_json)) || '"' ELSE 'json","value":' || event_json END
          || '}},"service":"extractor","stage":"' || stage || '"}}') AS payload_sha256
      FROM placed""",
    "extract_flow_retries": f"""WITH {_RECORDS} SELECT 'news.article_fetched' AS topic,
        CAST(page_id % 3 AS INTEGER) AS "partition", CAST(page_id AS BIGINT) AS "offset", event_source AS source_id,
        CAST(1 AS BIGINT) AS attempts, message AS error_message FROM failing WHERE message = 'missing_payload'""",
}
