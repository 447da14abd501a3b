"""DuckDB texts for bus, dead-letter and lookup queries."""

from checks.duck_views import CRAWL, FRAMED, PE, frame_verdict, stable_id

_ID = "CASE WHEN length(h) >= 10 THEN CAST('0x' || substr(h, 3, 8) AS BIGINT) END"
_KNOWN = """list_contains(CASE topic WHEN 'news.article_fetched' THEN [1, 2, 3]
  WHEN 'news.article_extracted' THEN [1, 2] WHEN 'news.dlq' THEN [1, 2, 3, 4]
  WHEN 'news.pipeline_metric' THEN [1, 4] ELSE [] END, CAST('0x' || substr(h, 3, 8) AS BIGINT))"""
_SCHEMA = """CASE {0} WHEN 'article_fetched' THEN 'article.fetched.v2'
  WHEN 'article_extracted' THEN 'article.extracted.v3' WHEN 'dlq' THEN 'news.dlq.v1'
  WHEN 'article_fetch_requested' THEN 'article.fetch_requested.v3'
  WHEN 'pipeline_metric' THEN 'pipeline.metric_observed.v1' END"""

DLQ = PE + f""",
letters AS (SELECT *, 'dlq_' || event_id AS id, 'news.' || failed_topic AS source_topic,
    CASE WHEN k % 7 = 0 THEN 'other.v9' ELSE {_SCHEMA.format('failed_topic')} END AS version
  FROM (SELECT *, ['article_fetched', 'article_extracted', 'dlq', 'article_fetch_requested',
      'pipeline_metric'][CAST((k + event_id) % 5 + 1 AS INTEGER)] AS failed_topic
    FROM pe WHERE topic_key = 'dlq')),
judged AS (SELECT *, CASE WHEN failed_topic = 'dlq' THEN 'dlq_to_dlq'
    WHEN k % 10 = 6 THEN 'no_failed_event' WHEN k % 10 = 7 THEN 'not_json_encoded'
    WHEN k % 10 = 8 THEN 'value_not_object' WHEN k % 7 = 0 THEN 'schema_mismatch'
    WHEN k % 11 = 0 AND failed_topic <> 'pipeline_metric' THEN 'invalid_event' END AS verdict
  FROM letters)"""

_STAGE = "CASE topic_key WHEN 'article_fetched' THEN 'fetched' ELSE 'extracted' END"
_STAGED = PE + f""", staged AS (SELECT *, {_STAGE} AS lookup FROM pe
  WHERE topic_key IN ('article_fetched', 'article_extracted'))"""
_TS = "'%Y-%m-%d %H:%M:%S.%f'"
_AT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"

_ROUTED = CRAWL + """, routed AS (SELECT *, CASE WHEN status = 200 THEN 'ok' WHEN untyped THEN 'stop'
  WHEN status IN (408, 425, 429, 500, 503) THEN 'retry' ELSE 'dlq' END AS route FROM crawl)"""

SQL = {
    "decode_framed_events": f"""WITH {FRAMED} SELECT topic, "offset", {_ID} AS schema_id, verdict,
        CASE WHEN verdict IS NULL THEN json_extract_string(body, '$.article_id') END AS article_id
      FROM (SELECT *, {frame_verdict()} AS verdict FROM framed)""",
    "schema_id_allowlist": f"""WITH {FRAMED} SELECT topic, coalesce(verdict, 'decoded') AS verdict,
        count(*) AS records FROM (SELECT *, {frame_verdict(_KNOWN)} AS verdict FROM framed) GROUP BY 1, 2""",
    "schema_unknown": f"""WITH {FRAMED} SELECT DISTINCT topic, {_ID} AS schema_id FROM framed
      WHERE {_ID} > 0 AND NOT {_KNOWN}""",
    "encode_framed_events": f"""WITH {PE} SELECT event_id, j AS json,
        CAST(octet_length(encode(j)) + 5 AS INTEGER) AS wire_bytes,
        sha256(from_hex('00' || lpad(hex(k + 1), 8, '0')) || encode(j)) AS frame_sha256
      FROM (SELECT *, '{{"article_id":"' || article_id || '","k":' || k || ',"note":'
        || CASE WHEN k % 2 = 0 THEN '"say \\"é\\""' ELSE 'null' END
        || ',"source_id":"' || source_id || '"}}' AS j FROM pe)""",
    "route_events": f"""WITH {PE} SELECT event_id,
        CASE WHEN k <> 99 THEN 'news.' || topic_key END AS topic,
        CASE WHEN k = 99 THEN NULL WHEN topic_key LIKE 'article%' THEN article_id
          WHEN topic_key = 'dlq' THEN 'news.dlq:' || CASE WHEN k % 4 = 0 THEN '' ELSE CAST("partition" AS VARCHAR) END
            || ':' || CASE WHEN k % 6 = 0 THEN '' ELSE CAST("offset" AS VARCHAR) END
          ELSE service || ':' || metric_name END AS message_key,
        CASE WHEN k = 99 THEN 'unsupported_event' END AS verdict FROM pe""",
    "topic_lookup": f"""WITH {PE} SELECT event_id, 'news.' || topic_key AS topic, topic_key,
        {_SCHEMA.format('topic_key')} AS schema_version FROM pe""",
    "metric_event_build": f"""WITH {PE} SELECT 'pipeline.metric_observed.v1' AS schema_version,
        {stable_id('event', "'pipeline.metric_observed.v1'", 'service', 'metric_name', _AT)} AS event_id,
        {_AT} AS event_time, service, metric_name, value AS metric_value, 'count' AS metric_unit,
        '{{"attempt":"' || k || '","stage":"' || stage || '"}}' AS dimensions FROM pe""",
    "run_log_rows": f"""WITH {CRAWL} SELECT level, '{{"class":"' || class || '","error_message":'
        || CASE WHEN class = 'ok' THEN 'null' ELSE '"status ' || status || '"' END
        || ',"event":"article_fetch_completed","event_id":' || event_id || ',"level":"' || level
        || '","service":"fetcher","source_id":"' || source_id || '","status":' || status
        || ',"timestamp":"2024-02-01T00:00:00.000000Z"}}' AS entry
      FROM (SELECT *, CASE class WHEN 'ok' THEN 'info' WHEN 'retryable' THEN 'warning' ELSE 'error' END AS level
        FROM (SELECT *, CASE WHEN status = 200 THEN 'ok' WHEN status IN (408, 425, 429, 500, 503)
          THEN 'retryable' ELSE 'permanent' END AS class FROM crawl))""",
    "dlq_event_build": f"""WITH {FRAMED} SELECT 'news.dlq.v1' AS schema_version,
        {stable_id('event', "'news.dlq.v1'", 'topic', '"partition"', '"offset"', "'ValueError'", 'verdict')}
          AS event_id, '2024-02-01T00:00:00.000000Z' AS event_time, topic AS source_topic,
        "partition" AS source_partition, "offset" AS source_offset, 'ValueError' AS error_class,
        verdict AS error_message,
        '{{"failed_event":{{"encoding":"' || CASE WHEN plain IS NULL THEN 'json","value":' || body
          ELSE 'base64","value":"' || to_base64(coalesce(from_hex(h), ''::BLOB)) || '"' END
          || '}},"service":"fetcher","stage":"event_decode"}}' AS payload
      FROM (SELECT *, {frame_verdict(_KNOWN)} AS verdict, {frame_verdict()} AS plain FROM framed)
      WHERE verdict IS NOT NULL""",
    "dlq_source_stage": f"""WITH {DLQ} SELECT id AS event_id,
        CASE WHEN k % 10 < 6 THEN source_id ELSE 'unknown' END AS source_id,
        CASE WHEN k % 10 = 9 THEN 'unknown' ELSE stage END AS stage FROM letters""",
    "replay_eligibility": f"""WITH {DLQ} SELECT id AS event_id, source_topic,
        failed_topic AS replay_topic_key,
        CASE WHEN k % 10 IN (6, 7, 8) THEN NULL ELSE version END AS failed_schema, verdict FROM judged""",
    "dlq_take_n": f"""WITH {DLQ} SELECT id AS event_id, "partition" AS source_partition,
        "offset" AS source_offset FROM letters ORDER BY "partition", "offset", source_topic LIMIT 25""",
    "dlq_disposition": f"""WITH {DLQ} SELECT id AS event_id, source_topic,
        "partition" AS source_partition, "offset" AS source_offset, error_class, 'desk' AS operator_id,
        action AS disposition_action,
        CASE action WHEN 'replay' THEN 'source fixed' WHEN 'commit' THEN 'not needed' END AS disposition_reason,
        action <> 'inspect' AS committed,
        CASE WHEN action = 'replay' THEN failed_topic END AS replayed_topic_key,
        CAST(NULL AS VARCHAR) AS verdict
      FROM (SELECT *, CASE WHEN verdict IS NULL THEN 'replay' WHEN error_class = 'ValueError' THEN 'commit'
        ELSE 'inspect' END AS action FROM judged)""",
    "stage_union": f"WITH {_STAGED} SELECT event_id, article_id, lookup AS stage FROM staged",
    "latest_per_stage": f"""WITH {_STAGED} SELECT article_id, lookup AS stage, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id, lookup
          ORDER BY ts DESC, "partition", "offset") AS nth FROM staged) WHERE nth = 1""",
    "time_range_read": f"""WITH {PE} SELECT event_id, topic_key, article_id FROM pe
      WHERE ts >= TIMESTAMP '2024-01-10' AND article_id = 'article_13_3'""",
    "article_lineage": f"""WITH {_STAGED} SELECT article_id,
        count(*) FILTER (lookup = 'fetched') AS fetched, count(*) FILTER (lookup = 'extracted') AS extracted,
        strftime(min(ts) FILTER (lookup = 'fetched'), {_TS}) AS first_fetched,
        strftime(max(ts) FILTER (lookup = 'extracted'), {_TS}) AS last_extracted
      FROM staged GROUP BY article_id""",
    "record_summary": f"""WITH {_STAGED} SELECT lookup AS stage, 'news.' || topic_key AS topic, "partition",
        "offset", event_id, source_id, article_id, CAST(k % 5 AS INTEGER) AS block_count,
        CAST(k % 3 AS INTEGER) AS image_count FROM staged WHERE lookup = 'extracted'""",
    "article_content_select": """SELECT 'a' || doc_id AS article_id, 'extracted' AS stage, text AS content,
        CAST(NULL AS VARCHAR) AS verdict FROM documents UNION ALL
      SELECT CASE WHEN page_id % 2 = 0 THEN 'a' ELSE 'p' END || page_id, 'fetched', html, NULL FROM pages
      WHERE page_id % 2 = 1 OR page_id NOT IN (SELECT doc_id FROM documents)""",
    "three_way_route": f"""WITH {_ROUTED} SELECT event_id, route, route IN ('ok', 'dlq') AS advances,
        CASE WHEN status = 200 THEN NULL WHEN untyped THEN 'unexpected' ELSE 'article_fetch' END AS stage
      FROM routed""",
    "retry_metric_emit": f"""WITH {_ROUTED} SELECT 'pipeline.metric_observed.v1' AS schema_version,
        {stable_id('event', "'pipeline.metric_observed.v1'", "'fetcher'", "'consumer_retry_count'", _AT)}
          AS event_id, {_AT} AS event_time, 'fetcher' AS service, 'consumer_retry_count' AS metric_name,
        CAST(1 AS DOUBLE) AS metric_value, 'count' AS metric_unit,
        '{{"error_class":"HTTPStatusError","partition":"' || (user_id % 3)
          || '","source_id":"' || source_id || '","stage":"article_fetch","topic":"news.article_fetch_requested"}}'
          AS dimensions FROM routed WHERE route = 'retry'""",
}
