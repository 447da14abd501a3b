"""DuckDB texts for the streaming queries: the same results in one go."""

from checks.article_sql import TEXT, _clean
from checks.duck_views import CRAWL, FRAMED, frame_verdict
from checks.event_sql import _KNOWN, SQL as EVENT_SQL
from checks.feed_sql import SQL as FEED_SQL
from checks.fetch_sql import _REQUESTS
from checks.metric_sql import SQL as METRIC_SQL

_TRIES = CRAWL + """, tries AS (SELECT 'news.article_fetch_requested' AS topic,
    CAST(user_id % 3 AS INTEGER) AS "partition", user_id * 10 + k % 10 AS "offset", event_id AS seq,
    status IN (408, 425, 429, 500, 503) AND NOT untyped AS again FROM crawl),
done AS (SELECT *, max(CASE WHEN NOT again THEN seq END) OVER (PARTITION BY "offset") AS done_at FROM tries)"""

SQL = {
    "stream_metric_flush": METRIC_SQL["metric_points_sorted"].split(" ORDER BY d,")[0],
    "stream_skip_malformed": f"""WITH {FRAMED} SELECT topic, count(*) AS consumed,
        count({frame_verdict(_KNOWN)}) AS skipped FROM framed GROUP BY topic""",
    "stream_three_way_route": f"SELECT event_id, route, advances FROM ({EVENT_SQL['three_way_route']})",
    "stream_retry_state": f"""WITH {_TRIES} SELECT topic, "partition", "offset", count(*) AS attempts,
        least(CAST(60 AS DOUBLE), pow(CAST(2 AS DOUBLE), count(*) - 1)) AS delay_seconds
      FROM done WHERE again AND (done_at IS NULL OR seq > done_at) GROUP BY 1, 2, 3""",
    "stream_feed_diff": FEED_SQL["feed_item_diff"],
    "stream_fetch_completion": f"""WITH {_REQUESTS} SELECT event_id, article_id, request_revision,
        CASE WHEN row_number() OVER (PARTITION BY article_id, request_revision ORDER BY event_id) = 1
          THEN 'published' ELSE 'already_processed' END AS status FROM requests""",
    "stream_extract": f"""WITH {TEXT} SELECT page_id, verdict,
        CASE WHEN verdict IS NULL OR verdict LIKE 'rejected%' OR verdict = 'no_title_or_body'
          THEN CAST(CASE WHEN chars >= 20 THEN 1 ELSE 0 END AS INTEGER) END AS blocks,
        CASE WHEN verdict IS NULL OR verdict = 'no_title_or_body' THEN sha256(encode(body)) END AS body_sha256
      FROM (SELECT *, CASE WHEN fetch_status = 'failed' THEN 'not_fetched'
          WHEN real_hash <> content_hash THEN 'hash_mismatch'
          WHEN source_id = 'example.org' THEN 'unsupported extractor: pdf_article'
          WHEN reason IS NOT NULL THEN 'rejected: ' || reason
          WHEN coalesce({_clean('raw_title')}, '') = '' THEN 'no_title_or_body' END AS verdict FROM judged)""",
    "multi_topic_scan": f"""SELECT topic, event_id, message_key FROM ({EVENT_SQL['route_events']})
      WHERE verdict IS NULL AND topic <> 'news.article_fetch_requested'""",
}
