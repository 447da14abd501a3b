"""DuckDB texts for the metric queries."""

from checks.duck_views import COUNTS, PE

_POINTS = "SELECT CAST(d AS VARCHAR) AS day, name, value, 'count' AS unit, dimensions FROM counts"

OFFSETS = PE + """,
committed AS (
  SELECT group_id, topic, "partition",
    CASE WHEN group_id = 'group3' AND "partition" = 1 THEN -1 ELSE c END AS committed
  FROM (SELECT 'group' || (user_id % 5) AS group_id, 'news.' || topic_key AS topic, "partition",
          max("offset") FILTER (ts < TIMESTAMP '2024-01-25') AS c
        FROM pe GROUP BY ALL)),
latest AS (SELECT 'news.' || topic_key AS topic, "partition", max("offset") + 1 AS latest
  FROM pe GROUP BY ALL),
lag AS (SELECT group_id, topic, "partition", greatest(0, latest - committed) AS lag
  FROM committed JOIN latest USING (topic, "partition") WHERE committed >= 0),
totals AS (SELECT g.group_id, CAST(coalesce(sum(lag), 0) AS BIGINT) AS total_lag
  FROM (SELECT DISTINCT group_id FROM committed) g LEFT JOIN lag USING (group_id) GROUP BY ALL)"""

_NUMBERED = COUNTS + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY family, name, dimensions) AS position
  FROM counts)"""

SQL = {
    "fetch_success_count": f"WITH {COUNTS} {_POINTS} WHERE family = 1",
    "extraction_success_count": f"WITH {COUNTS} {_POINTS} WHERE family = 2",
    "rejected_and_dlq_count": f"WITH {COUNTS} {_POINTS} WHERE family IN (3, 4)",
    "observed_metric_sum": f"WITH {COUNTS} {_POINTS} WHERE family = 5",
    "metric_name_filter": f"""WITH {PE} SELECT event_id, CASE metric_name
        WHEN 'consumer_retry_count' THEN 'ConsumerRetryCount' ELSE 'ArticleFetchRetryCount' END AS metric_name
      FROM pe WHERE topic_key = 'pipeline_metric'
        AND metric_name IN ('consumer_retry_count', 'article_fetch_retry_count')""",
    "source_extraction_failure": f"""WITH {PE}
      SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, source_id,
        count(*) FILTER (topic_key = 'dlq' AND stage = 'article_extract') AS rejects
      FROM pe GROUP BY ALL
      HAVING rejects >= 3 AND count(*) FILTER (topic_key = 'article_extracted') = 0""",
    "metric_points": f"""WITH {COUNTS}, {OFFSETS[len(PE) + 1:]} {_POINTS}
      UNION ALL SELECT '2024-01-31', 'ConsumerGroupLag', CAST(lag AS DOUBLE), 'count',
        '{{"consumerGroup":"' || group_id || '","partition":"' || "partition" || '","topic":"' || topic || '"}}'
      FROM lag
      UNION ALL SELECT '2024-01-31', 'ConsumerGroupLagTotal', CAST(total_lag AS DOUBLE), 'count',
        '{{"consumerGroup":"' || group_id || '"}}' FROM totals""",
    "metric_points_sorted": f"WITH {COUNTS} {_POINTS} ORDER BY d, family, name, dimensions",
    "metric_batches": f"""WITH {_NUMBERED} SELECT CAST(d AS VARCHAR) AS day, name, dimensions,
        position, CAST((position - 1) // 50 AS BIGINT) AS batch FROM numbered""",
    "consumer_lag": f'WITH {OFFSETS} SELECT group_id, topic, "partition", lag FROM lag',
    "lag_totals": f"WITH {OFFSETS} SELECT group_id, total_lag FROM totals",
}
