"""All DuckDB texts by query name."""

from checks import article_sql, event_sql, feed_sql, fetch_sql, flow_sql, metric_sql, scalar_sql, stream_sql


def all_sql():
    out = {}
    for group in (metric_sql, scalar_sql, feed_sql, fetch_sql, event_sql, article_sql, stream_sql, flow_sql):
        out.update(group.SQL)
    return out
