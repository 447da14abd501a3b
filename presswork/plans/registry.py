"""All registered queries by name."""

from __future__ import annotations

from presswork.plans import (
    article_queries,
    event_queries,
    feed_queries,
    fetch_queries,
    flow_queries,
    metric_queries,
    scalar_queries,
    stream_queries,
)


def all_queries():
    out = {}
    for group in (metric_queries, scalar_queries, feed_queries, fetch_queries, event_queries,
                  article_queries, stream_queries, flow_queries):
        out.update(group.QUERIES)
    return out
