"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables (default sf0.1). BENCH_CPUS: local cores.
Each query's full result goes to the noop sink: everything is computed and
nothing is collected. Arguments, if any, name the queries to run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from presswork.plans.registry import all_queries  # noqa: E402
from presswork.session import local_session  # noqa: E402

HEADLINE = (
    "metric_points",
    "metric_batches",
    "source_extraction_failure",
    "feed_items_from_xml",
    "feed_change_status",
    "discovery_events_build",
    "feed_semantic_hash",
    "decode_framed_events",
    "dlq_event_build",
    "replay_eligibility",
    "redirect_chain",
    "document_validity",
    "extract_articles",
    "content_blocks",
    "extraction_gates",
    "oversize_split",
    "latest_per_stage",
    "article_content_select",
    "consumer_lag",
    "stream_three_way_route",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, "presswork-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = all_queries(), {}
    queries["topic_lookup"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": folder.rstrip("/").rsplit("/", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
