"""Headline queries at one scale factor; prints a single JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"python bench.py all" times the whole catalogue.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from presswork.plans import catalog  # noqa: E402
from presswork.session import build_session  # noqa: E402

HEADLINE = [
    "journalist_stats", "stats_inconsistent", "stats_fix", "publisher_stats", "dedup_groups",
    "dedup_survivors", "feed_dedup", "url_exists_flag", "ingest_insert", "journalist_resolve",
    "article_with_journalist", "html_extract", "article_page_extract", "request_batches",
    "request_build", "result_strict_batches", "score_apply", "status_transition_audit",
    "daily_trend", "lexical_cues",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(catalog.QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Two untimed queries start the session's code paths.
    for name in ("publisher_stats", "journalist_stats"):
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
