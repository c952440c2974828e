"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma separated, or ``all``)
change the input, the cores, the timed runs per query and the choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from hazardlake.queries import QUERIES
from hazardlake.session import build_session

HEADLINE = [
    # classification, statistics and views of events
    "event_stats",
    "event_titles",
    "recent_events",
    "feed_window",
    "detail_table",
    "map_features",
    # nested documents
    "flatten_features",
    "latest_geometry",
    "flatten_indicators",
    "quake_silver",
    # indicator layers, series and directories
    "silver_panel",
    "gold_panel",
    "entity_year_mean",
    "indicator_series",
    "indicator_directory",
    "entity_directory",
    "lookup_names",
    "profile",
    # files and retention
    "run_batch",
    "partitioned_append",
    "expired_snapshots",
    # quality
    "schema_check",
    "quality_report",
    # streams
    "stream_quake_silver",
    "stream_all_outputs",
    "stream_quake_gold",
    "stream_volcano_gold_running",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE

    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
