"""Times the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_QUERIES (comma-separated names, or ``all``)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from roadpulse.plans.catalog import queries  # noqa: E402
from roadpulse.session import local_session  # noqa: E402

HEADLINE = (
    "normalise_events", "gold_region", "gold_authority", "gold_road", "gold_all", "merge_gold_partials",
    "clean_counts", "segment_catalogue", "road_hour_profile", "road_profile", "region_profile", "region_road_share",
    "minute_totals", "welford_single_batch", "runtime_road_profile", "predict",
    "trailing_window", "window_kpis", "minute_series", "top_roads_by_volume", "latest_per_road", "road_edges",
    "forecast_5min", "worst_prediction", "batch_increment",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    all_queries = queries()
    names = list(all_queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "roadpulse-bench")
    # One small query first, so that starting the engine is not billed to the first name.
    all_queries["minute_totals"](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # Every row and column is computed; nothing reaches the driver.
        all_queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
