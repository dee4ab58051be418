"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores, BENCH_QUERIES an optional
comma-separated choice of registered queries ("all" for every one).
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dockflow.session import build_session  # noqa: E402
from dockflow.sources import sinks  # noqa: E402
from parity.registry import QUERIES  # noqa: E402

HEADLINE = [
    "stg_rides",
    "rides_enriched",
    "station_daily_stats",
    "dim_stations",
    "fact_rides",
    "kpi_summary",
    "daily_trend",
    "dataset_overview",
    "rebalancing_list",
    "scenario_list",
    "hotspot_profile",
    "imbalance_trend",
    "station_flow",
    "station_day_flow",
    "ride_summary",
    "hourly_profile_pct",
    "duration_histogram",
    "mart_durations",
    "profile_rides",
    "quality_post_ingest",
    "quality_post_transform",
    "schema_tests_marts",
    "demand_features",
    "forecast_fallback",
    "write_fact",
    "stream_incremental",
    "segment_profile_k4",
]


def run(spark, name: str, folder: str) -> float:
    """Seconds from calling the query to having produced every row."""
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": os.environ.get("BENCH_WORK_DIR", str(Path("spark-warehouse/bench").resolve())),
        },
    )
    for warm in ("daily_trend", "rides_enriched", "dim_stations"):  # code paths are compiled outside the timings
        run(spark, warm, folder)
    seconds = {}
    for name in names:
        seconds[name] = round(run(spark, name, folder), 3)
        sinks.release(spark)  # what a query has stored for itself
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
