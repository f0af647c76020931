"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daygrain.plans.queries import QUERIES  # noqa: E402
from daygrain.session import build_session  # noqa: E402

HEADLINE = (
    "moving_avg",
    "temp_anomaly",
    "rolling_precip",
    "dry_spell",
    "moving_avg_ship",
    "temp_anomaly_ship",
    "rolling_precip_ship",
    "dry_spell_ship",
    "trend_deviation_ship",
    "sigma_flags",
    "temp_ranks_ship",
    "rain_streaks_ship",
    "compare_series",
    "weather_descriptions",
    "upsert_observations",
    "forecast_ship",
    "forecast_metrics",
    "final_series",
    "snapshot_timestamp",
    "snapshot_check",
    "climate_profile",
    "temp_distribution_ship",
    "monthly_averages_ship",
)


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = None if cpus == "*" else int(cpus)
    spark = build_session("bench", f"local[{cpus}]", partitions, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(data_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
