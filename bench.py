"""Headline queries, timed. Prints one JSON line.

Each query runs once to warm up and then BENCH_REPEATS times; the median counts.
Results are consumed by a no-op sink, so every column is computed and nothing
is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from emberscan.session import build_session
from emberscan.showcase.queries import REGISTRY

HEADLINE = [
    "enrich_point_in_polygon",
    "daily_detection",
    "stage_batch",
    "stage_stream_dedup",
    "fct_detection",
    "upsert_fact",
    "append_unseen",
    "quality_fact",
    "coordinate_profile",
    "stream_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for turn in range(repeats + 1):
            started = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if turn:
                times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "hotspot_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
