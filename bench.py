"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is built and run in full (to a sink that discards the rows) once to
warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.entries import QUERIES  # noqa: E402
from stocktake.session import build_session  # noqa: E402

HEADLINE = [
    "rate_by_year",
    "rate_by_region",
    "rate_two_criteria",
    "role_playing_flow",
    "capture_mix",
    "quarantine_summary",
    "layer_stg_areas",
    "layer_stg_carga",
    "layer_stg_leituras",
    "layer_quarantine",
    "layer_fact",
    "dedup_keep_first",
    "dedup_keep_latest",
    "last_event_per_key",
    "bronze_as_of_compare",
    "batch_stats",
    "src_json_flatten",
    "txt_proper_name",
    "dq_report",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__driver__extraJavaOptions="-XX:+UseParallelGC",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="stocktake-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
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
