"""Run the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import time

from pyspark.sql import SparkSession

from stackweave import session
from stackweave.plans import catalog

HEADLINE = (
    "samples_with_context",
    "snapshot_samples",
    "open_spans",
    "active_intervals",
    "function_times",
    "call_edges",
    "folded_stacks",
    "span_profiles",
    "profile_records",
    "profile_strings",
    "profile_locations",
    "profile_samples",
    "profile_labels",
    "profile_roundtrip",
    "decode_reports",
    "stream_activity",
    "stream_ticks",
    "stream_routes",
    "entry_spans",
    "selected_spans",
    "trace_volume",
    "flatten_scope_logs",
    "route_logs",
    "reports_complete",
    "report_packages",
    "effective_config",
    "config_report",
    "dependency_inventory",
    "catalogue",
)


REPEAT_UNTIL = 6.0  # seconds that a query may take in all before it is not run again
MOST_RUNS = 2


def machine_seconds(spark: SparkSession) -> float:
    """A fixed job, so that runs on machines of different speed can be compared."""
    start = time.perf_counter()
    spark.range(0, 60_000_000, 1, 16).selectExpr("sum(xxhash64(id, id % 7) % 1000)").collect()
    return round(time.perf_counter() - start, 3)


def seconds_of(spark: SparkSession, name: str, folder: str) -> float:
    """The less of two runs; long queries run once."""
    runs: list[float] = []
    while len(runs) < MOST_RUNS and sum(runs) < REPEAT_UNTIL:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - start)
    return round(min(runs), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session.local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    machine_seconds(spark)
    machine = machine_seconds(spark)
    seconds = {name: seconds_of(spark, name, folder) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": pathlib.Path(folder).name.removeprefix("sf"),
                "machine_seconds": machine,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
