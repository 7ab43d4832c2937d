"""Time the headline queries and a prune; prints one JSON line.

Every query runs BENCH_RUNS times and its fastest run counts, as the first
run of a plan also pays for compiling it; ``first_run_value`` is the sum of
the first runs. The logs that the questions are about are derived from the
given tables and written to files first; ``writing_logs`` is what that took.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_RUNS (2), BENCH_PRUNE_COPIES (20), BENCH_QUERIES (comma-separated names,
default the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.catalog import EVENTS, QUERIES, RETENTION  # noqa: E402
from tidelog.operators import tiering  # noqa: E402
from tidelog.session import configure, scratch_dir  # noqa: E402
from tidelog.sources import bindings, store  # noqa: E402

HEADLINE = (
    "orders_current",
    "order_items_current",
    "orders_unified",
    "sales_velocity",
    "top_products",
    "conversion_funnel",
    "high_value_new_customers",
    "order_bursts",
    "demand_surge",
    "low_stock",
    "abandoned_carts",
    "ltv_by_country",
    "propagation_latency",
    "event_volume",
    "unified_full",
    "status_mix_at_version",
    "status_mix_as_of",
    "kept_after_prune",
    "uncovered_rows",
    "lifecycle_audit",
    "ingest_events",
    "streamed_hot_log",
    "streamed_state",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidelog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def prune_rate(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Rows a second of one prune: cutoff, gate, report, drop.

    The hot store holds the event log BENCH_PRUNE_COPIES times over, about two
    million rows at sf0.1. Loading the stores beforehand is not counted.
    """
    copies = int(os.environ.get("BENCH_PRUNE_COPIES", "20"))
    hot, cold = scratch_dir(spark, "hot"), scratch_dir(spark, "cold")
    store.bulk_load(bindings.repeated_log(spark, sf_dir, copies), hot)
    store.bulk_load(bindings.event_archive(spark, sf_dir), cold)
    archive = store.read_cold(spark, cold)
    start = time.perf_counter()
    report = tiering.prune(spark, hot, archive, EVENTS, RETENTION).first()
    seconds = time.perf_counter() - start
    return {
        "rows_before": report.rows_before,
        "rows_deleted": report.rows_deleted,
        "seconds": round(seconds, 3),
        "rows_per_sec": round(report.rows_deleted / seconds),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    start = time.perf_counter()
    bindings.materialise(spark, sf_dir)  # the questions are timed on written logs
    written = time.perf_counter() - start
    run(spark, sf_dir, "conversion_funnel")  # load classes before timing
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    timed = {name: [run(spark, sf_dir, name) for _ in range(runs)] for name in names}
    seconds = {name: round(min(times), 3) for name, times in timed.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run_value": round(sum(times[0] for times in timed.values()), 3),
                "writing_logs": round(written, 3),
                "prune": prune_rate(spark, sf_dir),
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
