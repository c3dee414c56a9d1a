"""Time the named queries over a folder of tables; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local session (default 8)
BENCH_RUNS     timed runs of a batch query after one warm-up (default 3); a
               streaming query is timed once, as every run starts from nothing
BENCH_QUERIES  names to run, separated by commas (default: the headline list)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.registry import QUERIES
from tidemark.session import build_session, clear_scratch

BATCH = [
    "genre_daily_kpis", "hourly_kpis", "top_songs", "transaction_metrics", "user_metrics",
    "location_performance", "vehicle_type_performance", "category_wise_summary", "daily_order_summary",
    "daily_fares", "user_discounts", "clickstream_enriched", "merge_update_all", "merge_column_subset",
    "delete_then_insert", "put_latest_items", "patch_attributes", "generated_ids", "dim_apartments", "dim_users",
    "raw_viewings", "fact_apartment_viewings", "lakehouse_orders", "high_water_mark_load", "genre_report_upsert",
    "track_report_patch", "validated_rows",
]
STREAMING = [
    "music_metrics", "signal_strength_by_operator", "gps_precision_by_provider", "status_count",
    "clickstream_stream", "derived_event_emit", "trip_lifecycle", "trip_correlation_stream", "ingest_and_archive",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or BATCH + STREAMING
    spark = build_session("tidemark-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name in names:
        first = seconds(spark, name, sf_dir)
        again = [seconds(spark, name, sf_dir) for _ in range(0 if name in STREAMING else runs)]
        timed[name] = round(statistics.median(again or [first]), 3)
        print(f"{name} {timed[name]}", file=sys.stderr)
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "shuffle_partitions": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
