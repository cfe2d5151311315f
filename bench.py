"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "agg1_daily_aggregates",
    "agg2_top_movies",
    "agg3_views_daily_merge",
    "agg4_events_per_hour",
    "agg7_daily_unique_users",
    "win1_rank_movies",
    "str4_incremental_daily_views",
    "str8_sessions",
    "jn1_order_lines_products",
    "jn3_order_with_items",
    "jn5_booking_reservation_recon",
    "agg13_order_total",
    "mkt3_promo_discount",
    "mkt4_promo_admission",
    "dq3_unique_keys",
    "jn8_orphans",
    "obs3_histogram_quantile",
    "obs8_request_log_stats",
    "ntf4_delivery_outcome",
    "ntf5_delivery_slis",
    "src5_decode_warehouse",
    "fold9_dispatch_outcome",
    "bkg1_reserve_seats",
    "obs7_alerts",
    "str7_dead_letter_split",
)


def main() -> None:
    from eventloom.plans.registry import all_queries
    from eventloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start the executors
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "fold_input_rows_per_sec": round(events / seconds["fold9_dispatch_outcome"]),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
