"""Headline queries, timed end to end; prints one JSON line.

Every query runs in full into a sink that discards its rows. A few queries at the smallest scale warm
the session up before the clock starts. All queries run $BENCH_RUNS times (3), and each one's median counts. Beside it
stands the time that DuckDB takes for the query's SQL on the same files and threads, into a table in memory.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterline.queries import REGISTRY  # noqa: E402
from meterline.session import build_session  # noqa: E402
from tools.compare import connect  # noqa: E402

HEADLINE = [
    "monthly_revenue",
    "monthly_zone_mart",
    "daily_report",
    "staged_trips",
    "unified_trips",
    "trip_fact",
    "vendor_dim",
    "max_per_day",
    "takings_one_day",
    "two_role_inner_max",
    "zones_fewest_trips",
    "longest_hours",
    "price_by_brand",
    "top_values_by_parent",
    "summary_counts",
    "base_ids",
    "base_ids_arrow",
    "wide_rollout",
    "latest_rows",
    "first_rows",
    "distinct_by_group",
    "natural_keys",
    "two_roles_left",
    "rows_without_match",
    "qc_rows",
    "qc_unique_combination",
    "profile",
    "nested_child",
    "nested_grandchild",
    "csv_fixed_schema",
    "insert_only_merge",
    "upsert_merge",
    "raw_file_load",
    "raw_file_load_green",
    "raw_file_load_warehouse",
    "month_archive",
    "fact_incremental",
    "staged_load",
    "daily_report_load",
    "interval_replaced",
    "watermark_increment",
    "delete_insert",
    "stream_file_load",
    "topk_cosine",
    "tip_regression",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def timed_sql(con, name: str) -> float:
    start = time.perf_counter()
    con.execute(f"CREATE OR REPLACE TEMP TABLE timed AS {REGISTRY[name].sql}")
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("monthly_revenue", "latest_rows", "base_ids_arrow"):
            timed(spark, name, warm)
    runs = [
        {name: timed(spark, name, sf_dir) for name in names}
        for _ in range(int(os.environ.get("BENCH_RUNS", "3")))
    ]
    times = {name: median(run[name] for run in runs) for name in names}
    con = connect(sf_dir)
    con.execute(f"SET threads = {cpus}")
    other = {name: timed_sql(con, name) for name in names if REGISTRY[name].sql}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "duckdb": other,
                "runs": len(runs),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
