"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Each query runs once to warm up
and is then timed over BENCH_RUNS full executions into a sink that discards its rows; the
best is reported. ``rows_per_sec`` relates the two layer steps to their input rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from stormgrid.checks import fixtures as fx
from stormgrid.checks.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "silver",
    "gold",
    "gold_orders",
    "risk_score",
    "silver_from_bronze",
    "quality_report",
    "dq_rule_counts",
    "join_cities",
    "coverage_manifest",
    "q1_hottest",
    "q2_wettest",
    "q3_riskiest_cities",
    "q4_riskiest_dates",
    "q5_worst_day_per_city",
    "kpis",
    "map_points",
    "risk_pivot",
    "detail_table",
    "upsert_dim",
    "upsert_fact",
    "history_latest",
    "constraint_violations",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    fx.bronze_folder(spark, SF_DIR)  # landing is a step of its own
    seconds = {}
    for name in HEADLINE:
        timed(spark, name)
        seconds[name] = round(min(timed(spark, name) for _ in range(RUNS)), 4)
    events = fx.events_base(spark, SF_DIR).count()
    orders = fx.orders_base(spark, SF_DIR).count()
    rates = {
        "silver": round(events / seconds["silver"]),
        "gold_orders": round(orders / seconds["gold_orders"]),
        "silver_from_bronze": round(events * fx.DAYS / seconds["silver_from_bronze"]),
        "risk_score": round(events / seconds["risk_score"]),
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
