"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rowsieve_checks import batch, loads  # noqa: E402
from rowsieve.sinks.tables import write_noop  # noqa: E402

HEADLINE = (
    "gold_office_stats",
    "valid_rows",
    "rejected_rows",
    "error_codes_array",
    "error_map_first",
    "error_map_full",
    "rejects_by_code",
    "expectation_metrics",
    "brand_stats",
    "order_rules",
    "masked_view",
    "clean_names",
    "clean_names_udf",
    "synthetic_people",
    "stream_split_ok",
    "split_store_ok",
    "stream_rescue",
    "strict_schema",
    "stream_gold",
    "clustered_table",
    "contract_gold",
    "layered_gold",
)
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def seconds(spark: SparkSession, query, sf_dir: str) -> float:
    """Best of RUNS after one warm-up; each run builds the query and computes every row."""
    best = float("inf")
    for attempt in range(RUNS + 1):
        started = time.monotonic()
        write_noop(query(spark, sf_dir))
        if attempt:
            best = min(best, time.monotonic() - started)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = {**batch.QUERIES, **loads.QUERIES}
    wanted = sys.argv[1:] or HEADLINE
    timings = {name: round(seconds(spark, queries[name], sf_dir), 3) for name in wanted}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
