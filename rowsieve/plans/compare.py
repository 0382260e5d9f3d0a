"""Python UDF against native expressions, timed on Spark."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.functions.text import clean_name, clean_name_udf
from rowsieve.sinks.tables import write_noop

COMPARISON_SCHEMA = "variant STRING, row_count BIGINT, seconds DOUBLE, speedup DOUBLE"


def compare_cleaning(
    df: DataFrame, column: str = "name", *, runs: int = 3, warm_up: bool = True
) -> DataFrame:
    """``variant, row_count, seconds, speedup`` of cleaning ``column`` in each variant.

    Every variant is computed in full into the no-op sink; ``seconds`` is the best of ``runs``
    after a warm-up, ``speedup`` relates it to the row-at-a-time UDF.
    """
    variants = {
        "python_udf": clean_name_udf()(F.col(column)),
        "arrow_udf": clean_name_udf(arrow=True)(F.col(column)),
        "native": clean_name(column),
    }
    seconds = {}
    for name, cleaned in variants.items():
        frame = df.withColumn("processed_name", cleaned)
        timings = []
        for _ in range(runs + int(warm_up)):
            started = time.monotonic()
            write_noop(frame)
            timings.append(time.monotonic() - started)
        seconds[name] = min(timings[int(warm_up) :])
    count = df.count()
    baseline = seconds["python_udf"]
    rows = [(name, count, took, baseline / took) for name, took in seconds.items()]
    return df.sparkSession.createDataFrame(rows, COMPARISON_SCHEMA)
