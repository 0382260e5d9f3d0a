"""The job that lands synthetic person records."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rowsieve.functions.people import random_people
from rowsieve.sinks.tables import write_json

# Row counts of the development and the performance dataset, and files per run.
DEVELOPMENT_ROWS = 1_000
PERFORMANCE_ROWS = 5_000_000
FILES = 10


def generate_people(
    spark: SparkSession,
    path: str,
    n_rows: int = DEVELOPMENT_ROWS,
    *,
    seed: int | None = None,
    mode: str = "append",
    files: int = FILES,
) -> None:
    """Land ``n_rows`` people as JSON lines in ``files`` files, seeded or new on every call.

    Each file is a task; for very many rows ask for as many files as the cluster has cores.
    """
    people = random_people(spark, n_rows, seed=seed, partitions=files)
    write_json(people, path, n_files=None, mode=mode)
