"""Session settings a single operation needs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, object]) -> Iterator[None]:
    """Run a block under ``settings`` and put back what was set before."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
