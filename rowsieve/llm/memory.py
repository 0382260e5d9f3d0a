"""Memory that Python workers hold between tasks, and disk that finished steps hold.

Spark keeps workers for later tasks, and several per core where a stage has more than one Python
step. What a task has freed stays with the allocators unless they are asked to give it back.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession


@functools.cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # there is one in glibc


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def let_go(spark: SparkSession) -> None:
    """Have Spark delete shuffle files behind tables that are written by now.

    It does so when the driver's JVM finds that nothing refers to them, which may be long after.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over a task's batches, giving back freed memory when it is done."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return tidied


def tidy_batch(work: Callable) -> Callable:
    """``work`` on the columns of a batch, giving back freed memory after each."""

    @functools.wraps(work)
    def tidied(*columns: pa.Array) -> pa.Array:
        try:
            return work(*columns)
        finally:
            give_back()

    return tidied


def tidy_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on the rows of a group, giving back freed memory when all that it made is let go."""

    def tidied(rows: pa.Table) -> pa.Table:
        try:
            return work(rows)
        finally:
            give_back()

    return tidied


def tidy_cogroup(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """:func:`tidy_group` for the rows of two frames."""

    def tidied(rows: pa.Table, others: pa.Table) -> pa.Table:
        try:
            return work(rows, others)
        finally:
            give_back()

    return tidied
