"""Grouped summaries and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def _number(df: DataFrame, value: str) -> Column:
    column = F.col(value)
    if isinstance(df.select(column).schema[0].dataType, T.StringType):
        return column.try_cast("double")
    return column


def grouped_stats(
    df: DataFrame,
    by: str | Sequence[str] = "office",
    value: str = "age",
    *,
    count_as: str = "total_employees",
    mean_as: str = "average_age",
    digits: int = 1,
) -> DataFrame:
    """Row count and rounded mean per group.

    A NULL key is a group of its own, NULL values are left out of the mean. Both aggregates
    are combined before the shuffle, so only one row per group and task travels.
    """
    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias(count_as),
        F.round(F.avg(_number(df, value)), digits).alias(mean_as),
    )


def partial_stats(df: DataFrame, by: str | Sequence[str], value: str) -> DataFrame:
    """Mergeable parts of :func:`grouped_stats` for one load of data."""
    number = _number(df, value)
    if not isinstance(df.select(number).schema[0].dataType, T.DecimalType):
        number = number.cast("double")  # a decimal keeps its digits
    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(number).alias("n_values"),
        F.sum(number).alias("sum_values"),
    )


def merge_stats(
    partials: DataFrame,
    by: str | Sequence[str] = "office",
    *,
    count_as: str = "total_employees",
    mean_as: str = "average_age",
    digits: int = 1,
) -> DataFrame:
    """The summary over all loads, out of their parts instead of out of all rows again."""
    mean = F.try_divide(F.sum("sum_values"), F.sum("n_values"))
    return partials.groupBy(*_keys(by)).agg(
        F.sum("n_rows").alias(count_as),
        F.round(mean, digits).alias(mean_as),
    )


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Global row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))
