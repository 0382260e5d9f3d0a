"""Synthetic person records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record's schema and the distribution of the generated data.
PERSON_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), True),
        T.StructField("age", T.IntegerType(), True),
        T.StructField("office", T.StringType(), True),
    ]
)
NAME_PREFIX = "User_"
MISSING_SHARE = 0.1
YOUNGEST = 10
AGE_SPAN = 75
OFFICES = ("MADRID", "RIO")


def _person_columns(id_column: str, draws: list[Column]) -> list[Column]:
    no_age, age, no_office, office = draws
    return [
        F.concat(F.lit(NAME_PREFIX), F.col(id_column).cast("string")).alias("name"),
        F.when(no_age < MISSING_SHARE, F.lit(None).cast("int"))
        .otherwise((age * AGE_SPAN + YOUNGEST).cast("int"))
        .alias("age"),
        F.when(no_office < MISSING_SHARE, F.lit(""))
        .when(office < 0.5, F.lit(OFFICES[0]))
        .otherwise(F.lit(OFFICES[1]))
        .alias("office"),
    ]


def people_from_ids(ids: DataFrame, id_column: str = "id", *, seed: int = 42) -> DataFrame:
    """A person per id. The four draws are the 32-bit words of one digest of (seed, id), so a
    row depends on its id alone: re-runs, other partitionings and retried tasks give the same
    people."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    draws = [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)
        for k in range(4)
    ]
    return ids.select(*_person_columns(id_column, draws))


def random_people(
    spark: SparkSession, n_rows: int, *, seed: int | None = None, partitions: int | None = None
) -> DataFrame:
    """``n_rows`` people from a range with Spark's generator; seeded when ``seed`` is given."""
    draws = [F.rand() if seed is None else F.rand(seed + k) for k in range(4)]
    ids = spark.range(0, n_rows, 1, partitions)
    return ids.select(*_person_columns("id", draws))
