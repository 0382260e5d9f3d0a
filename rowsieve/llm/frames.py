"""Small helpers on DataFrames that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.scratch import new_dir


def column(df: DataFrame, name: str):
    """The column of this name, whatever characters the name has."""
    return df["`" + name.replace("`", "``") + "`"]


def texts(df: DataFrame, id_col: str, text_col: str, *, id_name: str = "doc_id") -> DataFrame:
    """Only the id and the text, under fixed names, so that other columns cannot clash."""
    return df.select(column(df, id_col).alias(id_name), column(df, text_col).cast("string").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows below the shared folder and read them back: cuts lineage, survives lost executors."""
    return placed_table(df, purpose)[0]


def placed_table(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """:func:`table`, and its place, for one that is deleted once others are made from it."""
    spark = df.sparkSession
    place = new_dir(spark, purpose)
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place), place


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(name: str, mod: int):
    """crc32 of an id as text, modulo ``mod``; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % mod
