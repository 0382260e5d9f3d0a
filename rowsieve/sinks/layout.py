"""Files laid out by several columns at once, also those of tables that are loaded already.

A column's values become ranks among its approximate quantiles, and the ranks' bits are interleaved into one
key. Rows are range-partitioned and sorted by that key, so each file covers a small range of every column and
readers skip files by any of them. Quantiles come from a sketch of bounded size, whatever the input.

Loads keep their directories, which is what tables, replays and summaries know them by. Loads that have been
laid out are a number for each query; a call handles those that came after it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import quote_part
from rowsieve.operators.governance import base_of
from rowsieve.sinks.tables import DEFAULT_FORMAT, overwrite_table, set_clustering
from rowsieve.sources.files import as_schema, path_exists, read_text, remove, write_text
from rowsieve.streaming.loads import LOAD_COLUMN, committed_loads, replace_loads

#: Bits of a rank: so many quantiles are told apart.
BITS = 6
#: Equal keys are spread over so many ranges.
_SALTS = 1 << 16


def _as_number(column: Column, dtype: T.DataType) -> Column:
    """A number in the order of the values; of texts by their first bytes."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(dtype, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
        head = F.rpad(F.substring(F.hex(column.cast("binary")), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise ValueError(f"no layout by a column of type {dtype.simpleString()}")


def _rank(number: Column, bounds: Sequence[float]) -> Column:
    """How many of the bounds a number has reached; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    reached = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= number))
    return F.when(number.isNull(), F.lit(0)).otherwise(reached)


def interleaved_key(df: DataFrame, by: Sequence[str], *, bits: int = BITS) -> Column:
    """The key of a row: the interleaved bits of its ranks. NULL comes first. Reads ``df`` once for the quantiles."""
    if not by or bits * len(by) > 62:
        raise ValueError(f"a layout takes 1 to {62 // bits} columns")
    numbers = [_as_number(F.col(quote_part(name)), df.schema[name].dataType) for name in by]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    # A rank need not be exact: an accuracy of 1,000 tells the quantiles apart.
    found = df.agg(*[F.percentile_approx(n, shares, 1000).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    terms = []
    for i, number in enumerate(numbers):
        bounds = sorted(set(found[f"q{i}"] or ()))
        rank = _rank(number, bounds).cast("bigint")
        for bit in range(bits):
            place = bit * len(by) + len(by) - 1 - i
            terms.append(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), place))
    return reduce(add, terms)


def laid_out(df: DataFrame, by: Sequence[str], *, within: Sequence[str] = (), files: int | None = None) -> DataFrame:
    """``df`` in the order of its key, in ``files`` ranges or as many as AQE finds right; ``within`` comes first.

    ``df`` should be a scan: rows of one key are spread by their place in it, which a repeated task finds the same.
    """
    first = list(within)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(_SALTS))
    keyed = df.select("*", interleaved_key(df, by).alias("__key"), salt.alias("__salt"))
    order = [*first, "__key", "__salt"]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*first, "__key", *by).drop("__key", "__salt")


def lay_out_loads(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    by: Sequence[str],
    *,
    staging: str,
    partitions: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    rows_per_file: int | None = None,
) -> list[str]:
    """Lay out the committed loads of a sink that are not laid out by these columns yet, and give them.

    They are written beside the sink, in one pass, and then take their own places. A run that ends in
    between is finished by the next one. ``partitions`` are those inside a load, as of a split store.
    """
    path, staging, by = path.rstrip("/"), staging.rstrip("/"), list(by)
    note, ready = f"{path}/_layout.json", f"{staging}/ready.json"
    if path_exists(spark, ready):
        facts = read_text(spark, ready)
        replace_loads(spark, f"{staging}/rows", path)
        write_text(spark, note, facts)
    remove(spark, staging)
    known = json.loads(read_text(spark, note)) if path_exists(spark, note) else {}
    if known.get("by") != by:
        known = {"by": by, "loads": {}}
    loads, commits = committed_loads(spark, path, known["loads"])
    if not loads:
        return []
    inside = T.StructType([T.StructField(name, T.StringType()) for name in [LOAD_COLUMN, *partitions]])
    full = T.StructType([*as_schema(schema).fields, *inside.fields])
    rows = spark.read.format(fmt).schema(full).load(path).where(F.col(LOAD_COLUMN).isin(loads))
    files = None if rows_per_file is None else max(1, -(-rows.count() // rows_per_file))
    ordered = laid_out(rows, by, within=[LOAD_COLUMN, *partitions], files=files)
    ordered.write.format(fmt).partitionBy(LOAD_COLUMN, *partitions).save(f"{staging}/rows")
    facts = json.dumps({"by": by, "loads": {**known["loads"], **commits}})
    write_text(spark, ready, facts)
    replace_loads(spark, f"{staging}/rows", path)
    write_text(spark, note, facts)
    remove(spark, staging)
    return loads


def lay_out_table(spark: SparkSession, table: str, by: Sequence[str], *, files: int | None = None) -> None:
    """Lay out a table as a whole and record the columns; a table of loads is laid out by :func:`lay_out_loads`."""
    rows = spark.table(base_of(spark, table))
    overwrite_table(laid_out(rows, list(by), files=files), table)
    set_clustering(spark, table, list(by))
