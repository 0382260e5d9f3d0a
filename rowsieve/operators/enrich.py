"""Columns added on the way in, and alignment to a declared schema."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import quote_part

# Name and format of the processing-time column.
TIME_COLUMN = "dt"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def add_processing_time(
    df: DataFrame,
    *,
    column: str = TIME_COLUMN,
    as_type: str = "string",
    fmt: str = TIME_FORMAT,
    at: datetime | None = None,
) -> DataFrame:
    """Add the processing time, as formatted text (session time zone) or as a timestamp.

    The value is constant within a query, and on a stream within a micro-batch; a batch that
    is replayed keeps its time. ``at`` fixes it for several queries over the same batch frame.
    """
    if as_type not in ("string", "timestamp"):
        raise ValueError(f"as_type must be 'string' or 'timestamp', not {as_type!r}")
    now = F.current_timestamp() if at is None else F.lit(at)
    return df.withColumn(column, F.date_format(now, fmt) if as_type == "string" else now)


def align(
    df: DataFrame, schema: T.StructType, *, strict: bool = False, lossless: bool = False
) -> DataFrame:
    """``df`` with the columns of ``schema`` in that order.

    A missing column becomes a typed NULL; extra columns follow at the end, or are dropped
    when ``strict``. Names match by the session's rule for case, also those inside nested values, which
    are rebuilt field by field. Values that do not fit the declared type become NULL; when ``lossless``,
    a type that does not widen to it, or a nested field that it lacks, is an error instead.
    """
    same = same_name(df.sparkSession)
    present = {same(field.name): field for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        found = present.get(same(field.name))
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        column = F.col(quote_part(found.name))
        columns.append(_fitted(column, found.dataType, field.dataType, found.name, same, lossless).alias(field.name))
    if not strict:
        declared = {same(name) for name in schema.names}
        columns += [F.col(quote_part(name)) for name in df.columns if same(name) not in declared]
    return df.select(*columns)


def _fitted(
    column: Column, found: T.DataType, wanted: T.DataType, where: str, same: Callable[[str], str], lossless: bool
) -> Column:
    """A value of type ``found`` as one of type ``wanted``."""
    if found == wanted:
        return column

    def inner(value: Column, one: T.DataType, other: T.DataType, part: str) -> Column:
        return _fitted(value, one, other, f"{where}.{part}", same, lossless)

    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        present = {same(field.name): field for field in found.fields}
        lost = present.keys() - {same(field.name) for field in wanted.fields}
        if lost and lossless:
            raise ValueError(f"column {where!r} has fields that are not in the table: {sorted(lost)}")
        parts = []
        for field in wanted.fields:
            own = present.get(same(field.name))
            value = F.lit(None).cast(field.dataType)
            if own is not None:
                value = inner(column.getField(own.name), own.dataType, field.dataType, own.name)
            parts.append(value.alias(field.name))
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: inner(x, found.elementType, wanted.elementType, "element"))
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType) and found.keyType == wanted.keyType:
        return F.transform_values(column, lambda k, v: inner(v, found.valueType, wanted.valueType, "value"))
    if lossless and not widens(found, wanted):
        kinds = f"{found.simpleString()} does not widen to {wanted.simpleString()}"
        raise ValueError(f"column {where!r}: {kinds}")
    return column.cast(wanted) if lossless else column.try_cast(wanted)


def joined_schema(
    one: T.StructType, other: T.StructType, same: Callable[[str], str] = str.lower, *, widen: bool = True
) -> T.StructType:
    """The schema that holds all rows of both: the fields of ``one``, then what only ``other`` has.

    A field of both has a type to which both widen, or without ``widen`` that of ``one``; nested types are
    joined inside. Types without one are an error (ValueError).
    """
    return _joined_struct(one, other, same, widen, "")


def _joined_struct(one: T.StructType, other: T.StructType, same: Callable[[str], str], widen: bool, where: str) -> T.StructType:
    more = {same(field.name): field for field in other.fields}
    fields = []
    for field in one.fields:
        match = more.pop(same(field.name), None)
        if match is None:
            fields.append(T.StructField(field.name, field.dataType, True, field.metadata))
            continue
        dtype = _joined_type(field.dataType, match.dataType, same, widen, f"{where}{field.name}")
        fields.append(T.StructField(field.name, dtype, field.nullable or match.nullable, field.metadata))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType, True, f.metadata) for f in more.values())])


def _joined_type(one: T.DataType, other: T.DataType, same: Callable[[str], str], widen: bool, where: str) -> T.DataType:
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return _joined_struct(one, other, same, widen, f"{where}.")
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        element = _joined_type(one.elementType, other.elementType, same, widen, f"{where}.element")
        return T.ArrayType(element, one.containsNull or other.containsNull)
    if isinstance(one, T.MapType) and isinstance(other, T.MapType) and one.keyType == other.keyType:
        value = _joined_type(one.valueType, other.valueType, same, widen, f"{where}.value")
        return T.MapType(one.keyType, value, one.valueContainsNull or other.valueContainsNull)
    if widens(other, one):
        return one
    if widens(one, other) and (widen or isinstance(one, T.NullType)):
        return other
    if not widen:
        raise ValueError(f"column {where!r}: {other.simpleString()} does not widen to {one.simpleString()}")
    common = _common_number(one, other)
    if common is None:
        raise ValueError(f"column {where!r}: {one.simpleString()} and {other.simpleString()} have no common type")
    return common


def _common_number(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type of which all values of two types are, where neither holds the other."""
    sizes = []
    for dtype in (one, other):
        if isinstance(dtype, T.DecimalType):
            sizes.append((dtype.precision - dtype.scale, dtype.scale))
        elif type(dtype) in _DIGITS:
            sizes.append((_DIGITS[type(dtype)], 0))
    if len(sizes) == 2:
        whole, scale = (max(x) for x in zip(*sizes))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    double = T.DoubleType()
    return double if widens(one, double) and widens(other, double) else None


def same_name(spark: SparkSession) -> Callable[[str], str]:
    """What column names are compared by."""
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return (lambda name: name) if sensitive else str.lower


_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if found == wanted or isinstance(found, T.NullType):
        return True
    digits = _DIGITS.get(type(found))
    if digits is not None:
        if type(wanted) in _DIGITS:
            return digits <= _DIGITS[type(wanted)]
        if isinstance(wanted, T.DecimalType):
            return wanted.precision - wanted.scale >= digits
        return isinstance(wanted, T.DoubleType) and digits <= 10 or isinstance(wanted, T.FloatType) and digits <= 5
    if isinstance(found, T.DecimalType) and isinstance(wanted, T.DecimalType):
        whole = wanted.precision - wanted.scale >= found.precision - found.scale
        return whole and wanted.scale >= found.scale
    if isinstance(found, T.FloatType):
        return isinstance(wanted, T.DoubleType)
    return isinstance(found, (T.CharType, T.VarcharType)) and isinstance(wanted, T.StringType)
