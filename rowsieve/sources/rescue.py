"""JSON lines under a fixed schema, keeping what the schema cannot hold."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import LEFTOVER_METADATA, quote_part
from rowsieve.sources.files import Schema, as_schema, bounded, normalise_path

# Fixed value: the usual name of the column with the rescued values.
RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def _typed(name: str) -> Column:
    return F.col(f"_typed.{quote_part(name)}")


def _nested(schema: T.StructType) -> list[str]:
    """Fields that hold further values."""
    kinds = (T.StructType, T.ArrayType, T.MapType)
    return [field.name for field in schema.fields if isinstance(field.dataType, kinds)]


def _canonical(document: Column) -> Column:
    """A JSON text with sorted keys, without white space and without nulls."""
    text = F.to_json(F.try_parse_json(document))
    text = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*":null,?', "")
    return F.regexp_replace(text, r",(?=[}\]])", "")


def _changed(name: str, options: Mapping[str, str]) -> Column:
    """Whether a nested value does not come back from its typed form as it was."""
    typed = _canonical(F.to_json(_typed(name), dict(options)))
    return ~_canonical(F.col("_raw")[name]).eqNullSafe(typed)


def _kept(schema: T.StructType, options: Mapping[str, str]) -> Column:
    """The names of fields whose values are whole in the typed row."""
    nested = _nested(schema)
    lost = [_typed(name).isNull() | (_changed(name, options) if name in nested else F.lit(False)) for name in schema.names]
    kept = F.array(*[F.when(gone & F.lit(name != ""), F.lit("")).otherwise(F.lit(name)) for name, gone in zip(schema.names, lost, strict=True)])
    return kept if "" in schema.names else F.array_remove(kept, "")


def _lost(kept: Column) -> Column:
    """The entries of the raw map that have a value, and none of the ``kept`` names."""
    return F.map_filter("_raw", lambda key, value: value.isNotNull() & ~F.array_contains(kept, key))


def _without_fractions(text: Column, schema: T.StructType) -> Column:
    """The line, with fractions where the schema has whole numbers under a name that is not read.

    The parser throws (and builds a message and traces for) each value it cannot take, which costs more than the
    rest of a line, and fractions are the ones that come for all lines at once. Only lines are changed
    whose quotes surely delimit keys and values: flat objects without escapes and single quotes.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    names = [re.escape(field.name) for field in schema.fields if isinstance(field.dataType, whole) and not set(field.name) & set("\"\\'[{")]
    if not names:
        return text
    unread = "!"
    while unread in schema.names:
        unread += "!"
    flat = text.contains(".") & text.rlike(r"^[^\\'\[{]*\{[^\\'\[{]*$")
    found = rf'"(?:{"|".join(names)})":(-?[0-9]+\.[0-9]+)(?=[,}}])'
    return F.when(flat, F.regexp_replace(text, F.lit(found), F.lit(f'"{unread}":$1'))).otherwise(text)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _last_values(found: Column) -> Column:
    """The map without repeated keys; of a key that a line repeats, the last value counts, as it does in
    the typed parse."""
    entries, keys = F.map_entries(found), F.array_distinct(F.map_keys(found))

    def last_value(key: Column) -> Column:
        return _with(entries, lambda all_of: F.element_at(F.filter(all_of, lambda entry: entry["key"] == key), -1)["value"])

    last = _with(keys, lambda names: F.map_from_arrays(names, F.transform(names, last_value)))
    return F.when((F.size(found) > 1) & (F.size(keys) < F.size(found)), last).otherwise(found)


def rescue_lines(
    lines: DataFrame,
    schema: Schema,
    *,
    line: str = "value",
    rescued: str = RESCUED,
    corrupt: str = CORRUPT,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Typed columns plus a ``map<string,string>`` of values the schema could not take.

    ``rescued`` is an empty map for a line that fits, and holds undeclared keys and values of
    another type otherwise; of a nested field all of it as soon as a part of it does not come back
    from the typed value. A line that is no JSON object, or more than one, gives NULL columns, a
    NULL map, and its text in ``corrupt``. A JSON null is a NULL, not a rescued value.
    ``options`` are those of the JSON parser, such as ``dateFormat``. Both extra columns have a comment that
    says what they are, so policies find them under whatever name.

    Most lines fit, and they are parsed once. Every key of a line is followed by a colon, so a
    line with as many colons as typed values has no further key. Only lines with more colons, or
    with a bad or nested value, are parsed again, once: into the raw maps of their documents.
    """
    declared = as_schema(schema)
    if corrupt in declared.names or rescued in declared.names:
        raise ValueError(f"{corrupt!r} and {rescued!r} are reserved column names")
    target = T.StructType([*declared.fields, T.StructField(corrupt, T.StringType(), True)])
    given = {key: str(value) for key, value in (options or {}).items()}
    parser = {**given, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    # A select per parse, so that a line is parsed once however often its values are used.
    # Options may allow other quotes or comments; then lines are parsed as they are.
    parsed = lines.select(F.col(line).alias("_line"), (F.col(line) if given else _without_fractions(F.col(line), declared)).alias("_read"))
    parsed = parsed.select("_line", F.from_json("_read", target, parser).alias("_typed"), (F.col("_read") != F.col("_line")).alias("_fraction"))

    text = F.col("_line")
    colons = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(":"), F.lit("")))
    filled = [_typed(name).isNotNull().cast("int") for name in declared.names]
    names = F.array(*[F.lit(name) for name in declared.names])
    plain = colons == reduce(add, filled, F.lit(0))
    closed = plain & F.rtrim(text).endswith("}")
    broken = _typed(corrupt).isNotNull() | F.coalesce(F.col("_fraction"), F.lit(False))
    nested = [_typed(name).isNotNull() for name in _nested(declared)]
    bad_value = reduce(or_, nested, broken)
    # The parser stops after the first document; a second one has a colon or does not end the object.
    in_list = F.concat(F.lit("["), text, F.lit("]"))
    kind = T.MapType(T.StringType(), T.StringType())
    again = ~F.coalesce(closed, F.lit(False)) | bad_value
    maps = F.when(again, F.from_json(in_list, T.ArrayType(kind)))
    parsed = parsed.select("*", maps.alias("_maps"), plain.alias("_plain"), closed.alias("_closed"))

    maps, plain = F.col("_maps"), F.col("_plain")
    listed = maps.isNotNull()
    # What is no list of objects is rare, and looked at again.
    others = F.coalesce(F.size(F.from_json(in_list, T.ArrayType(T.StringType()))) == 1, F.lit(False))
    alone = F.when(F.col("_closed"), F.lit(True)).otherwise(F.when(listed, F.size(maps) == 1).otherwise(others))
    keys = F.when(listed, F.map_keys(F.get(maps, F.lit(0)))).otherwise(F.json_object_keys(text))
    undeclared = F.when(plain, F.lit(False)).otherwise(F.size(F.array_except(keys, names)) > 0)
    as_map = F.from_json(text, kind, given) if given else F.when(listed, F.get(maps, F.lit(0))).otherwise(F.from_json(text, kind))
    raw = F.when(alone & (bad_value | undeclared), as_map)
    parsed = parsed.select("_line", "_typed", "_fraction", raw.alias("_raw"), alone.alias("_alone"))
    parsed = parsed.select("*", F.when(F.col("_raw").isNotNull(), _kept(declared, given)).alias("_kept"))
    # Asked for twice, what is kept stays a column of its own, and is not made again for each entry.
    lost = F.when(F.col("_kept").isNotNull(), _lost(F.col("_kept")))
    parsed = parsed.select("_line", "_typed", "_fraction", "_alone", lost.alias("_lost"))

    no_map = F.col("_lost").isNull()
    corrupted = no_map & (~F.col("_alone") | broken)
    nothing = F.create_map().cast("map<string,string>")
    return parsed.select(
        *[F.when(F.col("_alone"), _typed(name)).alias(name) for name in declared.names],
        F.when(no_map & ~corrupted, nothing).otherwise(_last_values(F.col("_lost"))).alias(rescued, metadata=LEFTOVER_METADATA),
        F.when(corrupted, text).alias(corrupt, metadata=LEFTOVER_METADATA),
    )


def read_json_rescued(
    spark: SparkSession,
    path: str,
    schema: Schema,
    *,
    stream: bool = False,
    rescued: str = RESCUED,
    corrupt: str = CORRUPT,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """JSON lines of a directory through :func:`rescue_lines`, in batch or as a stream.

    ``options`` go to the scan of the files and to the JSON parser; each takes those it knows.
    """
    reader = spark.readStream if stream else spark.read
    settings = bounded(options) if stream else dict(options or {})
    lines = reader.format("text").options(**settings).load(normalise_path(path))
    lines = lines.filter(F.trim("value") != "")
    return rescue_lines(lines, schema, rescued=rescued, corrupt=corrupt, options=options)
