"""Files of any format whose columns change over time, read without losing one.

A stream only lists what has arrived (``new_files``); each batch is then read by name, under a schema that
grows with it. Every version of the schema is logged before a row is written under it, so a
batch that is repeated, and each later run, has at least these columns.

* Parquet, ORC and other formats that carry their schema: the schemas of the batch's files are joined with the
  logged one (:func:`rowsieve.operators.enrich.joined_schema`). A file whose type has no common one is an error,
  raised before anything of the batch is written.
* CSV: files are read by their own headers, so columns may come in any order, go missing and be new. A
  known column keeps its type; a line that does not fit it, or has more fields than its header, is kept
  whole in the column ``_corrupt_record``.

JSON lines need none of this: :mod:`rowsieve.sources.rescue` keeps what a schema does not have.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import LEFTOVER_METADATA, quote_part
from rowsieve.operators.enrich import joined_schema, same_name
from rowsieve.sources.files import SchemaLog, infer_schema, normalise_path, qualified_path
from rowsieve.sources.rescue import CORRUPT

#: Files that one batch lists unless the source's options say otherwise; a drain goes on with further batches.
BATCH_FILES = 100_000
#: Fixed value: the columns of a scan of files as such. The content of a file is read only where it is asked for.
_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
#: Options of a source that say which files there are.
_LISTING = {"pathglobfilter", "recursivefilelookup", "modifiedbefore", "modifiedafter", "ignoremissingfiles"}
_TRIGGER = {"maxfilespertrigger", "maxbytespertrigger", "latestfirst", "maxfileage", "cleansource", "sourcearchivedir"}


_CORRUPT_FIELD = T.StructField(CORRUPT, T.StringType(), True, LEFTOVER_METADATA)


def _only(options: Mapping[str, object] | None, names: set[str]) -> dict[str, object]:
    return {key: value for key, value in (options or {}).items() if key.lower() in names}


def _without(options: Mapping[str, object] | None, names: set[str]) -> dict[str, object]:
    return {key: value for key, value in (options or {}).items() if key.lower() not in names}


def new_files(spark: SparkSession, path: str, options: Mapping[str, object] | None = None) -> DataFrame:
    """A stream of the paths of files, with the time of their batch (``at``); no file is opened for it."""
    settings = {"maxFilesPerTrigger": BATCH_FILES, **_only(options, _LISTING | _TRIGGER)}
    if any(key.lower() == "maxbytespertrigger" for key in settings):
        settings.pop("maxFilesPerTrigger")
    found = spark.readStream.format("binaryFile").schema(_FILE).options(**settings).load(normalise_path(path))
    return found.select("path", F.current_timestamp().alias("at"))


def all_files(spark: SparkSession, path: str, options: Mapping[str, object] | None = None) -> list[str]:
    found = spark.read.format("binaryFile").options(**_only(options, _LISTING)).load(normalise_path(path))
    return sorted(row.path for row in found.select("path").toLocalIterator())


def _header(line: str, options: Mapping[str, object], same) -> list[str]:
    """The column names of a first line, named as Spark names them where they are missing or repeated."""
    given = {key.lower(): str(value) for key, value in options.items()}
    sep = given.get("sep", given.get("delimiter", ",")).encode().decode("unicode_escape")
    quote = given.get("quote", '"') or None
    quoting = csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE
    # Fields of several lines end with the first one here; names have none.
    parts = next(csv.reader([line.rstrip("\r").lstrip("﻿")], delimiter=sep, quotechar=quote, quoting=quoting), [])
    if given.get("header", "false").lower() != "true":
        return [f"_c{i}" for i in range(len(parts))]
    if given.get("ignoreleadingwhitespace", "false").lower() == "true":
        parts = [part.lstrip() for part in parts]
    if given.get("ignoretrailingwhitespace", "false").lower() == "true":
        parts = [part.rstrip() for part in parts]
    known = [same(part) for part in parts]
    return [f"_c{i}" if not part else f"{part}{i}" if known.count(same(part)) > 1 else part for i, part in enumerate(parts)]


def _by_header(spark: SparkSession, files: Sequence[str], options: Mapping[str, object], same) -> dict[tuple[str, ...], list[str]]:
    """The files for each header. Files without a line have none."""
    keep = {"encoding", "charset", "linesep"}
    lines = spark.read.options(**_only(options, keep)).text(list(files))
    lines = lines.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    comment = next((str(v) for k, v in options.items() if k.lower() == "comment"), None)
    shown = (F.trim("value") != "") & (~F.col("value").startswith(comment) if comment else F.lit(True))
    first = lines.where(shown).groupBy("file_path").agg(F.min_by("value", F.struct("file_block_start", "row")).alias("line"))
    alike = first.groupBy("line").agg(F.collect_list("file_path").alias("files"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in alike.toLocalIterator():
        # The metadata have paths as URIs.
        found.setdefault(tuple(_header(row.line, options, same)), []).extend(_literally([unquote(file) for file in row.files]))
    return found


def _literally(paths: Sequence[str]) -> list[str]:
    """Paths that readers take as they are, where a name has signs of a pattern."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths]


class Evolving:
    """A source whose schema grows. ``place`` is that of its log; without one the schema lasts as long as this object."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        fmt: str,
        options: Mapping[str, object] | None = None,
        place: str | None = None,
    ):
        self._spark, self._path, self._fmt = spark, path, fmt.lower()
        self._options = _without(options, _LISTING | _TRIGGER)
        self._log = None if place is None else SchemaLog(spark, place)
        self._same = same_name(spark)
        self._schema = self._log.current() if self._log else None

    @property
    def columns(self) -> T.StructType:
        """The columns that rows have now."""
        schema = self._schema or T.StructType()
        if self._fmt != "csv" or CORRUPT in schema.names:
            return schema
        return T.StructType([*schema.fields, _CORRUPT_FIELD])

    @property
    def known(self) -> bool:
        return self._schema is not None

    def read(self, files: Sequence[str]) -> DataFrame:
        """The rows of these files, by name, after what they bring has been logged."""
        files = _literally(files)
        if self._fmt == "csv":
            return self._read_csv(files)
        if not files:
            return self._spark.createDataFrame([], self.columns)
        # Keys in the paths are columns from the source's directory on.
        options = {"basePath": qualified_path(self._spark, self._path), **self._options}
        found = infer_schema(self._spark, files, fmt=self._fmt, options=options)
        self._grow(found)
        return self._spark.read.format(self._fmt).options(**options).schema(self._schema).load(files)

    def _grow(self, found: T.StructType) -> None:
        schema = joined_schema(self._schema or T.StructType(), found, self._same)
        if schema != self._schema:
            self._schema = self._log.add(schema) if self._log else schema

    def _read_csv(self, files: Sequence[str]) -> DataFrame:
        spark = self._spark
        groups = _by_header(spark, files, self._options, self._same) if files else {}
        known = {self._same(field.name): field for field in (self._schema or T.StructType()).fields}
        for header, some in groups.items():
            new = [name for name in header if self._same(name) not in known]
            if new:
                types = {self._same(f.name): f for f in infer_schema(spark, some, fmt="csv", options=self._options).fields}
                fields = [T.StructField(n, types[self._same(n)].dataType if self._same(n) in types else T.StringType(), True) for n in new]
                self._grow(T.StructType(fields))
                known |= {self._same(field.name): field for field in fields}
        if self._schema is None:
            self._grow(T.StructType())
        parts = [self._csv_part(header, some, known) for header, some in groups.items()]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], self.columns)

    def _csv_part(self, header: tuple[str, ...], files: list[str], known: Mapping[str, T.StructField]) -> DataFrame:
        own = [T.StructField(name, known[self._same(name)].dataType, True) for name in header]
        if self._same(CORRUPT) in map(self._same, header):
            raise ValueError(f"{CORRUPT!r} is a reserved column name")
        schema = T.StructType([*own, _CORRUPT_FIELD])
        options = {**self._options, "columnNameOfCorruptRecord": CORRUPT, "enforceSchema": "true"}
        rows = self._spark.read.options(**options).schema(schema).csv(files)
        named = {self._same(name): name for name in header}
        columns = [
            F.col(quote_part(named[self._same(f.name)])).alias(f.name)
            if self._same(f.name) in named
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self._schema.fields
        ]
        return rows.select(*columns, CORRUPT)
