"""File and table scans, batch and incremental."""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str

# Input of one micro-batch unless told otherwise: enough to keep a large cluster busy, and
# little enough that a failed batch is cheap to repeat. A drain goes on until no input is left.
BATCH_BYTES = 1 << 40
BATCH_LIMITS = ("maxFilesPerTrigger", "maxBytesPerTrigger")


def normalise_path(path: str) -> str:
    """A trailing ``/*`` names the directory itself; any other glob is left to Spark."""
    while path.endswith("/*"):
        path = path[:-2]
    return path


def as_schema(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def bounded(options: Mapping[str, object] | None) -> dict[str, object]:
    """Stream options with a limit on the size of a micro-batch."""
    settings = dict(options or {})
    if not any(limit.lower() in {key.lower() for key in settings} for limit in BATCH_LIMITS):
        settings["maxBytesPerTrigger"] = BATCH_BYTES
    return settings


def file_stream(
    spark: SparkSession,
    path: str,
    schema: Schema,
    *,
    fmt: str = "json",
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Unbounded frame over the files of a directory; each file is processed once.

    The schema is fixed: extra JSON keys are dropped, values of another type become NULL.
    ``maxFilesPerTrigger`` / ``maxBytesPerTrigger`` among the options bound a micro-batch; the
    default is ``BATCH_BYTES``. A drain goes on with further batches until no input is left.
    """
    reader = spark.readStream.format(fmt.lower()).schema(as_schema(schema))
    return reader.options(**bounded(options)).load(normalise_path(path))


def read_files(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    *,
    fmt: str = "json",
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Batch scan of a directory of files, with a strict schema when one is given."""
    reader = spark.read.format(fmt.lower()).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    return reader.load(normalise_path(path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def infer_schema(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    fmt: str = "json",
    options: Mapping[str, object] | None = None,
) -> T.StructType:
    """The schema Spark infers from all files, to be passed on as a fixed schema.

    JSON and CSV inference reads its files in full, once; Parquet and ORC read the footers of all files, which
    may have different columns. For a large directory declare the schema, or keep an inferred one
    (:class:`SchemaLog`).
    """
    settings = {**_MERGING.get(fmt.lower(), {}), **(options or {})}
    place = normalise_path(path) if isinstance(path, str) else list(path)
    return spark.read.format(fmt.lower()).options(**settings).load(place).schema


#: Formats whose files have their schemas in them: all files count, not the one that Spark happens to open.
_MERGING = {"parquet": {"mergeSchema": "true"}, "orc": {"mergeSchema": "true"}}


class SchemaLog:
    """Versions of a schema at a place that only grows: ``v1.json``, ``v2.json`` and so on.

    A version appears with its whole text or not at all, so a run that ends while it writes one costs nothing.
    """

    def __init__(self, spark: SparkSession, place: str):
        self._spark, self._place = spark, place.rstrip("/")

    def _numbers(self) -> list[int]:
        found = (re.fullmatch(r"v(\d+)\.json", name) for name in names_at(self._spark, self._place))
        return sorted(int(match[1]) for match in found if match)

    def versions(self) -> list[T.StructType]:
        texts = (read_text(self._spark, f"{self._place}/v{number}.json") for number in self._numbers())
        return [T.StructType.fromJson(json.loads(text)) for text in texts]

    def current(self) -> T.StructType | None:
        """The latest version; where there is none, a schema that an earlier release kept there."""
        numbers = self._numbers()
        if numbers:
            return T.StructType.fromJson(json.loads(read_text(self._spark, f"{self._place}/v{numbers[-1]}.json")))
        if not path_exists(self._spark, f"{self._place}/_SUCCESS"):
            return None
        row = self._spark.read.text(self._place, wholetext=True).first()
        return None if row is None else T.StructType.fromJson(json.loads(row[0]))

    def add(self, schema: T.StructType) -> T.StructType:
        number = (self._numbers() or [0])[-1] + 1
        write_text(self._spark, f"{self._place}/v{number}.json", schema.json())
        return schema


def kept_schema(
    spark: SparkSession,
    place: str,
    path: str,
    *,
    fmt: str = "json",
    options: Mapping[str, object] | None = None,
) -> T.StructType:
    """The schema logged at ``place``; at first it is inferred from ``path`` and logged there.

    Later runs read new files only, and types do not drift between them. What differs is for the
    rescue column to keep, or for a later version (:mod:`rowsieve.sources.evolving`).
    """
    log = SchemaLog(spark, place)
    return log.current() or log.add(infer_schema(spark, path, fmt=fmt, options=options))


def _file_system(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_at(spark: SparkSession, path: str) -> list[str]:
    """The names in a directory; none if it does not exist."""
    system, target = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, in whatever store Spark reads."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all; one that is there is replaced."""
    folder, _, name = path.rpartition("/")
    system, target = _file_system(spark, path)
    _, aside = _file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(aside, target):
        raise OSError(f"could not write {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, without ``.`` and doubled slashes; of a glob what stands before it."""
    fixed = re.split(r"/[^/]*[*?\[{]", normalise_path(path), maxsplit=1)[0] or "/"
    target = spark._jvm.org.apache.hadoop.fs.Path(fixed)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme, _, rest = system.makeQualified(target).toString().partition(":")
    return f"{scheme}:{posixpath.normpath('/' + rest.lstrip('/'))}"


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file another name, in a directory that is made if need be; what is there is replaced."""
    system, target = _file_system(spark, to)
    system.mkdirs(target.getParent())
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(_file_system(spark, path)[1], target):
        raise OSError(f"could not move {path}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a directory, if it is there."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def read_variant(
    spark: SparkSession,
    path: str,
    *,
    column: str = "record",
    stream: bool = False,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """JSON lines without any schema: one VARIANT column per line, to be taken apart later.

    This also reads what inference refuses, such as keys that differ in case only.
    """
    reader = spark.readStream if stream else spark.read
    settings = bounded(options) if stream else dict(options or {})
    schema = T.StructType([T.StructField(column, T.VariantType())])
    reader = reader.format("json").schema(schema).options(**settings)
    return reader.option("singleVariantColumn", column).load(normalise_path(path))


def empty_like(df: DataFrame) -> DataFrame:
    """An empty relation with ``df``'s schema that stays a stream when ``df`` is one."""
    return df.filter(F.lit(False))
