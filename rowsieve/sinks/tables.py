"""Batch sinks: tables, merged schemas, bounded JSON files, clustered layouts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowsieve.names import columns_ddl, quote_name, quote_part, quote_text
from rowsieve.operators.enrich import align, joined_schema, same_name
from rowsieve.operators.governance import base_of, rebind
from rowsieve.sources.files import as_schema

DEFAULT_FORMAT = "parquet"
# Formats with their own transaction log; they merge schemas and drop replays by themselves.
TRANSACTIONAL = ("delta",)


def overwrite_table(
    df: DataFrame, table: str, *, fmt: str = DEFAULT_FORMAT, comment: str | None = None
) -> None:
    """Replace a catalog table by ``df``; if that fails, the old table stays as it was.

    The rows are written beside the table, which may itself be among what ``df`` reads, and take
    its name when they are complete, with its partitioning, clustering, properties and comment. The old table is
    renamed first and dropped last, so a run that ends in between loses neither: the next one finds the old table
    by the name it has then. Formats with a log of their own replace it atomically.
    """
    spark, bound = df.sparkSession, table
    table = base_of(spark, table)
    if fmt in TRANSACTIONAL or not (spark.catalog.tableExists(table) or _restored(spark, table)):
        df.write.format(fmt).mode("overwrite").saveAsTable(table)
    else:
        beside, before = (_beside(table, kind) for kind in ("new", "old"))
        spark.sql(f"DROP TABLE IF EXISTS {quote_name(before)}")
        layout = _layout(spark, table)
        try:
            _write_like(df, beside, fmt, layout)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {quote_name(beside)}")
            raise
        # At each moment one of the two has the table's name or is known by the name it has beside it.
        spark.sql(f"ALTER TABLE {quote_name(table)} RENAME TO {quote_name(before)}")
        spark.sql(f"ALTER TABLE {quote_name(beside)} RENAME TO {quote_name(table)}")
        spark.sql(f"DROP TABLE {quote_name(before)}")
    rebind(spark, bound)
    if comment is not None:
        set_comment(spark, table, comment)


def _beside(table: str, kind: str) -> str:
    *namespace, name = table.split(".")
    return ".".join([*namespace, f"{name}__{kind}" if kind == "old" else f"{name}_{uuid.uuid4().hex}"])


def _restored(spark: SparkSession, table: str) -> bool:
    """Whether the table got its name back, where a run ended between the two renames."""
    before = _beside(table, "old")
    if not spark.catalog.tableExists(before):
        return False
    spark.sql(f"ALTER TABLE {quote_name(before)} RENAME TO {quote_name(table)}")
    return True


def _layout(spark: SparkSession, table: str) -> dict:
    """Partition columns, clustering columns, properties and comment of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").collect()
    facts = {row.col_name: row.data_type for row in rows}
    kept = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").collect()}
    internal = ("transient_lastDdlTime", "clusteringColumns", "comment")
    columns = spark.catalog.listColumns(table)
    clustering = json.loads(kept.get("clusteringColumns", "[]"))
    return {
        "partitions": [c.name for c in columns if c.isPartition],
        "clustering": [".".join(parts) for parts in clustering],
        "properties": {k: v for k, v in kept.items() if k not in internal and not k.startswith(("spark.sql.", "option."))},
        "comment": facts.get("Comment"),
    }


def _write_like(df: DataFrame, table: str, fmt: str, layout: dict) -> None:
    spark = df.sparkSession
    same = same_name(spark)
    present = {same(name) for name in df.columns}
    writer = df.write.format(fmt).mode("error")
    for by, columns in ((writer.partitionBy, layout["partitions"]), (writer.clusterBy, layout["clustering"])):
        if columns and all(same(name) in present for name in columns):
            writer = by(*columns)
    writer.saveAsTable(table)
    if layout["properties"]:
        pairs = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in layout["properties"].items())
        spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ({pairs})")
    if layout["comment"]:
        set_comment(spark, table, layout["comment"])


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {quote_name(table)} IS {quote_text(comment)}")


def append_table(
    df: DataFrame, table: str, *, fmt: str = DEFAULT_FORMAT, merge_schema: bool = False, widen: bool = False
) -> None:
    """Append ``df`` to a catalog table, creating it when it is missing.

    With ``merge_schema`` new columns and new fields of nested values widen the table first (older rows read
    NULL there) and what ``df`` lacks is written as NULL. Names match as the session compares them. A type that
    does not widen to the table's is an error; with ``widen`` the table takes the wider type instead, and
    only a type without a common one is.
    """
    spark, bound = df.sparkSession, table
    table = base_of(spark, table)
    if not spark.catalog.tableExists(table):
        df.write.format(fmt).mode("append").saveAsTable(table)
        return
    if fmt in TRANSACTIONAL:
        writer = df.write.format(fmt).mode("append")
        writer.option("mergeSchema", str(merge_schema).lower()).saveAsTable(table)
        return
    if merge_schema:
        add_columns(spark, bound, df.schema, widen=widen)
        df = align(df, spark.table(table).schema, strict=True, lossless=True)
    df.write.format(fmt).mode("append").saveAsTable(table)


def add_columns(spark: SparkSession, table: str, schema: T.StructType, *, widen: bool = False) -> None:
    """Give a table the columns and nested fields of ``schema`` that it lacks, and with ``widen`` wider types.

    Rows that are there read NULL in what is new. Files stay as they are, as readers widen their values.
    A type that does not fit is an error before anything is changed.
    """
    table, bound = base_of(spark, table), table
    same = same_name(spark)
    partitions = {same(c.name) for c in spark.catalog.listColumns(table) if c.isPartition}
    known = T.StructType([f for f in spark.table(table).schema.fields if same(f.name) not in partitions])
    arriving = T.StructType([f for f in schema.fields if same(f.name) not in partitions])
    wanted = joined_schema(known, arriving, same, widen=widen)
    new = wanted.fields[len(known.fields) :]
    changed = [b for a, b in zip(known.fields, wanted.fields) if a.dataType != b.dataType]
    if new:
        spark.sql(f"ALTER TABLE {quote_name(table)} ADD COLUMNS ({columns_ddl(new)})")
    if changed:
        _change_types(spark, table, wanted)
    if new or changed:
        spark.catalog.refreshTable(table)
        rebind(spark, bound)


def _change_types(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Set the types of a table's columns; SQL has a statement for it, but not for tables of plain files."""
    session = spark._jsparkSession
    name = session.sessionState().sqlParser().parseTableIdentifier(quote_name(table))
    types = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    session.sessionState().catalog().alterTableDataSchema(name, types)


def append_path(df: DataFrame, path: str, *, fmt: str = DEFAULT_FORMAT) -> None:
    """Append to a directory; files of different schemas may live side by side there."""
    df.write.format(fmt).mode("append").save(path)


def read_merged(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a directory whose files have different columns.

    Merging opens every footer; give the merged ``schema`` when it is known to skip that.
    """
    if schema is not None:
        return spark.read.format(fmt).schema(as_schema(schema)).load(path)
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def write_json(
    df: DataFrame,
    path: str,
    *,
    n_files: int | None = None,
    mode: str = "append",
    max_records_per_file: int | None = None,
    wide: bool = False,
) -> None:
    """Write JSON lines, NULL fields left out; with ``n_files`` in at most so many files per call.

    ``coalesce`` merges the upstream tasks, which suits a cheap source. After a shuffle or heavy
    work pass ``wide=True`` to keep that parallel and shuffle into ``n_files`` afterwards. For
    large output leave it out and bound the files by ``max_records_per_file``.
    """
    if n_files is not None:
        df = df.repartition(n_files) if wide else df.coalesce(n_files)
    writer = df.write.mode(mode)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.json(path)


def write_noop(df: DataFrame) -> None:
    """Compute every row and column of ``df`` and keep nothing."""
    df.write.mode("overwrite").format("noop").save()


def clustered(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Lay rows out so that files hold few values of ``by``, sorted within.

    A rebalance shuffle brings equal keys together and leaves it to AQE to size the output: it
    merges small partitions and splits one that a hot key fills, so a key with a third of all
    rows becomes many files and not one task. Retried tasks send rows to the same place, since
    the target only depends on the key.
    """
    keys = [by] if isinstance(by, str) else list(by)
    return df.hint("rebalance", *keys).sortWithinPartitions(*keys)


def write_clustered_table(
    df: DataFrame, table: str, by: str | Sequence[str], *, fmt: str = DEFAULT_FORMAT
) -> None:
    """Replace ``table`` by ``df`` in a clustered layout and record the clustering columns."""
    keys = [by] if isinstance(by, str) else list(by)
    spark = df.sparkSession
    clustered(df, keys).write.format(fmt).mode("overwrite").clusterBy(*keys).saveAsTable(base_of(spark, table))
    rebind(spark, table)


def set_clustering(spark: SparkSession, table: str, by: str | Sequence[str]) -> None:
    """Record clustering columns on an existing table; later writes decide the layout."""
    keys = [by] if isinstance(by, str) else list(by)
    columns, table = ", ".join(quote_part(key) for key in keys), base_of(spark, table)
    spark.sql(f"ALTER TABLE {quote_name(table)} CLUSTER BY ({columns})")


def write_path(
    df: DataFrame,
    path: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "append",
    options: Mapping[str, object] | None = None,
) -> None:
    df.write.format(fmt).mode(mode).options(**(options or {})).save(path)
