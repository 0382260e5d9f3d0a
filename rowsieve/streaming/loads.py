"""Incremental loads: drain a stream, write each micro-batch exactly once per sink.

``foreachBatch`` may run a batch again after a failure. Every write therefore goes to a
directory of its own, ``load_id=<query id>-<batch id>``, and replaces it as a whole: a replay
leaves the same table, also when one side of it is empty. The query id is kept in the
checkpoint, so a new checkpoint can never overwrite the loads of an older one.

A batch may have several sinks. Each sink is told which checkpoint a query has (:func:`announce`), and the
checkpoint's commit is the one mark for all of them: batches are committed in order, so the load after the last
commit is the only one that can be half written, and readers and tables leave it out
(:func:`unfinished`) until it is committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import columns_ddl, quote_name, quote_part, quote_text
from rowsieve.operators.metrics import StreamCounts, observe_rules, observed_failures
from rowsieve.operators.rules import Rule
from rowsieve.operators.split import TRACE_COLUMN, annotate, split
from rowsieve.session import session_conf
from rowsieve.operators.governance import base_of
from rowsieve.sinks.tables import DEFAULT_FORMAT, TRANSACTIONAL, add_columns
from rowsieve.sources.files import as_schema, move, names_at, path_exists, qualified_path, read_text, remove, write_text

LOAD_COLUMN = "load_id"
VERDICT_COLUMN = "verdict"
OK, KO = "ok", "ko"

MODES = ("append", "overwrite")

# Failed rows per (field, code).
Failures = dict[tuple[str, str], int]


def add_failures(total: Failures, more: Failures) -> None:
    for rule, count in more.items():
        total[rule] = total.get(rule, 0) + count


@dataclass
class LoadReport:
    """What one drain of a stream did."""

    rows_ok: int = 0
    rows_ko: int = 0
    failures: Failures = field(default_factory=dict)
    loads: list[str] = field(default_factory=list)

    def add(self, load: str, rows: int, rows_ko: int, failures: Failures) -> None:
        self.loads.append(load)
        self.rows_ok += rows - rows_ko
        self.rows_ko += rows_ko
        add_failures(self.failures, failures)


@dataclass(frozen=True)
class PathSink:
    """A directory of loads.

    "append" keeps what other checkpoints wrote there; "overwrite" means the directory is
    exactly what this checkpoint has produced, so its first batch replaces everything.
    """

    path: str
    fmt: str = DEFAULT_FORMAT
    mode: str = "append"

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"sink mode must be one of {list(MODES)}, not {self.mode!r}")
        object.__setattr__(self, "path", self.path.rstrip("/"))


_QUERIES = "_queries"  # hidden from Spark's readers


def announce(spark: SparkSession, sink: PathSink, query_id: str, checkpoint: str) -> None:
    """Tell a sink where the commits of a query are. Formats with a log of their own need no such thing."""
    place = f"{sink.path}/{_QUERIES}/{query_id}"
    if sink.fmt not in TRANSACTIONAL and not path_exists(spark, place):
        write_text(spark, place, qualified_path(spark, checkpoint))


def last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that is committed, -1 if none is; None if there is no such checkpoint."""
    place = f"{checkpoint.rstrip('/')}/commits"
    if not path_exists(spark, place):
        return None
    return max((int(name) for name in names_at(spark, place) if name.isdigit()), default=-1)


def unfinished(spark: SparkSession, path: str) -> list[str]:
    """The loads of a sink that may be half written: for each query the one after its last commit.

    A query whose checkpoint is gone counts as finished.
    """
    return [f"{query_id}-{last + 1}" for query_id, last in _commits(spark, path).items()]


def _note_of(table: str, path: str) -> str:
    return f"{path.rstrip('/')}/_registered/{table}.json"


def unregistered(spark: SparkSession, table: str, path: str) -> list[str] | None:
    """The committed loads of a sink that a table does not list yet; None if that was never noted.

    What is committed and what is listed are a number for each query, however many loads there are.
    """
    if not path_exists(spark, _note_of(table, path)):
        return None
    known = json.loads(read_text(spark, _note_of(table, path)))
    return [f"{q}-{batch}" for q, last in _commits(spark, path).items() for batch in range(known.get(q, -1) + 1, last + 1)]


def note_registered(spark: SparkSession, table: str, path: str, commits: dict[str, int]) -> None:
    write_text(spark, _note_of(table, path), json.dumps(commits))


def _commits(spark: SparkSession, path: str) -> dict[str, int]:
    """For each query that writes to a sink its last committed batch."""
    place, found = f"{path.rstrip('/')}/{_QUERIES}", {}
    for query_id in names_at(spark, place):
        last = None if query_id.startswith(".") else last_commit(spark, read_text(spark, f"{place}/{query_id}"))
        if last is not None:
            found[query_id] = last
    return found


def committed_loads(spark: SparkSession, path: str, after: Mapping[str, int]) -> tuple[list[str], dict[str, int]]:
    """The committed loads of a sink that came ``after`` a batch of each query, and the last batch of each."""
    commits = _commits(spark, path)
    there = {name.partition("=")[2] for name in names_at(spark, path) if name.startswith(f"{LOAD_COLUMN}=")}
    new = [f"{q}-{batch}" for q, last in commits.items() for batch in range(after.get(q, -1) + 1, last + 1)]
    return [load for load in new if load in there], commits


def replace_loads(spark: SparkSession, staging: str, path: str) -> None:
    """Put the loads that are complete in ``staging`` in the places of those at ``path``, one after another."""
    for name in sorted(names_at(spark, staging)):
        if name.startswith(f"{LOAD_COLUMN}="):
            remove(spark, f"{path}/{name}")
            move(spark, f"{staging}/{name}", f"{path}/{name}")


def _finished(rows: DataFrame, path: str) -> DataFrame:
    hidden = unfinished(rows.sparkSession, path)
    return rows.where(~F.col(LOAD_COLUMN).isin(hidden)) if hidden else rows


def write_load(
    df: DataFrame,
    sink: PathSink,
    query_id: str,
    batch_id: int,
    *,
    partitions: Sequence[str] = (),
    checkpoint: str | None = None,
) -> str:
    """Write one micro-batch to a sink, replacing what an earlier attempt left of it.

    Given the query's ``checkpoint``, the load shows when the batch is committed, else at once.
    """
    if checkpoint is not None:
        spark = df.sparkSession
        announce(spark, sink, query_id, checkpoint)
        load = write_load(df, sink, query_id, batch_id, partitions=partitions)
        announce(spark, sink, query_id, checkpoint)  # a sink that is overwritten forgets it
        return load
    load = f"{query_id}-{batch_id}"
    replace_all = sink.mode == "overwrite" and batch_id == 0
    marked, layout = df.withColumn(LOAD_COLUMN, F.lit(load)), [LOAD_COLUMN, *partitions]
    if sink.fmt in TRANSACTIONAL:
        # These drop a repeated batch by its number, and take new columns into the table.
        writer = marked.write.format(sink.fmt).option("mergeSchema", "true")
        writer = writer.option("txnAppId", query_id).option("txnVersion", batch_id)
        writer = writer.mode("overwrite" if replace_all else "append")
        writer.partitionBy(*layout).save(sink.path)
        return load
    # Static overwrite of the sink (the loads of earlier checkpoints go, too) or of this load.
    rows, target = (marked, sink.path) if replace_all else (df, f"{sink.path}/{LOAD_COLUMN}={load}")
    writer = rows.write.format(sink.fmt).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static")
    writer.partitionBy(*(layout if replace_all else partitions)).save(target)
    return load


def read_loads(
    spark: SparkSession, path: str, schema: T.StructType | str, *, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """All loads of a sink whose batches are committed. Thanks to the declared schema a sink without rows, or one that no
    load has reached yet, is an empty relation."""
    declared = as_schema(schema)
    full = T.StructType([*declared.fields, T.StructField(LOAD_COLUMN, T.StringType())])
    return _finished(_read_or_empty(spark, path, full, fmt), path).drop(LOAD_COLUMN)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt not in TRANSACTIONAL:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def register_loads(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = DEFAULT_FORMAT,
    partitioned: bool = True,
    loads: Sequence[str] | None = None,
) -> None:
    """Make a sink's directory readable as catalog table ``table`` and bring its columns and its
    list of loads up to date.

    A known table gets just the ``loads`` that are new, or those that :func:`unregistered` knows of with
    ``loads=()``; else, and with None, all are listed.
    """
    bound, table = table, base_of(spark, table)
    head = f"CREATE TABLE IF NOT EXISTS {quote_name(table)}"
    place = f"USING {fmt} LOCATION {quote_text(path)}"
    if fmt in TRANSACTIONAL:
        spark.sql(f"{head} {place}")
        return
    fields = [*schema.fields, *([T.StructField(LOAD_COLUMN, T.StringType())] * partitioned)]
    columns = columns_ddl(fields)
    if not partitioned:
        known = spark.catalog.tableExists(table)
        spark.sql(f"{head} ({columns}) {place}")
        if known:
            add_columns(spark, bound, schema, widen=True)
        spark.catalog.refreshTable(table)
        return
    place = f"USING {fmt} PARTITIONED BY ({LOAD_COLUMN}) LOCATION {quote_text(path)}"
    known = spark.catalog.tableExists(table)
    spark.sql(f"{head} ({columns}) {place}")
    if known:
        add_columns(spark, bound, schema, widen=True)
    _list_loads(spark, table, path, loads if known else None, [""])


def _list_loads(spark: SparkSession, table: str, path: str, loads: Sequence[str] | None, sides: Sequence[str]) -> None:
    """List new loads, or all but those that may be half written; then note how far the list goes."""
    commits = _commits(spark, path)
    if loads is not None and not loads:
        loads = unregistered(spark, table, path)
    if loads is None:
        spark.sql(f"MSCK REPAIR TABLE {quote_name(table)} SYNC PARTITIONS")
        for load in unfinished(spark, path):
            spark.sql(f"ALTER TABLE {quote_name(table)} DROP IF EXISTS PARTITION ({LOAD_COLUMN} = {quote_text(load)})")
    for start in range(0, len(loads or ()), 100):
        parts = [f"PARTITION ({LOAD_COLUMN} = {quote_text(load)}{side})" for load in loads[start : start + 100] for side in sides]
        spark.sql(f"ALTER TABLE {quote_name(table)} ADD IF NOT EXISTS {' '.join(parts)}")
    if commits:
        note_registered(spark, table, path, commits)
    spark.catalog.refreshTable(table)


def register_store(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = DEFAULT_FORMAT,
    loads: Sequence[str] | None = None,
) -> None:
    """Make a split store readable as a catalog table with the columns load and verdict.

    ``loads`` are as for :func:`register_loads`.
    """
    layout = [T.StructField(name, T.StringType()) for name in (LOAD_COLUMN, VERDICT_COLUMN)]
    columns = columns_ddl([*schema.fields, *layout])
    bound, table = table, base_of(spark, table)
    known = spark.catalog.tableExists(table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote_name(table)} ({columns}) USING {fmt} "
        f"PARTITIONED BY ({LOAD_COLUMN}, {VERDICT_COLUMN}) LOCATION {quote_text(path)}"
    )
    if known:
        add_columns(spark, bound, schema, widen=True)
    # A side without rows has no files, and a partition without files is empty.
    _list_loads(spark, table, path, loads if known else None, [f", {VERDICT_COLUMN} = {quote_text(side)}" for side in (OK, KO)])


def drain(
    df: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, str, int], None],
    *,
    name: str | None = None,
) -> str:
    """Process all input that is there now in micro-batches, then stop; give the query id.

    Progress is kept in ``checkpoint``: the next call goes on where this one ended. An error in
    a batch is raised here.
    """
    spark = df.sparkSession
    name = name or f"rowsieve-{uuid.uuid4()}"

    def query_id() -> str:
        return next(query.id for query in spark.streams.active if query.name == name)

    def run(batch: DataFrame, batch_id: int) -> None:
        each_batch(batch, query_id(), batch_id)

    query = (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .foreachBatch(run)
        .start()
    )
    query.awaitTermination()
    return query.id


def _with_verdict(judged: DataFrame, column: str) -> DataFrame:
    return judged.withColumn(VERDICT_COLUMN, F.when(F.size(column) == 0, F.lit(OK)).otherwise(F.lit(KO)))


def write_judged(judged: DataFrame, path: str, *, column: str = TRACE_COLUMN, fmt: str = DEFAULT_FORMAT) -> None:
    """Rows of several loads, judged again, in the layout of a store.

    Files of a load are together in the store, so a task has few loads; they are sorted by load and side for the write.
    """
    _with_verdict(judged, column).write.format(fmt).partitionBy(LOAD_COLUMN, VERDICT_COLUMN).save(path)


def write_store(
    judged: DataFrame,
    sink: PathSink,
    query_id: str,
    batch_id: int,
    *,
    column: str = TRACE_COLUMN,
    checkpoint: str | None = None,
) -> str:
    """One pass for both sides: rows go to ``verdict=ok`` or ``verdict=ko`` of this load."""
    rows = _with_verdict(judged, column)
    # A task keeps a file open per side instead of sorting its rows by side first.
    open_files = {"spark.sql.maxConcurrentOutputFileWriters": 2}
    with session_conf(judged.sparkSession, open_files):
        return write_load(rows, sink, query_id, batch_id, partitions=[VERDICT_COLUMN], checkpoint=checkpoint)


def split_store(
    df: DataFrame,
    rules: Sequence[Rule],
    store: PathSink,
    checkpoint: str,
    *,
    kind: str = "map",
    column: str = TRACE_COLUMN,
) -> LoadReport:
    """Drain a stream into one store that holds both sides as partitions.

    Each input row is read, judged and written once, nothing is cached, and one job commits
    both sides of a batch, so they cannot drift apart.
    """
    report = LoadReport()

    def each_batch(batch: DataFrame, query_id: str, batch_id: int) -> None:
        observed, observation = observe_rules(batch, rules, f"split-{uuid.uuid4()}")
        judged = annotate(observed, rules, kind=kind, column=column)
        load = write_store(judged, store, query_id, batch_id, column=column, checkpoint=checkpoint)
        counts = observation.get
        report.add(load, counts["rows"], counts["rows_ko"], observed_failures(counts, rules))

    drain(df, checkpoint, each_batch)
    return report


def read_side(
    spark: SparkSession,
    path: str,
    side: str,
    schema: T.StructType | str,
    *,
    trace_type: str = "map<string,string>",
    column: str = TRACE_COLUMN,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """The valid (``"ok"``) or rejected (``"ko"``) rows of a split store.

    The verdict is a partition, so the other side's files are never opened.
    """
    if side not in (OK, KO):
        raise ValueError(f"side must be {OK!r} or {KO!r}, not {side!r}")
    trace = T.StructType.fromDDL(f"{quote_part(column)} {trace_type}").fields[0]
    layout = [
        T.StructField(LOAD_COLUMN, T.StringType()),
        T.StructField(VERDICT_COLUMN, T.StringType()),
    ]
    full = T.StructType([*as_schema(schema).fields, trace, *layout])
    rows = _finished(_read_or_empty(spark, path, full, fmt), path)
    rows = rows.filter(F.col(VERDICT_COLUMN) == side).drop(LOAD_COLUMN, VERDICT_COLUMN)
    return rows.drop(column) if side == OK else rows


def split_stream(
    df: DataFrame,
    rules: Sequence[Rule],
    ok: PathSink,
    ko: PathSink,
    checkpoint: str,
    *,
    kind: str = "map",
    column: str = TRACE_COLUMN,
) -> LoadReport:
    """Drain a stream into separate places for valid and rejected rows.

    Each side scans the files of the batch. Keeping the batch in between costs more than
    reading it again, and :func:`split_store` needs neither.
    """
    report = LoadReport()

    def each_batch(batch: DataFrame, query_id: str, batch_id: int) -> None:
        tag = uuid.uuid4()
        sides = split(batch, rules, kind=kind, column=column)
        valid, seen_ok = observe_rules(sides.ok, [], f"ok-{tag}")
        rejected, seen_ko = observe_rules(sides.ko, rules, f"ko-{tag}")
        for side, rows in ((ok, valid), (ko, rejected)):
            load = write_load(rows, side, query_id, batch_id, checkpoint=checkpoint)
        counts = seen_ko.get
        rows = seen_ok.get["rows"] + counts["rows"]
        report.add(load, rows, counts["rows"], observed_failures(counts, rules))

    drain(df, checkpoint, each_batch)
    return report


def split_batch(
    df: DataFrame,
    rules: Sequence[Rule],
    store: PathSink,
    *,
    kind: str = "map",
    column: str = TRACE_COLUMN,
) -> None:
    """The store of :func:`split_store` for a batch frame: one pass, replaced as a whole."""
    judged = annotate(df, rules, kind=kind, column=column)
    write_store(judged, store, "batch", 0, column=column)


def append_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    name: str | None = None,
    counts: StreamCounts | None = None,
) -> str:
    """Drain a stream into a catalog table in append mode; give the query id.

    Columns that the table lacks are added to it first. ``counts`` collects what
    :func:`rowsieve.operators.metrics.watch_rules` counts on ``df``.
    """
    spark, bound = df.sparkSession, table
    table = base_of(spark, table)
    if fmt not in TRANSACTIONAL and spark.catalog.tableExists(table):
        add_columns(spark, bound, df.schema)
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if fmt in TRANSACTIONAL:
        writer = writer.option("mergeSchema", "true")
    with counts or nullcontext():
        query = writer.trigger(availableNow=True).outputMode("append").toTable(table)
        if counts is not None:
            counts.watch(query)
        query.awaitTermination()
    return query.id

