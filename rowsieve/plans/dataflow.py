"""Run a contract: sources → steps → sinks → summaries → audit record."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.operators.aggregate import grouped_stats, merge_stats, partial_stats
from rowsieve.operators.enrich import add_processing_time
from rowsieve.operators.governance import base_of
from rowsieve.operators.metrics import observe_rules, observed_failures
from rowsieve.operators.rules import Rule, compile_rules
from rowsieve.operators.split import TRACE_COLUMN, annotate, split
from rowsieve.names import quote_name
from rowsieve.plans.contract import ENVIRONMENT, VALIDATE, ContractError, Dataflow, Sink, Source, Step, Summary
from rowsieve.plans.ledger import Entry, Ledger
from rowsieve.sinks.tables import (
    TRANSACTIONAL,
    append_table,
    clustered,
    overwrite_table,
    write_noop,
    write_path,
)
from rowsieve.sources.evolving import Evolving, all_files, new_files
from rowsieve.sources.files import (
    Schema,
    as_schema,
    file_stream,
    infer_schema,
    kept_schema,
    names_at,
    path_exists,
    qualified_path,
    read_files,
    remove,
)
from rowsieve.sources.rescue import read_json_rescued
from rowsieve.streaming.loads import (
    LOAD_COLUMN,
    OK,
    Failures,
    PathSink,
    add_failures,
    drain,
    last_commit,
    read_loads,
    read_side,
    register_loads,
    unfinished,
    write_load,
    write_store,
)

AUDIT_SCHEMA = (
    "pipeline_name STRING, environment STRING, rows_ok BIGINT, rows_ko BIGINT, "
    "execution_timestamp TIMESTAMP, duration_seconds DOUBLE, status STRING"
)


@dataclass
class RunReport:
    """What a run did. Row counts are those of each source's last validate step."""

    name: str
    environment: str
    rows_ok: int = 0
    rows_ko: int = 0
    failures: Failures = field(default_factory=dict)
    loads: list[str] = field(default_factory=list)
    seconds: float = 0.0
    status: str = "ok"


@dataclass(frozen=True)
class RunOptions:
    """How to run; see :func:`run`."""

    checkpoint: str | None = None
    execution: str = "stream"
    schemas: Mapping[str, Schema] = field(default_factory=dict)
    table_format: str | None = None
    processing_time: str | None = "string"
    trace: str = "map"
    code_style: str = "short"
    nulls: str = "pass"
    on_unknown: str = "raise"


def _reached(flow: Dataflow, sinks: list[Sink]) -> set[str]:
    """Names of all frames that a sink is, or descends from."""
    parents, names = flow.parents(), set()
    for sink in sinks:
        name = sink.input
        while name is not None and name not in names:
            names.add(name)
            name = parents.get(name)
    return names


class _Bound:
    """The steps below one source, bound to a frame of that source.

    Nothing is cached: every write is a plan of its own over the source, with the verdict
    pushed into the scan where the format allows it. Counting is part of those writes. It sits
    in their last stage, above any shuffle: there Spark counts each task once, whatever had to
    be repeated.
    """

    def __init__(
        self,
        flow: Dataflow,
        source: Source,
        frame: DataFrame,
        options: RunOptions,
        sinks: list[Sink],
    ):
        self.frames: dict[str, DataFrame] = {source.name: frame}
        self.unwritten: list[DataFrame] = []
        self._options = options
        self._reached = _reached(flow, sinks)
        self._shuffled = any(sink.cluster_by for sink in sinks)
        self._steps: dict[str, tuple[Step, list[Rule]]] = {}
        self._to_count: dict[str, list[Rule]] = {}
        self._same_rows: dict[str, str] = {}
        self._seen: dict[str, Observation] = {}
        for step in flow.steps:
            if step.input in self.frames:
                self._bind(step, self.frames[step.input])

    def _bind(self, step: Step, frame: DataFrame) -> None:
        if step.type == VALIDATE:
            self._validate(step, frame)
            return
        column, kind = step.params.get("column", "dt"), step.params.get("as", "string")
        self.frames[step.name] = add_processing_time(frame, column=column, as_type=kind)
        self._same_rows[step.name] = step.input

    def _validate(self, step: Step, frame: DataFrame) -> None:
        options = self._options
        rules = compile_rules(
            frame,
            step.params.get("validations", []),
            code_style=options.code_style,
            nulls=options.nulls,
            on_unknown=options.on_unknown,
        )
        ok, ko = step.outputs
        self._steps[step.name] = step, rules
        if not frame.isStreaming:
            frame = self._plan_counts(step, rules, frame)
        self.frames[ok], self.frames[ko] = split(frame, rules, kind=options.trace)
        self.frames[step.name] = annotate(frame, rules, kind=options.trace)

    def _plan_counts(self, step: Step, rules: list[Rule], frame: DataFrame) -> DataFrame:
        ok, ko = step.outputs
        if step.name in self._reached:
            self._to_count[step.name] = rules
        elif {ok, ko} <= self._reached:
            self._to_count |= {ok: [], ko: rules}
        else:
            # A side that nobody writes is counted on the scan that feeds the other one.
            observed = self._observe(step.name, rules, frame)
            if {ok, ko} & self._reached and not self._shuffled:
                return observed
            self.unwritten.append(observed)
        return frame

    def _observe(self, name: str, rules: list[Rule], frame: DataFrame) -> DataFrame:
        frame, self._seen[name] = observe_rules(frame, rules, f"{name}-{uuid.uuid4()}")
        return frame

    def counted(self, name: str, frame: DataFrame) -> DataFrame:
        """``frame``, as it is about to be written, with the counts of the rows it holds."""
        while name in self._same_rows:
            name = self._same_rows[name]
        if name not in self._to_count or name in self._seen:
            return frame
        return self._observe(name, self._to_count[name], frame)

    def add_counts(self, report: RunReport) -> None:
        rows_ok = rows_ko = 0
        for step, rules in self._steps.values():
            ok, ko = step.outputs
            if step.name in self._seen:
                counts = self._seen[step.name].get
                rows_ok, rows_ko = counts["rows"] - counts["rows_ko"], counts["rows_ko"]
            else:
                counts = self._seen[ko].get
                rows_ok, rows_ko = self._seen[ok].get["rows"], counts["rows"]
            add_failures(report.failures, observed_failures(counts, rules))
        report.rows_ok += rows_ok
        report.rows_ko += rows_ko


def _source_schema(spark: SparkSession, source: Source, options: RunOptions) -> tuple[T.StructType, bool]:
    """The schema of a source, and whether it was inferred in an earlier or this run.

    Incremental runs keep an inferred schema with their checkpoint, so later runs look at new files
    only and no type changes under what is loaded already.
    """
    if source.name in options.schemas:
        return as_schema(options.schemas[source.name]), False
    if source.schema is not None:
        return source.schema, False
    if options.execution == "stream":
        place = f"{options.checkpoint.rstrip('/')}/schemas/{source.name}"
        return kept_schema(spark, place, source.path, fmt=source.fmt, options=source.options), True
    return infer_schema(spark, source.path, fmt=source.fmt, options=source.options), True


def _evolving(spark: SparkSession, source: Source, options: RunOptions) -> Evolving | None:
    """The source as one whose columns may change, where no schema is declared; JSON is rescued instead."""
    if source.fmt == "json" or source.rescue or source.schema is not None or source.name in options.schemas:
        return None
    place = f"{options.checkpoint.rstrip('/')}/schemas/{source.name}" if options.execution == "stream" else None
    return Evolving(spark, source.path, fmt=source.fmt, options=source.options, place=place)


def _timed(frame: DataFrame, options: RunOptions, at: datetime | None) -> DataFrame:
    if options.processing_time is None:
        return frame
    return add_processing_time(frame, as_type=options.processing_time, at=at)


def _read(spark: SparkSession, source: Source, options: RunOptions, *, stream: bool) -> DataFrame:
    schema, inferred = _source_schema(spark, source, options)
    # What later files hold beyond a kept schema must not be lost.
    if source.rescue or (inferred and stream and source.fmt == "json"):
        if source.fmt != "json":
            raise ValueError(f"source {source.name!r}: only JSON can be rescued, not {source.fmt}")
        frame = read_json_rescued(
            spark, source.path, schema, stream=stream, options=source.options
        )
    else:
        reader = file_stream if stream else read_files
        frame = reader(spark, source.path, schema, fmt=source.fmt, options=source.options)
    # A micro-batch has a time of its own; the queries of a batch run share this one.
    return _timed(frame, options, None if stream else datetime.now(timezone.utc))


def _fed_by(flow: Dataflow, source: Source) -> tuple[list[Sink], list[Summary]]:
    sinks = [sink for sink in flow.sinks if flow.origin(sink.input) == source.name]
    names = {sink.name for sink in sinks}
    return sinks, [summary for summary in flow.summaries if summary.input in names]


@dataclass(frozen=True)
class _Target:
    """Where one pass over a source puts its rows: a load of a stream, or the sink as such."""

    query_id: str | None = None
    batch_id: int | None = None
    checkpoint: str | None = None

    def write(self, df: DataFrame, sink: PathSink) -> None:
        if self.query_id is None:
            write_path(df, sink.path, fmt=sink.fmt, mode=sink.mode)
        else:
            write_load(df, sink, self.query_id, self.batch_id, checkpoint=self.checkpoint)

    def write_store(self, judged: DataFrame, sink: PathSink) -> None:
        query_id = self.query_id or f"batch-{uuid.uuid4()}"
        write_store(judged, sink, query_id, self.batch_id or 0, checkpoint=self.checkpoint)


def _write_all(flow: Dataflow, bound: _Bound, sinks, summaries, target: _Target) -> None:
    stores = flow.validations()
    for sink in sinks:
        frame = bound.frames[sink.input]
        if sink.cluster_by:
            frame = clustered(frame, sink.cluster_by)
        frame = bound.counted(sink.input, frame)
        write = target.write_store if sink.input in stores else target.write
        for path in sink.paths:
            write(frame, PathSink(path, sink.fmt, sink.mode))
    by_name = {sink.name: sink for sink in sinks}
    for summary in summaries:
        if summary.parts:
            sink = by_name[summary.input]
            name = sink.input if sink.input not in stores else stores[sink.input].outputs[0]
            parts = partial_stats(bound.frames[name], summary.by, summary.value)
            target.write(parts, PathSink(summary.parts, summary.fmt, sink.mode))
    for frame in bound.unwritten:
        write_noop(frame)


# Formats whose scans read single columns; a batch in any other is parsed once and kept in one of these.
_COLUMNAR = ("parquet", "orc", "delta")


def _staged(batch: DataFrame, place: str) -> DataFrame:
    """The rows of a micro-batch, parsed once, for all that is written from them."""
    batch.write.mode("overwrite").parquet(place)
    return batch.sparkSession.read.schema(batch.schema).parquet(place)


def _empty_overwritten(spark: SparkSession, sinks: list[Sink], schemas: Mapping[str, T.StructType]) -> None:
    """A new checkpoint starts over also where there is no input: sinks to overwrite become empty."""
    for sink in sinks:
        if sink.mode == "overwrite" and sink.fmt not in TRANSACTIONAL:
            for path in sink.paths:
                if path_exists(spark, path):
                    spark.createDataFrame([], schemas[sink.name]).write.format(sink.fmt).mode("overwrite").save(path)


def _load_source(
    spark: SparkSession, flow: Dataflow, source: Source, options: RunOptions, report: RunReport
) -> dict[str, T.StructType]:
    """Load everything below one source; give the schema of each sink."""
    sinks, summaries = _fed_by(flow, source)
    stream = options.execution == "stream"
    evolving = _evolving(spark, source, options)
    if evolving is None:
        frame = _read(spark, source, options, stream=stream)
    else:
        # Of files that came before the first run all count at once; after that, those of each batch.
        rows = evolving.read([] if evolving.known else all_files(spark, source.path, source.options))
        frame = _timed(rows if not stream else rows.limit(0), options, datetime.now(timezone.utc))
    # Binding checks every rule against the schema, before any data moves.
    shape = _Bound(flow, source, frame, options, sinks)
    schemas = {sink.name: shape.frames[sink.input].schema for sink in sinks}

    if not stream:
        _write_all(flow, shape, sinks, summaries, _Target())
        shape.add_counts(report)
        return schemas

    checkpoint = f"{options.checkpoint.rstrip('/')}/{source.name}"
    staging = f"{options.checkpoint.rstrip('/')}/staging/{source.name}"
    writes = sum(len(sink.paths) for sink in sinks) + sum(bool(s.parts) for s in summaries)
    stage = source.fmt not in _COLUMNAR and writes + bool(shape.unwritten) > 1
    started, before = path_exists(spark, f"{checkpoint}/commits"), len(report.loads)

    def each_batch(batch: DataFrame, query_id: str, batch_id: int) -> None:
        if evolving is not None:
            files = [(row.path, row["at"]) for row in batch.toLocalIterator()]
            rows = evolving.read([path for path, _ in files])
            # The time of the batch, which it keeps when it is repeated.
            batch = _timed(rows, options, files[0][1].astimezone(timezone.utc) if files else datetime.now(timezone.utc))
        rows = _staged(batch, staging) if stage else batch
        bound = _Bound(flow, source, rows, options, sinks)
        schemas.update({sink.name: bound.frames[sink.input].schema for sink in sinks})
        _write_all(flow, bound, sinks, summaries, _Target(query_id, batch_id, checkpoint))
        held = RunReport(report.name, report.environment)
        bound.add_counts(held)
        load = f"{query_id}-{batch_id}"
        Ledger(spark, options.checkpoint).write(Entry(source.name, load, held.rows_ok, held.rows_ko, held.failures))
        written.append((batch_id, load, held))

    written: list[tuple[int, str, RunReport]] = []
    arriving = frame if evolving is None else new_files(spark, source.path, source.options)
    try:
        drain(arriving, checkpoint, each_batch)
    finally:
        # A batch that is not committed will be repeated, and counts then.
        last = last_commit(spark, checkpoint) if written else None
        for batch_id, load, held in written:
            if last is not None and batch_id <= last:
                report.rows_ok += held.rows_ok
                report.rows_ko += held.rows_ko
                add_failures(report.failures, held.failures)
                report.loads.append(load)
        if stage:
            remove(spark, staging)
    if not started and len(report.loads) == before:
        _empty_overwritten(spark, sinks, schemas)
    return schemas


def read_sink(
    spark: SparkSession,
    flow: Dataflow,
    name: str,
    schema: T.StructType,
    *,
    execution: str = "stream",
) -> DataFrame:
    """The rows of a sink, given the schema of its input; of a store, the valid ones."""
    sink = next(sink for sink in flow.sinks if sink.name == name)
    path = sink.paths[0]
    if sink.input in flow.validations():
        columns = T.StructType([field for field in schema.fields if field.name != TRACE_COLUMN])
        trace = schema[TRACE_COLUMN].dataType.simpleString()
        return read_side(spark, path, OK, columns, trace_type=trace, fmt=sink.fmt)
    if execution == "stream":
        return read_loads(spark, path, schema, fmt=sink.fmt)
    return spark.read.format(sink.fmt).schema(schema).load(path)


def _loads_at(spark: SparkSession, path: str) -> set[str]:
    """The loads that a directory holds of committed batches."""
    found = {name.partition("=")[2] for name in names_at(spark, path) if name.startswith(f"{LOAD_COLUMN}=")}
    return found - set(unfinished(spark, path))


def _complete_parts(spark: SparkSession, flow: Dataflow, summary: Summary, schema: T.StructType) -> None:
    """Add the parts of loads that the sink has but the parts lack, from the sink's rows of each."""
    sink = next(sink for sink in flow.sinks if sink.name == summary.input)
    if sink.fmt in TRANSACTIONAL:
        return
    for load in sorted(_loads_at(spark, sink.paths[0]) - _loads_at(spark, summary.parts)):
        one = replace(sink, paths=(f"{sink.paths[0]}/{LOAD_COLUMN}={load}",))
        rows = read_sink(spark, replace(flow, sinks=(one,)), sink.name, schema)
        query_id, _, batch_id = load.rpartition("-")
        parts = partial_stats(rows, summary.by, summary.value)
        write_load(parts, PathSink(summary.parts, summary.fmt), query_id, int(batch_id))


def _summarise(spark: SparkSession, flow: Dataflow, schemas, options: RunOptions) -> None:
    for summary in flow.summaries:
        schema = schemas[summary.input]
        names = {"count_as": summary.count_as, "mean_as": summary.mean_as}
        if summary.parts:
            if options.execution == "stream":
                _complete_parts(spark, flow, summary, schema)
            shape = spark.createDataFrame([], schema)
            schema = partial_stats(shape, summary.by, summary.value).schema
            if options.execution == "stream":
                parts = read_loads(spark, summary.parts, schema, fmt=summary.fmt)
            else:
                parts = spark.read.format(summary.fmt).schema(schema).load(summary.parts)
            result = merge_stats(parts, summary.by, **names)
        else:
            rows = read_sink(spark, flow, summary.input, schema, execution=options.execution)
            result = grouped_stats(rows, summary.by, summary.value, **names)
        if summary.table:
            overwrite_table(result, summary.table, fmt=summary.fmt)
        if summary.path:
            write_path(result, summary.path, fmt=summary.fmt, mode="overwrite")


def _location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(base_of(spark, table))}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def _check_places(
    spark: SparkSession, flow: Dataflow, checkpoint: str | None, audit_path: str | None, audit_table: str | None
) -> None:
    """Nothing that is written may be, hold or lie in a source or anything else that is written.

    Places are compared as their file systems know them; a source given as a glob counts from the
    directory before its first wildcard.
    """
    read = [(f"source {s.name!r}", s.path) for s in flow.sources]
    written = [(f"sink {s.name!r}", path) for s in flow.sinks for path in s.paths]
    for s in flow.summaries:
        written += [(f"summary {s.name!r}", path) for path in (s.path, s.parts) if path]
        if s.table:
            written.append((f"table {s.table!r}", _location(spark, s.table)))
    written += [("the audit path", audit_path), ("the checkpoint", checkpoint)]
    if audit_table:
        written.append((f"table {audit_table!r}", _location(spark, audit_table)))
    places = [(owner, qualified_path(spark, path).rstrip("/") + "/") for owner, path in read]
    for owner, path in written:
        if path is None:
            continue
        place = qualified_path(spark, path).rstrip("/") + "/"
        for other, taken in places:
            hidden = owner == "the checkpoint" and place.startswith(taken) and other.startswith("source")
            if hidden and place[len(taken) :].startswith(("_", ".")):
                continue  # sources do not read such directories
            if place.startswith(taken) or taken.startswith(place):
                raise ContractError(f"{owner} and {other} share the place {path!r}")
        places.append((owner, place))


def audit_record(spark: SparkSession, report: RunReport, at: datetime | None = None) -> DataFrame:
    """The one-row audit record of a run."""
    row = (
        report.name,
        report.environment,
        report.rows_ok,
        report.rows_ko,
        at or datetime.now(timezone.utc),
        round(report.seconds, 2),
        report.status,
    )
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def _audit(spark: SparkSession, report: RunReport, checkpoint: str | None, table: str | None, path: str | None) -> None:
    """Append the audit record of a run to each place that wants one.

    Incremental runs account for committed loads, each of them once (:mod:`rowsieve.plans.ledger`), also for those of
    a run that ended before its record was written.
    """

    def append_to(kind: str, place: str, facts: dict) -> None:
        held = RunReport(**{key: value for key, value in facts.items() if key != "at"})
        row = audit_record(spark, held, datetime.fromisoformat(facts["at"]))
        if kind == "table":
            append_table(row, place, merge_schema=True)
        else:
            write_path(row, place, mode="append")

    def is_at(kind: str, place: str, facts: dict) -> bool:
        if kind == "table":
            if not spark.catalog.tableExists(place):
                return False
            rows = spark.table(place)
        else:
            if not path_exists(spark, place):
                return False
            rows = spark.read.schema(AUDIT_SCHEMA).parquet(place)
        same = (F.col("pipeline_name") == facts["name"]) & (F.col("execution_timestamp") == F.lit(datetime.fromisoformat(facts["at"])))
        return not rows.where(same).isEmpty()

    places = [(kind, place) for kind, place in (("table", table), ("path", path)) if place]
    if not places:
        return
    facts = {"name": report.name, "environment": report.environment, "rows_ok": report.rows_ok, "rows_ko": report.rows_ko}
    facts |= {"seconds": report.seconds, "status": report.status, "at": datetime.now(timezone.utc).isoformat()}
    if checkpoint is None:
        for kind, place in places:
            append_to(kind, place, facts)
        return

    def missing(facts: dict) -> list[tuple[str, str]]:
        return [(kind, place) for kind, place in places if not is_at(kind, place, facts)]

    def append(facts: dict) -> None:
        for kind, place in missing(facts):
            append_to(kind, place, facts)

    ledger = Ledger(spark, checkpoint)
    ledger.recover(lambda facts: not missing(facts), append)
    entries = ledger.committed()
    facts |= {"rows_ok": sum(e.rows_ok for e in entries), "rows_ko": sum(e.rows_ko for e in entries)}
    # A new record is nowhere yet.
    ledger.record(facts, entries, lambda facts: False, lambda facts: [append_to(*place, facts) for place in places])


def run(
    flow: Dataflow,
    spark: SparkSession,
    params: Mapping[str, str] | None = None,
    *,
    audit_table: str | None = None,
    audit_path: str | None = None,
    **options,
) -> RunReport:
    """Run a dataflow and give its report.

    ``execution="stream"`` (default) processes the files that are new since the last run with
    the same ``checkpoint`` directory; "batch" reads the whole source. Sinks keep their declared
    format unless ``table_format`` replaces it. ``schemas`` fixes the schema of a source by
    name, else the contract's counts, else it is inferred. ``processing_time`` ("string",
    "timestamp" or None) adds ``dt`` before validation. ``trace``, ``code_style``, ``nulls``
    and ``on_unknown`` go to the validate steps.

    The audit row is also written for a failed run, which is raised afterwards.
    """
    settings = RunOptions(**options)
    if settings.execution not in ("stream", "batch"):
        raise ValueError(f"execution must be 'stream' or 'batch', not {settings.execution!r}")
    if settings.execution == "stream" and not settings.checkpoint:
        raise ValueError("incremental execution needs a checkpoint directory")
    if settings.table_format:
        flow = replace(
            flow, sinks=tuple(replace(sink, fmt=settings.table_format) for sink in flow.sinks)
        )
    _check_places(spark, flow, settings.checkpoint if settings.execution == "stream" else None, audit_path, audit_table)
    report = RunReport(flow.name, (params or {}).get(ENVIRONMENT, "default"))
    started = time.monotonic()
    try:
        schemas: dict[str, T.StructType] = {}
        for source in flow.sources:
            if any(flow.origin(sink.input) == source.name for sink in flow.sinks):
                schemas |= _load_source(spark, flow, source, settings, report)
        _summarise(spark, flow, schemas, settings)
        for sink in flow.sinks:
            if sink.table:
                partitioned = settings.execution == "stream"
                register_loads(
                    spark,
                    sink.table,
                    sink.paths[0],
                    schemas[sink.name],
                    fmt=sink.fmt,
                    partitioned=partitioned,
                    # Also those of a run that ended before it came to this.
                    loads=() if sink.mode == "append" else None,
                )
    except Exception:
        report.status = "failed"
        raise
    finally:
        report.seconds = time.monotonic() - started
        _audit(spark, report, settings.checkpoint if settings.execution == "stream" else None, audit_table, audit_path)
    return report
