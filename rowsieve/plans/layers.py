"""Named datasets, each a table made from the ones before it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import quote_name, quote_part, quote_text
from rowsieve.operators.aggregate import grouped_stats, merge_stats, partial_stats
from rowsieve.operators.governance import base_of, rebind
from rowsieve.operators.metrics import observe_rules, observed_failures, watch_rules
from rowsieve.operators.rules import Rule, compile_rules, fingerprint
from rowsieve.operators.split import TRACE_COLUMN, annotate, rejected_rows, valid_rows
from rowsieve.sinks.tables import DEFAULT_FORMAT, overwrite_table, set_comment
from rowsieve.sources.files import move, names_at, path_exists, read_text, remove, write_text
from rowsieve.streaming.loads import (
    KO,
    LOAD_COLUMN,
    OK,
    VERDICT_COLUMN,
    Failures,
    PathSink,
    add_failures,
    append_stream,
    drain,
    read_loads,
    read_side,
    register_store,
    unfinished,
    write_judged,
    write_load,
    write_store,
)


@dataclass(frozen=True)
class Layer:
    """``build`` gets the tables named in ``inputs`` and gives this layer's rows.

    A ``stream`` layer appends what is new in its streaming frame; any other is computed anew
    from its inputs. ``expectations`` (rules, or a function of the frame that gives them) drop
    the rows that break one, and are counted; on a stream, for the batches of this refresh.
    """

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    comment: str = ""
    stream: bool = False
    expectations: Sequence[Rule] | Callable[[DataFrame], Sequence[Rule]] | None = None


@dataclass(frozen=True)
class SplitLayer:
    """Valid and rejected rows of a table, and a summary of the valid ones, from new rows only.

    A refresh reads what was added to ``input`` since the last one, once, and writes it once, into a
    store with a partition for each side. ``ok`` and ``ko`` are views of it; every load adds its
    part of the summary, and ``gold`` is merged from the parts. The store knows the rules by which it was judged:
    when they have changed, a refresh first judges its rows again and replaces the parts.
    """

    input: str
    ok: str
    ko: str
    gold: str
    rules: Callable[[DataFrame], Sequence[Rule]]
    by: str
    value: str
    comments: tuple[str, str, str] = ("", "", "")

    @property
    def name(self) -> str:
        return self.ok


@dataclass
class LayerReport:
    name: str
    rows: int | None = None
    dropped: int = 0
    failures: Failures = field(default_factory=dict)
    #: Whether earlier rows were judged again, as the rules had changed.
    rejudged: bool = False


def expect_all_or_drop(
    df: DataFrame, rules: Sequence[Rule]
) -> tuple[DataFrame, Callable[[], Mapping[str, int]]]:
    """Keep rows that meet every expectation, and count failures per rule on the way.

    The counts need the dropped rows too, so this reads all of ``df``; without a need for
    counts use :func:`rowsieve.operators.split.valid_rows`, which pushes the rules down.
    """
    observed, observation = observe_rules(df, rules, f"expect-{uuid.uuid4()}")
    return valid_rows(observed, rules), lambda: observation.get


def _rejudge(spark: SparkSession, layer: SplitLayer, rules: Sequence[Rule], store: PathSink, parts: PathSink, shape, staging: str) -> bool:
    """Judge the store's loads again if they were judged by other rules, in one pass; whether they were.

    What is judged anew is written beside the store, verdicts and parts of all loads, and then takes the old
    loads' places. A run that ends in between leaves the old fingerprint, so the next one starts over, first
    putting back into place what was complete.
    """
    note, new = f"{store.path}/_rules.json", fingerprint(rules)
    ready = f"{staging}/ready.json"
    if path_exists(spark, ready):
        was = read_text(spark, ready)
        _take_places(spark, staging, store, parts)
        write_text(spark, note, was)
    known = read_text(spark, note) if path_exists(spark, note) else None
    loads = [name for name in names_at(spark, store.path) if name.startswith(f"{LOAD_COLUMN}=")]
    if known == new:
        return False
    if not loads:
        write_text(spark, note, new)
        return False
    remove(spark, staging)
    layout = T.StructType([T.StructField(name, T.StringType()) for name in (LOAD_COLUMN, VERDICT_COLUMN)])
    rows = spark.read.format(store.fmt).schema(T.StructType([*shape.fields, *layout.fields])).load(store.path)
    hidden = unfinished(spark, store.path)
    rows = rows.where(~F.col(LOAD_COLUMN).isin(hidden)).drop(VERDICT_COLUMN, TRACE_COLUMN)
    write_judged(annotate(rows, rules, kind="array"), f"{staging}/rows", fmt=store.fmt)
    judged = spark.read.format(store.fmt).schema(T.StructType([*shape.fields, *layout.fields])).load(f"{staging}/rows")
    valid = judged.where(F.col(VERDICT_COLUMN) == OK)
    by = [LOAD_COLUMN, layer.by]
    partial_stats(valid, by, layer.value).write.format(parts.fmt).partitionBy(LOAD_COLUMN).save(f"{staging}/parts")
    write_text(spark, ready, new)
    _take_places(spark, staging, store, parts)
    write_text(spark, note, new)
    return True


def _take_places(spark: SparkSession, staging: str, store: PathSink, parts: PathSink) -> None:
    hidden = {f"{LOAD_COLUMN}={load}" for load in unfinished(spark, store.path)}
    # A load without valid rows has no part any more.
    for sink, kind in ((parts, "parts"), (store, "rows")):
        judged = {name for name in names_at(spark, f"{staging}/{kind}") if name.startswith(f"{LOAD_COLUMN}=")}
        gone = {name for name in names_at(spark, sink.path) if name.startswith(f"{LOAD_COLUMN}=")} - judged - hidden
        for name in sorted(gone) if kind == "parts" and not path_exists(spark, f"{staging}/parts-gone") else ():
            remove(spark, f"{sink.path}/{name}")
        if kind == "parts":
            write_text(spark, f"{staging}/parts-gone", "")
        for name in sorted(judged):
            remove(spark, f"{sink.path}/{name}")
            move(spark, f"{staging}/{kind}/{name}", f"{sink.path}/{name}")
    remove(spark, staging)


def _refresh_split(spark: SparkSession, layer: SplitLayer, *, namespace: str, checkpoint: str, fmt: str) -> list[LayerReport]:
    source = base_of(spark, f"{namespace}.{layer.input}")
    rows = spark.table(source)
    rules = layer.rules(rows)
    shape = annotate(rows, rules, kind="array")
    place = spark.catalog.getDatabase(namespace).locationUri.rstrip("/")
    store = PathSink(f"{place}/{layer.ok}_store", fmt)
    parts = PathSink(f"{place}/{layer.gold}_parts", fmt)
    report = LayerReport(layer.ok, rows=0)
    progress = f"{checkpoint.rstrip('/')}/{layer.ok}"
    report.rejudged = _rejudge(spark, layer, rules, store, parts, shape.schema, f"{progress}-judged-again")

    def each_batch(batch: DataFrame, query_id: str, batch_id: int) -> None:
        observed, observation = observe_rules(batch, rules, f"layer-{uuid.uuid4()}")
        load = write_store(annotate(observed, rules, kind="array"), store, query_id, batch_id, checkpoint=progress)
        counts = observation.get
        report.rows += counts["rows"] - counts["rows_ko"]
        report.dropped += counts["rows_ko"]
        add_failures(report.failures, observed_failures(counts, rules))
        valid = read_side(
            spark, f"{store.path}/{LOAD_COLUMN}={load}", OK, rows.schema, trace_type="array<string>", fmt=fmt
        )
        write_load(partial_stats(valid, layer.by, layer.value), parts, query_id, batch_id, checkpoint=progress)

    drain(spark.readStream.table(source), progress, each_batch)
    kept = f"{namespace}.{layer.ok}_rows"
    # New loads only, unless old ones were replaced.
    register_store(spark, kept, store.path, shape.schema, fmt=fmt, loads=None if report.rejudged else ())
    for view, side, columns, comment in (
        (layer.ok, OK, rows.columns, layer.comments[0]),
        (layer.ko, KO, shape.columns, layer.comments[1]),
    ):
        shown = ", ".join(map(quote_part, columns))
        spark.sql(
            f"CREATE OR REPLACE VIEW {quote_name(base_of(spark, f'{namespace}.{view}'))} COMMENT {quote_text(comment)} AS "
            f"SELECT {shown} FROM {quote_name(kept)} WHERE {VERDICT_COLUMN} = {quote_text(side)}"
        )
        rebind(spark, f"{namespace}.{view}")
    part = partial_stats(rows.limit(0), layer.by, layer.value).schema
    gold = merge_stats(read_loads(spark, parts.path, part, fmt=fmt), layer.by)
    overwrite_table(gold, f"{namespace}.{layer.gold}", fmt=fmt, comment=layer.comments[2])
    return [report, LayerReport(layer.ko), LayerReport(layer.gold)]


def _add_counts(report: LayerReport, seen: Mapping[str, int], rules: Sequence[Rule]) -> None:
    report.dropped = seen.get("rows_ko", 0)
    report.rows = seen.get("rows", 0) - report.dropped
    report.failures = observed_failures(seen, rules)


def refresh(
    spark: SparkSession,
    layers: Sequence[Layer | SplitLayer],
    *,
    namespace: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
) -> list[LayerReport]:
    """Bring the tables ``namespace.<layer>`` up to date, in the order given."""
    reports, known = [], set()
    for layer in layers:
        if isinstance(layer, SplitLayer):
            if layer.input not in known:
                raise ValueError(f"layer {layer.name!r} uses {layer.input!r}, which comes later or never")
            known |= {layer.ok, layer.ko, layer.gold}
            reports += _refresh_split(spark, layer, namespace=namespace, checkpoint=checkpoint, fmt=fmt)
            continue
        missing = [name for name in layer.inputs if name not in known]
        if missing:
            raise ValueError(f"layer {layer.name!r} uses {missing}, which come later or never")
        known.add(layer.name)
        table = f"{namespace}.{layer.name}"
        frame = layer.build(*[spark.table(base_of(spark, f"{namespace}.{name}")) for name in layer.inputs])
        report = LayerReport(layer.name)
        rules = layer.expectations(frame) if callable(layer.expectations) else layer.expectations
        if layer.stream:
            counts = None
            if rules is not None:
                frame, counts = watch_rules(frame, rules, f"expect-{layer.name}")
                frame = valid_rows(frame, rules)
            append_stream(frame, table, f"{checkpoint.rstrip('/')}/{layer.name}", fmt=fmt, counts=counts)
            if counts is not None:
                _add_counts(report, counts.get, rules)
            set_comment(spark, base_of(spark, table), layer.comment)
            spark.catalog.refreshTable(base_of(spark, table))
        else:
            if rules is None:
                overwrite_table(frame, table, fmt=fmt, comment=layer.comment)
            else:
                kept, counts = expect_all_or_drop(frame, rules)
                overwrite_table(kept, table, fmt=fmt, comment=layer.comment)
                _add_counts(report, counts(), rules)
        reports.append(report)
    return reports


def quality_layers(
    entity: str,
    read: Callable[[], DataFrame],
    validations: Sequence[Mapping],
    *,
    by: str,
    value: str,
    nulls: str = "pass",
    full: bool = False,
) -> list[Layer | SplitLayer]:
    """raw → ok / ko → gold for one entity, with qualified codes and an array trace.

    ``read`` gives the raw stream. ok and ko come from the same rules under one null policy,
    so together they are exactly the raw rows. A refresh handles new rows only; ``full`` computes
    ok, ko and gold from all raw rows each time, as tables, such as after a change of the rules.
    The two kinds need namespaces of their own.
    """

    def rules(frame: DataFrame) -> list[Rule]:
        return compile_rules(frame, validations, code_style="qualified", nulls=nulls)

    raw, ok, ko = f"{entity}_raw", f"{entity}_standard_ok", f"{entity}_standard_ko"
    landed = Layer(
        raw,
        lambda: read().withColumn("dt", F.current_timestamp()),
        comment=f"Raw {entity} records as they arrived",
        stream=True,
    )
    if not full:
        comments = (
            f"{entity} records that meet every rule",
            f"{entity} records that break a rule, with the codes of those",
            f"Valid {entity} records per {by}",
        )
        return [landed, SplitLayer(raw, ok, ko, f"{entity}_gold_{by}_stats", rules, by, value, comments)]
    return [
        landed,
        Layer(
            ok,
            lambda rows: rows,
            (raw,),
            comment=f"{entity} records that meet every rule",
            expectations=rules,
        ),
        Layer(
            ko,
            lambda rows: rejected_rows(rows, rules(rows), kind="array"),
            (raw,),
            comment=f"{entity} records that break a rule, with the codes of those",
        ),
        Layer(
            f"{entity}_gold_{by}_stats",
            lambda rows: grouped_stats(rows, by, value),
            (ok,),
            comment=f"Valid {entity} records per {by}",
        ),
    ]
