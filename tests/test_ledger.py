"""Audit records and what shows of a batch, whatever a run ends in the middle of."""

import pytest

from rowsieve.plans import dataflow
from rowsieve.plans.contract import parse_contract
from rowsieve.plans.dataflow import run
from rowsieve.plans.ledger import Entry, Ledger
from rowsieve.sources.files import write_text
from rowsieve.streaming.loads import PathSink, announce, drain, read_loads, register_loads, split_stream, unfinished, write_load

RULES = [{"field": "age", "validations": ["notNull"]}]
SCHEMA = "name STRING, age INT"


@pytest.fixture
def flow(tmp_path):
    (tmp_path / "in").mkdir()
    spec = {
        "name": "f",
        "sources": [{"name": "rows", "path": str(tmp_path / "in")}],
        "transformations": [{"name": "checks", "type": "validate_fields", "params": {"validations": RULES}}],
        "sinks": [{"name": side, "input": f"checks_{side}", "paths": [str(tmp_path / side)], "format": "parquet"} for side in ("ok", "ko")],
    }
    return parse_contract(spec)


@pytest.fixture
def go(spark, flow, tmp_path):
    def start(**more):
        places = {"audit_path": str(tmp_path / "audit"), "checkpoint": str(tmp_path / "checkpoint")} | more
        return run(flow, spark, schemas={"rows": SCHEMA}, processing_time=None, **places)

    return start


def arrive(tmp_path, name, *rows):
    (tmp_path / "in" / name).write_text("\n".join(rows))


def sums(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "audit")).collect()
    return sum(r.rows_ok for r in rows), sum(r.rows_ko for r in rows), sorted(r.status for r in rows)


def shown(spark, tmp_path, side):
    return sorted(r.name for r in read_loads(spark, str(tmp_path / side), SCHEMA).collect())


def test_a_batch_that_fails_after_its_entry_counts_once(spark, go, tmp_path, monkeypatch):
    arrive(tmp_path, "a.json", '{"name": "ada", "age": 1}', '{"name": "bo"}')
    with monkeypatch.context() as broken:
        write = Ledger.write
        broken.setattr(Ledger, "write", lambda self, entry: (write(self, entry), 1 / 0))
        with pytest.raises(Exception, match="division by zero"):
            go()
    assert sums(spark, tmp_path) == (0, 0, ["failed"])
    assert shown(spark, tmp_path, "ok") == shown(spark, tmp_path, "ko") == []
    assert go().rows_ok == 1
    assert sums(spark, tmp_path) == (1, 1, ["failed", "ok"])
    assert (shown(spark, tmp_path, "ok"), shown(spark, tmp_path, "ko")) == (["ada"], ["bo"])
    go()
    assert sums(spark, tmp_path) == (1, 1, ["failed", "ok", "ok"])


def test_a_run_that_ends_before_its_record_is_accounted_for_by_the_next(spark, go, tmp_path, monkeypatch):
    arrive(tmp_path, "a.json", '{"name": "ada", "age": 1}')
    with monkeypatch.context() as broken:
        broken.setattr(dataflow, "_audit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            go()
    arrive(tmp_path, "b.json", '{"name": "cy", "age": 1}', '{"name": "di"}')
    go()
    assert sums(spark, tmp_path) == (2, 1, ["ok"])


@pytest.mark.parametrize("appended", [True, False])
def test_a_record_that_was_pending_is_appended_once(spark, go, tmp_path, monkeypatch, appended):
    arrive(tmp_path, "a.json", '{"name": "ada", "age": 1}')
    with monkeypatch.context() as broken:
        if appended:
            broken.setattr(Ledger, "_settle", lambda self, loads: 1 / 0)
        else:
            broken.setattr(dataflow, "write_path", lambda *a, **k: 1 / 0)
            broken.setattr(dataflow._Target, "write", lambda self, df, sink: write_load(df, sink, self.query_id, self.batch_id))
        with pytest.raises(ZeroDivisionError):
            go()
    go()
    assert sums(spark, tmp_path) == (1, 0, ["ok", "ok"])


def test_both_places_of_an_audit_agree(spark, go, tmp_path, database):
    arrive(tmp_path, "a.json", '{"name": "ada", "age": 1}')
    go(audit_table=f"{database}.audit")
    go(audit_table=f"{database}.audit")
    assert [r.rows_ok for r in spark.table(f"{database}.audit").orderBy("execution_timestamp").collect()] == [1, 0]
    assert sums(spark, tmp_path) == (1, 0, ["ok", "ok"])


def test_an_entry_is_what_it_was(spark, tmp_path):
    entry = Entry("rows", "q-3", 5, 2, {("age", "notNull"): 2})
    assert Entry.of(entry.text()) == entry and entry.batch == 3
    ledger = Ledger(spark, str(tmp_path))
    ledger.write(entry)
    ledger.write(Entry("rows", "q-3", 6, 0, {}))
    assert ledger.committed() == []  # nothing is, without a checkpoint of its source


def test_split_streams_show_committed_batches_only(spark, tmp_path, monkeypatch):
    from rowsieve.operators.rules import compile_rules
    from rowsieve.streaming import loads

    (tmp_path / "in").mkdir()
    arrive(tmp_path, "a.json", '{"name": "ada", "age": 1}', '{"name": "bo"}')
    rows = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
    rules = compile_rules(rows, RULES)
    ok, ko = (PathSink(str(tmp_path / side)) for side in ("ok", "ko"))
    write = loads.write_load

    def one_side(df, sink, *a, **k):
        return 1 / 0 if sink is ko else write(df, sink, *a, **k)

    with monkeypatch.context() as broken:
        broken.setattr(loads, "write_load", one_side)
        with pytest.raises(Exception, match="division by zero"):
            split_stream(rows, rules, ok, ko, str(tmp_path / "checkpoint"))
    assert len(unfinished(spark, ok.path)) == 1
    assert shown(spark, tmp_path, "ok") == []
    split_stream(rows, rules, ok, ko, str(tmp_path / "checkpoint"))
    assert (shown(spark, tmp_path, "ok"), shown(spark, tmp_path, "ko")) == (["ada"], ["bo"])


def test_tables_leave_out_what_may_be_half_written(spark, tmp_path, database):
    sink, checkpoint = PathSink(str(tmp_path / "rows")), str(tmp_path / "checkpoint")
    write_text(spark, f"{checkpoint}/commits/0", "v1")
    schema = spark.range(0).schema
    for batch in (0, 1):
        write_load(spark.range(3), sink, "q", batch, checkpoint=checkpoint)
    register_loads(spark, f"{database}.t", sink.path, schema)
    assert spark.table(f"{database}.t").count() == read_loads(spark, sink.path, schema).count() == 3
    write_text(spark, f"{checkpoint}/commits/1", "v1")
    register_loads(spark, f"{database}.t", sink.path, schema)
    assert spark.table(f"{database}.t").count() == read_loads(spark, sink.path, schema).count() == 6


def test_loads_without_a_checkpoint_show(spark, tmp_path):
    sink = PathSink(str(tmp_path / "rows"))
    write_load(spark.range(3), sink, "q", 0)
    assert unfinished(spark, sink.path) == []
    announce(spark, sink, "q", str(tmp_path / "gone"))
    assert read_loads(spark, sink.path, "id BIGINT").count() == 3


def test_a_sink_that_is_overwritten_knows_its_query(spark, tmp_path):
    (tmp_path / "in").mkdir()
    arrive(tmp_path, "a.json", '{"name": "ada", "age": 1}')
    rows = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
    sink, checkpoint = PathSink(str(tmp_path / "ok"), mode="overwrite"), str(tmp_path / "checkpoint")
    drain(rows, checkpoint, lambda batch, q, b: write_load(batch, sink, q, b, checkpoint=checkpoint))
    assert len(unfinished(spark, sink.path)) == 1
    assert shown(spark, tmp_path, "ok") == ["ada"]
