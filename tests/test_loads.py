import pytest

from rowsieve.functions.people import PERSON_SCHEMA, people_from_ids
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import TRACE_COLUMN, split
from rowsieve.sources.files import file_stream, read_files
from rowsieve.streaming.loads import (
    LOAD_COLUMN,
    PathSink,
    append_stream,
    drain,
    read_loads,
    read_side,
    split_batch,
    split_store,
    split_stream,
    write_load,
)

from conftest import multiset

KO_SCHEMA = f"name STRING, age INT, office STRING, {TRACE_COLUMN} MAP<STRING,STRING>"


@pytest.fixture
def landing(spark, tmp_path):
    def arrive(first, last, files=2):
        rows = people_from_ids(spark.range(first, last, 1, files))
        rows.write.mode("append").json(str(tmp_path / "in"))

    arrive(0, 600)
    arrive.path = str(tmp_path / "in")
    return arrive


def stream_of(spark, landing, **options):
    return file_stream(spark, f"{landing.path}/*", PERSON_SCHEMA, options=options)


def loads_of(path):
    return sorted(p.name for p in path.glob(f"{LOAD_COLUMN}=*"))


@pytest.mark.parametrize("kind", ["sinks", "store"])
def test_only_new_files_are_loaded(spark, landing, tmp_path, rules, kind):
    stream = stream_of(spark, landing)
    compiled = compile_rules(stream, rules)
    checkpoint = str(tmp_path / "checkpoint")
    ok, ko = PathSink(str(tmp_path / "ok"), mode="overwrite"), PathSink(str(tmp_path / "ko"))

    def load():
        if kind == "store":
            return split_store(stream, compiled, PathSink(str(tmp_path / "store")), checkpoint)
        return split_stream(stream, compiled, ok, ko, checkpoint)

    def sides():
        if kind == "store":
            store = str(tmp_path / "store")
            return (
                read_side(spark, store, "ok", PERSON_SCHEMA),
                read_side(spark, store, "ko", PERSON_SCHEMA),
            )
        return read_loads(spark, ok.path, PERSON_SCHEMA), read_loads(spark, ko.path, KO_SCHEMA)

    first = load()
    assert first.rows_ok + first.rows_ko == 600 and len(first.loads) == 1
    again = load()
    assert again.rows_ok + again.rows_ko == 0 and again.loads == []
    landing(600, 1000)
    second = load()
    assert second.rows_ok + second.rows_ko == 400

    batch = read_files(spark, landing.path, PERSON_SCHEMA)
    expected = split(batch, compile_rules(batch, rules))
    found = sides()
    assert multiset(found[0]) == multiset(expected.ok)
    assert multiset(found[1]) == multiset(expected.ko)
    assert found[0].count() == first.rows_ok + second.rows_ok
    assert sum(first.failures.values()) >= first.rows_ko


def test_a_drain_takes_as_many_batches_as_it_needs(spark, landing, tmp_path, rules):
    landing(600, 900, files=3)
    stream = stream_of(spark, landing, maxFilesPerTrigger=1)
    report = split_store(
        stream, compile_rules(stream, rules), PathSink(str(tmp_path / "s")), str(tmp_path / "c")
    )
    assert len(report.loads) == 5 and report.rows_ok + report.rows_ko == 900


def test_a_failed_batch_is_repeated_without_duplicates(spark, landing, tmp_path):
    stream = stream_of(spark, landing, maxFilesPerTrigger=1)
    sink, checkpoint = PathSink(str(tmp_path / "rows"), mode="overwrite"), str(tmp_path / "c")

    def failing(batch, query_id, batch_id):
        write_load(batch, sink, query_id, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        drain(stream, checkpoint, failing)
    assert read_loads(spark, sink.path, PERSON_SCHEMA).count() == 600
    drain(stream, checkpoint, lambda batch, q, i: write_load(batch, sink, q, i))
    rows = read_loads(spark, sink.path, PERSON_SCHEMA)
    assert rows.count() == 600 and rows.distinct().count() == 600
    assert len(loads_of(tmp_path / "rows")) == 2


def test_a_replay_clears_a_side_that_became_empty(spark, people, tmp_path):
    sink = PathSink(str(tmp_path / "rows"))
    write_load(people, sink, "q", 1)
    write_load(people.filter("false"), sink, "q", 1)
    assert read_loads(spark, sink.path, people.schema).count() == 0


def test_overwrite_means_the_loads_of_this_checkpoint(spark, landing, tmp_path):
    def load(sink, checkpoint):
        drain(
            stream_of(spark, landing, maxFilesPerTrigger=1),
            str(tmp_path / checkpoint),
            lambda batch, q, i: write_load(batch, sink, q, i),
        )
        return read_loads(spark, sink.path, PERSON_SCHEMA).count()

    replaced = PathSink(str(tmp_path / "replaced"), mode="overwrite")
    kept = PathSink(str(tmp_path / "kept"), mode="append")
    assert load(replaced, "a") == 600 and load(kept, "b") == 600
    assert load(replaced, "c") == 600, "a new checkpoint starts over"
    assert load(kept, "d") == 1200, "append keeps what others wrote"
    landing(600, 700)
    assert load(replaced, "c") == 700, "later batches add to it"
    with pytest.raises(ValueError, match="mode"):
        PathSink("/x", mode="merge")


def test_no_rules_on_a_stream(spark, landing, tmp_path):
    stream = stream_of(spark, landing)
    result = split(stream, [])
    assert result.ko.isStreaming
    append_stream(result.ko, "no_rules_ko", str(tmp_path / "c"))
    assert spark.table("no_rules_ko").count() == 0
    report = split_store(stream, [], PathSink(str(tmp_path / "store")), str(tmp_path / "c2"))
    assert (report.rows_ok, report.rows_ko, report.failures) == (600, 0, {})
    assert read_side(spark, str(tmp_path / "store"), "ko", PERSON_SCHEMA).count() == 0


def test_streaming_frames_can_be_split_directly(spark, landing, tmp_path, rules, database):
    stream = stream_of(spark, landing)
    result = split(stream, compile_rules(stream, rules), kind="full")
    append_stream(result.ok, f"{database}.ok", str(tmp_path / "c1"), name="ok")
    append_stream(result.ko, f"{database}.ko", str(tmp_path / "c2"))
    rows = spark.table(f"{database}.ok").count() + spark.table(f"{database}.ko").count()
    assert rows == 600
    append_stream(result.ok, f"{database}.ok", str(tmp_path / "c1"), name="ok")
    assert spark.table(f"{database}.ok").count() + spark.table(f"{database}.ko").count() == 600


def test_batch_store(spark, people, tmp_path, rules):
    compiled = compile_rules(people, rules)
    for _ in range(2):
        split_batch(people, compiled, PathSink(str(tmp_path / "store")), kind="array")
    ko = read_side(spark, str(tmp_path / "store"), "ko", people.schema, trace_type="array<string>")
    assert multiset(ko) == multiset(split(people, compiled, kind="array").ko)
    with pytest.raises(ValueError):
        read_side(spark, str(tmp_path / "store"), "both", people.schema)


def test_observed_metrics_on_a_stream(spark, landing, tmp_path, rules):
    from rowsieve.operators.metrics import observe_rules

    stream = stream_of(spark, landing)
    observed, observation = observe_rules(stream, compile_rules(stream, rules), "checks")
    assert observation is None
    query = (
        observed.writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    seen = [p.observedMetrics["checks"] for p in query.recentProgress if "checks" in p.observedMetrics]
    assert sum(row["rows"] for row in seen) == 600


def test_the_session_keeps_its_settings(spark, people, tmp_path, rules):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    split_batch(people, compile_rules(people, rules), PathSink(str(tmp_path / "store")))
    assert spark.conf.get(key) == before
