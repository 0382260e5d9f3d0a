"""Policies bound to tables themselves, and columns of rescued text under any name."""

import pytest
from pyspark.sql import functions as F

from rowsieve.names import LEFTOVER
from rowsieve.operators import governance
from rowsieve.operators.governance import (
    Hide,
    Mask,
    RowFilter,
    base_of,
    bind_policies,
    bound_policies,
    governed,
    rebind,
    unbind_policies,
)
from rowsieve.plans.layers import quality_layers, refresh
from rowsieve.sinks.tables import append_table, overwrite_table, write_clustered_table
from rowsieve.sources.rescue import rescue_lines
from rowsieve.streaming.loads import PathSink, append_stream, register_loads, write_load
from tests.conftest import plan_of

POLICIES = [Mask("name"), RowFilter("office"), Hide("age", "hr")]


@pytest.fixture
def person(people, database):
    append_table(people, f"{database}.person")
    return f"{database}.person"


def seen(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("name", "age", "office").collect()), key=str)


def test_a_bound_table_shows_what_its_policies_allow(spark, person):
    bind_policies(spark, person, POLICIES)
    assert seen(spark, person) == [("REDACTED_PII", None, "RIO")] * 2
    bind_policies(spark, person, POLICIES, groups=["admin", "hr"])
    assert len(seen(spark, person)) == 6
    assert bound_policies(spark, person) == (POLICIES, ["admin", "hr"])


def test_loads_go_on_under_the_tables_name(spark, person, people):
    bind_policies(spark, person, POLICIES)
    append_table(people.withColumn("team", F.lit("x")), person, merge_schema=True)
    assert spark.table(person).columns == ["name", "age", "office", "team"]
    assert len(seen(spark, person)) == 4
    overwrite_table(people.limit(1), person)
    assert seen(spark, person) == [("REDACTED_PII", None, "RIO")]
    write_clustered_table(people, person, "office")
    assert spark.table(base_of(spark, person)).count() == 6 and len(seen(spark, person)) == 2


def test_streams_and_registered_loads_go_on_too(spark, people, database, tmp_path):
    sink, name = PathSink(str(tmp_path / "rows")), f"{database}.person"
    register_loads(spark, name, sink.path, people.schema, loads=[write_load(people, sink, "q", 0)])
    bind_policies(spark, name, POLICIES)
    wider = people.withColumn("team", F.lit("x"))
    register_loads(spark, name, sink.path, wider.schema, loads=[write_load(wider, sink, "q", 1)])
    assert len(seen(spark, name)) == 4 and "team" in spark.table(name).columns
    people.write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema(people.schema).parquet(str(tmp_path / "in"))
    append_stream(rows, f"{database}.streamed", str(tmp_path / "checkpoint"))
    bind_policies(spark, f"{database}.streamed", POLICIES)
    people.write.mode("append").parquet(str(tmp_path / "in"))
    append_stream(rows, f"{database}.streamed", str(tmp_path / "checkpoint"))
    assert len(seen(spark, f"{database}.streamed")) == 4


def test_layers_write_what_is_hidden(spark, people, database, tmp_path):
    rules = [{"field": "age", "validations": ["notNull"]}]
    landing = str(tmp_path / "in")
    people.write.json(landing)

    def go():
        layers = quality_layers("person", lambda: spark.readStream.schema(people.schema).json(landing), rules, by="office", value="age")
        refresh(spark, layers, namespace=database, checkpoint=str(tmp_path / "checkpoint"))

    go()
    for name in ("person_raw", "person_standard_ok"):
        bind_policies(spark, f"{database}.{name}", [Mask("name")])
    people.write.mode("append").json(landing)
    go()
    assert {r.name for r in spark.table(f"{database}.person_standard_ok").collect()} == {"REDACTED_PII"}
    assert spark.table(f"{database}.person_standard_ok__base").where("name = 'ada'").count() == 2


def test_policies_that_do_not_fit_move_nothing(spark, person):
    with pytest.raises(ValueError, match="no text columns"):
        bind_policies(spark, person, [Mask("age")])
    assert base_of(spark, person) == person and bound_policies(spark, person) is None
    rebind(spark, person)
    unbind_policies(spark, person)
    assert spark.table(person).count() == 6


def test_binding_that_ended_in_the_middle_goes_on(spark, person):
    spark.sql(f"ALTER TABLE {person} RENAME TO {person}__base")
    bind_policies(spark, person, POLICIES)
    assert len(seen(spark, person)) == 2
    unbind_policies(spark, person)
    assert len(seen(spark, person)) == 6 and not spark.catalog.tableExists(f"{person}__base")


@pytest.mark.parametrize("step", ["move", "DROP", "CREATE"])
def test_a_managed_table_keeps_its_files_whatever_a_binding_ends_in(spark, people, database, monkeypatch, step):
    name = f"{database}.t"
    people.write.partitionBy("office").option("owner", "x").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('team' = 'a')")
    files = spark.table(name).inputFiles()
    with monkeypatch.context() as broken:
        if step == "move":
            broken.setattr(governance, "move", lambda *a: 1 / 0)
        else:
            sql = spark.sql
            broken.setattr(spark, "sql", lambda text, *a, **k: 1 / 0 if text.startswith(step) else sql(text, *a, **k), raising=False)
        with pytest.raises(ZeroDivisionError):
            bind_policies(spark, name, POLICIES)
    bind_policies(spark, name, POLICIES)
    assert sorted(spark.table(f"{name}__base").inputFiles()) == sorted(files)
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}__base").collect()}["team"] == "a"
    assert len(seen(spark, name)) == 2
    unbind_policies(spark, name)
    assert spark.table(name).count() == 6


def test_an_outsiders_plan_does_not_read_the_masked_column(spark, person):
    bind_policies(spark, person, POLICIES)
    plan = plan_of(spark.table(person))
    assert "ReadSchema: struct<office:string>" in plan and "EqualTo(office,RIO)" in plan


def test_rescued_text_is_known_by_its_comment(spark, database):
    lines = spark.createDataFrame([('{"name": "ada", "secret": 1}',), ("no json ada",)], "value STRING")
    rows = rescue_lines(lines, "name STRING", rescued="leftover", corrupt="bad").withColumnRenamed("leftover", "rest")
    assert rows.schema["rest"].metadata["comment"] == LEFTOVER
    assert {tuple(r) for r in governed(rows, [Mask("name")], []).collect()} == {("REDACTED_PII", None, None)}
    append_table(rows.select("name"), f"{database}.t", merge_schema=True)
    append_table(rows, f"{database}.t", merge_schema=True)
    shown = bind_policies(spark, f"{database}.t", [Mask("name")])
    assert {tuple(r) for r in shown.select("rest", "bad").collect()} == {(None, None)}
    kept = governed(rows, [Mask("name"), Hide("rest", "hr")], ["hr"]).where("rest is not null")
    assert kept.count() == 1  # a policy of its own says who sees it
