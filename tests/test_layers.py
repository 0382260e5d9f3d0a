import pytest
from pyspark.sql import functions as F

from rowsieve.functions.people import PERSON_SCHEMA, people_from_ids
from rowsieve.operators.aggregate import grouped_stats
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import TRACE_COLUMN, split
from rowsieve.plans import layers as layers_module
from rowsieve.plans.layers import Layer, quality_layers, refresh
from rowsieve.sources.files import file_stream, read_files

from conftest import multiset


@pytest.mark.parametrize("full", [False, True])
def test_layers_follow_the_input(spark, tmp_path, database, rules, full):
    path = str(tmp_path / "in")
    layers = quality_layers(
        "person", lambda: file_stream(spark, path, PERSON_SCHEMA), rules, by="office", value="age", full=full
    )
    seen = 0
    for first, last in ((0, 300), (300, 500)):
        people_from_ids(spark.range(first, last)).write.mode("append").json(path)
        reports = refresh(spark, layers, namespace=database, checkpoint=str(tmp_path / "c"))
        rows = read_files(spark, path, PERSON_SCHEMA)
        compiled = compile_rules(rows, rules, code_style="qualified")
        expected = split(rows, compiled, kind="array")
        table = {name: spark.table(f"{database}.person_{name}") for name in
                 ("raw", "standard_ok", "standard_ko", "gold_office_stats")}
        assert multiset(table["raw"].drop("dt")) == multiset(rows)
        assert multiset(table["standard_ok"].drop("dt")) == multiset(expected.ok)
        assert multiset(table["standard_ko"].drop("dt")) == multiset(expected.ko)
        assert multiset(table["gold_office_stats"]) == multiset(grouped_stats(expected.ok))
        ok_report = reports[1]
        new = 0 if full else seen
        assert ok_report.rows + ok_report.dropped == rows.count() - new
        if full:
            assert ok_report.rows == expected.ok.count() and ok_report.dropped == expected.ko.count()
        seen = rows.count()
        assert set(ok_report.failures) == {(rule.field, rule.code) for rule in compiled}
    assert dict(table["standard_ko"].dtypes) == {
        "name": "string", "age": "int", "office": "string", "dt": "timestamp", TRACE_COLUMN: "array<string>",
    }
    comments = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.person_standard_ko")
    comment = comments.filter(F.col("col_name") == "Comment").collect()[0]["data_type"]
    assert "break a rule" in comment


def test_order_matters(spark, tmp_path, database):
    layers = [Layer("b", lambda a: a, ("a",)), Layer("a", lambda: spark.range(3))]
    with pytest.raises(ValueError, match="later or never"):
        refresh(spark, layers, namespace=database, checkpoint=str(tmp_path))
    refresh(spark, layers[::-1], namespace=database, checkpoint=str(tmp_path))
    assert spark.table(f"{database}.b").count() == 3


def go(spark, database, tmp_path, rules):
    path = str(tmp_path / "in")
    layers = quality_layers("person", lambda: file_stream(spark, path, PERSON_SCHEMA), rules, by="office", value="age")
    return refresh(spark, layers, namespace=database, checkpoint=str(tmp_path / "c"))


def agrees(spark, database, tmp_path, rules):
    """Whether all three tables are what the rules make of all input."""
    rows = read_files(spark, str(tmp_path / "in"), PERSON_SCHEMA)
    expected = split(rows, compile_rules(rows, rules, code_style="qualified"), kind="array")
    table = {name: spark.table(f"{database}.person_{name}") for name in ("standard_ok", "standard_ko", "gold_office_stats")}
    assert multiset(table["standard_ok"].drop("dt")) == multiset(expected.ok)
    assert multiset(table["standard_ko"].drop("dt")) == multiset(expected.ko)
    assert multiset(table["gold_office_stats"]) == multiset(grouped_stats(expected.ok))


NONE = [{"field": "age", "sql_expressions": [{"error_code": "none", "expression": "age < 0"}], "null_policy": "fail"}]


def test_changed_rules_judge_all_rows_again(spark, tmp_path, database, rules):
    people_from_ids(spark.range(300)).write.json(str(tmp_path / "in"))
    assert not go(spark, database, tmp_path, rules)[1].rejudged
    assert not go(spark, database, tmp_path, rules)[1].rejudged
    people_from_ids(spark.range(300, 400)).write.mode("append").json(str(tmp_path / "in"))
    for changed in (NONE, rules[:1], rules):  # no row is accepted, some are, as before
        assert go(spark, database, tmp_path, changed)[1].rejudged
        agrees(spark, database, tmp_path, changed)


@pytest.mark.parametrize("calls", range(7))
def test_judging_again_goes_on_where_a_run_ended(spark, tmp_path, database, rules, monkeypatch, calls):
    for ids in (spark.range(100), spark.range(100, 200)):
        people_from_ids(ids).write.mode("append").json(str(tmp_path / "in"))
        go(spark, database, tmp_path, rules)
    people_from_ids(spark.range(200, 250)).write.mode("append").json(str(tmp_path / "in"))
    done = []

    def some(work):
        def call(*a):
            done.append(work)
            return 1 / 0 if len(done) > calls else work(*a)

        return call

    with monkeypatch.context() as broken:
        for name in ("move", "remove"):
            broken.setattr(layers_module, name, some(getattr(layers_module, name)))
        try:
            go(spark, database, tmp_path, rules[:1])
        except ZeroDivisionError:
            pass
    go(spark, database, tmp_path, rules[:1])
    agrees(spark, database, tmp_path, rules[:1])


def test_a_refresh_lists_new_loads_only(spark, tmp_path, database, rules, monkeypatch):
    people_from_ids(spark.range(100)).write.json(str(tmp_path / "in"))
    go(spark, database, tmp_path, rules)
    people_from_ids(spark.range(100, 200)).write.mode("append").json(str(tmp_path / "in"))
    sql, said = spark.sql, []
    monkeypatch.setattr(spark, "sql", lambda text, *a, **k: (said.append(text), sql(text, *a, **k))[1], raising=False)
    go(spark, database, tmp_path, rules)
    assert not any("MSCK" in text for text in said)
    assert sum("ADD IF NOT EXISTS" in text for text in said) == 1
    agrees(spark, database, tmp_path, rules)
