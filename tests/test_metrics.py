from rowsieve.operators.metrics import (
    expectation_metrics,
    observe_rules,
    observed_failures,
    rejects_by_code,
)
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import annotate, rejected_rows
from rowsieve.sinks.tables import write_noop


def test_one_code_on_two_fields_is_counted_apart(spark):
    df = spark.createDataFrame([(None, "x"), (None, None), (1, None), (1, "y"), (None, "z")], "a INT, b STRING")
    blocks = [{"field": "a", "validations": ["notNull"]}, {"field": "b", "validations": ["notNull"]}]
    rules = compile_rules(df, blocks)
    expected = {("a", "notNull", 3, 2, 5), ("b", "notNull", 2, 3, 5)}
    assert {tuple(row) for row in expectation_metrics(df, rules).collect()} == expected
    observed, observation = observe_rules(df, rules, "apart")
    write_noop(observed)
    assert observed_failures(observation.get, rules) == {("a", "notNull"): 3, ("b", "notNull"): 2}
    assert observation.get["rows"] == 5 and observation.get["rows_ko"] == 4
    by_field = rejects_by_code(rejected_rows(df, rules, kind="map"))
    assert {tuple(row) for row in by_field.collect()} == {("a", "notNull", 3), ("b", "notNull", 2)}


def test_without_rules_or_rows(spark, people, rules):
    assert expectation_metrics(people, []).collect() == []
    assert expectation_metrics(people, []).columns == ["field", "rule", "failed", "passed", "total"]
    none = people.filter("false")
    compiled = compile_rules(none, rules)
    assert {tuple(row)[2:] for row in expectation_metrics(none, compiled).collect()} == {(0, 0, 0)}
    for kind in ("map", "array", "full"):
        assert rejects_by_code(annotate(none, compiled, kind=kind)).count() == 0


def test_null_predicates_count_by_their_policy(spark, people):
    block = {"field": "age", "validations": ["isAdult"]}
    for policy, failed in (("pass", 1), ("fail", 2)):
        rules = compile_rules(people, [block], nulls=policy)
        assert expectation_metrics(people, rules).collect()[0]["failed"] == failed
