"""Counts of rules on streams that nothing but their query drives."""

import pytest

from rowsieve.operators.metrics import observed_failures, watch_rules
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import valid_rows
from rowsieve.plans.layers import Layer, refresh
from rowsieve.streaming.loads import append_stream

RULES = [{"field": "age", "validations": ["notNull", "isAdult"]}, {"field": "office", "validations": ["notEmpty"]}]


@pytest.fixture
def arriving(spark, people, tmp_path):
    people.repartition(6).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(people.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_all_batches_count(spark, arriving, database, tmp_path):
    rules = compile_rules(arriving, RULES)
    observed, counts = watch_rules(arriving, rules, "expected")
    append_stream(valid_rows(observed, rules), f"{database}.ok", str(tmp_path / "c"), counts=counts)
    assert counts.get["rows"] == 6 and counts.get["rows_ko"] == 3
    assert observed_failures(counts.get, rules) == {("age", "notNull"): 1, ("age", "isAdult"): 1, ("office", "notEmpty"): 2}
    assert spark.table(f"{database}.ok").count() == 3


def test_only_new_batches_count(spark, arriving, people, database, tmp_path):
    layer = Layer("ok", lambda: arriving, stream=True, expectations=lambda frame: compile_rules(frame, RULES))
    seen = []
    for more in (0, 2, 0):
        people.limit(more).write.mode("append").parquet(str(tmp_path / "in"))
        (report,) = refresh(spark, [layer], namespace=database, checkpoint=str(tmp_path / "c"))
        seen.append((report.rows, report.dropped, sum(report.failures.values())))
    assert seen == [(3, 3, 4), (1, 1, 2), (0, 0, 0)]


def test_other_queries_do_not_count(spark, arriving, database, tmp_path):
    rules = compile_rules(arriving, RULES)
    one, counts = watch_rules(arriving, rules, "one")
    other, _ = watch_rules(arriving, rules, "other")
    with counts:
        append_stream(other, f"{database}.other", str(tmp_path / "c2"))
    assert counts.get == {}


def test_a_query_that_fails_leaves_no_listener_behind(spark, arriving, database, tmp_path):
    from pyspark.sql import functions as F

    rules = compile_rules(arriving, RULES)
    observed, counts = watch_rules(arriving, rules, "broken")
    with pytest.raises(Exception, match="boom"):
        append_stream(observed.withColumn("x", F.raise_error(F.lit("boom"))), f"{database}.ok", str(tmp_path / "c"), counts=counts)
    assert counts.get == {}
