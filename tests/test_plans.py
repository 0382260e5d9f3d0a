"""The plans a large cluster needs: pushed filters, pruned columns, no Python, no sorts."""

import pytest
from pyspark.sql import functions as F

from rowsieve.functions.text import clean_name, clean_name_udf
from rowsieve.operators.aggregate import grouped_stats
from rowsieve.operators.governance import PERSON_POLICIES, governed, publish_session_view, set_principal
from rowsieve.operators.metrics import expectation_metrics, rejects_by_code
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import annotate, rejected_rows, split
from rowsieve.sinks.tables import clustered

from conftest import plan_of


@pytest.fixture
def stored(spark, people, tmp_path):
    path = str(tmp_path / "people")
    people.write.parquet(path)
    return spark.read.parquet(path)


def pushed(df):
    return next(line for line in plan_of(df).splitlines() if line.startswith("PushedFilters"))


def test_both_sides_push_their_verdict_down(stored, rules):
    result = split(stored, compile_rules(stored, rules))
    ok = pushed(result.ok)
    for part in (
        "IsNotNull(office)",
        "Not(EqualTo(office,))",
        "IsNotNull(age)",
        "Or(GreaterThanOrEqual(age,18),IsNull(age))",
        "Or(LessThan(age,65),IsNull(age))",
    ):
        assert part in ok
    ko = pushed(result.ko)
    for part in ("IsNull(office)", "EqualTo(office,)", "LessThan(age,18)", "GreaterThanOrEqual(age,65)"):
        assert part in ko


@pytest.mark.parametrize("kind", ["map", "array", "full"])
def test_traces_stay_in_generated_code(stored, rules, kind):
    plan = plan_of(rejected_rows(stored, compile_rules(stored, rules), kind=kind), "simple")
    steps = [line for line in plan.splitlines() if "FileScan" not in line and ("Project [" in line or "Filter (" in line)]
    assert steps and all("*(1)" in line for line in steps)


def test_summary_reads_two_columns_and_combines_before_the_shuffle(stored, rules):
    valid = split(stored, compile_rules(stored, rules)).ok
    plan = plan_of(grouped_stats(valid, "office", "age"))
    assert "ReadSchema: struct<age:int,office:string>" in plan
    assert "partial_count" in plan and "partial_avg" in plan
    assert plan.count("hashpartitioning") == 1


def test_counts_read_the_data_once(stored, rules):
    compiled = compile_rules(stored, rules)
    for df in (
        expectation_metrics(stored, compiled),
        rejects_by_code(rejected_rows(stored, compiled, kind="array")),
    ):
        assert plan_of(df, "simple").count("FileScan") == 1


def test_outsiders_do_not_read_the_masked_column(spark, stored):
    shown = plan_of(governed(stored, PERSON_POLICIES, ()))
    assert "ReadSchema: struct<age:int,office:string>" in shown
    assert "EqualTo(office,RIO)" in shown
    assert "PushedFilters" not in plan_of(governed(stored, PERSON_POLICIES, ("admin",)))

    stored.createOrReplaceTempView("stored_people")
    publish_session_view(spark, "shown_people", "stored_people")
    plan = plan_of(spark.table("shown_people"))
    assert "ReadSchema: struct<age:int,office:string>" in plan
    assert "EqualTo(office,RIO)" in plan
    set_principal(spark, ("admin",))
    assert "name:string" in plan_of(spark.table("shown_people"))


def test_cleaning_stays_off_python(stored):
    native = plan_of(stored.select(clean_name("name")), "simple")
    assert "Python" not in native and "*(1) Project" in native
    assert "BatchEvalPython" in plan_of(stored.select(clean_name_udf()("name")), "simple")
    assert "ArrowEvalPython" in plan_of(stored.select(clean_name_udf(arrow=True)("name")), "simple")


def test_clustering_leaves_hot_keys_to_be_split(spark, tmp_path):
    plan = plan_of(clustered(spark.range(10).withColumn("office", F.lit("RIO")), "office"), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    # One office holds nearly all rows and still becomes several files.
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 100 == 0, F.lit("MADRID")).otherwise(F.lit("RIO")).alias("office"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "4m")
    try:
        clustered(rows, "office").write.parquet(str(tmp_path / "clustered"))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    assert len(list((tmp_path / "clustered").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "clustered")).count() == 400_000


def test_annotating_is_one_narrow_step(stored, rules):
    assert "Exchange" not in plan_of(annotate(stored, compile_rules(stored, rules)), "simple")
