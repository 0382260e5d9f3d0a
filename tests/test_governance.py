import pytest
from pyspark.sql import functions as F

from rowsieve.operators.governance import (
    Mask,
    PERSON_POLICIES,
    RowFilter,
    create_policy_functions,
    governed,
    publish_governed_view,
    publish_session_view,
    set_principal,
    use_namespace,
)
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import TRACE_COLUMN, rejected_rows


@pytest.fixture
def rows(spark):
    data = [("a", "RIO"), (None, "RIO"), ("c", "MADRID"), ("d", None), ("e", "")]
    return spark.createDataFrame(data, "name STRING, office STRING").coalesce(1)


OUTSIDER = [("REDACTED_PII", "RIO"), ("REDACTED_PII", "RIO")]


def seen(df):
    return [tuple(row) for row in df.collect()]


def test_outsider_and_admin(rows):
    assert seen(governed(rows, PERSON_POLICIES, ())) == OUTSIDER
    assert seen(governed(rows, PERSON_POLICIES, ("staff",))) == OUTSIDER
    assert seen(governed(rows, PERSON_POLICIES, ("admin",))) == seen(rows)


def test_filter_sees_what_the_mask_hides(rows):
    policies = [Mask("office", text="hidden"), RowFilter("office", "MADRID", group="spain")]
    assert seen(governed(rows, policies, ())) == [("c", "hidden")]
    assert seen(governed(rows, policies, ("spain",)))[0] == ("a", "hidden")
    with pytest.raises(ValueError, match="salary"):
        governed(rows, [Mask("salary")], ())
    with pytest.raises(ValueError, match="floor"):
        governed(rows.withColumn("floor", F.lit(1)), [Mask("floor")], ())


def test_rejected_rows_are_governed_too(people, rules):
    rejects = rejected_rows(people, compile_rules(people, rules))
    shown = governed(rejects, PERSON_POLICIES, ()).select("name", "office", TRACE_COLUMN)
    assert sorted(map(repr, seen(shown))) == sorted(
        map(repr, [("REDACTED_PII", "RIO", {"age": "notNull"})])
    )


def test_catalog_views_per_principal(spark, rows, database):
    rows.write.saveAsTable(f"{database}.person")
    view = f"{database}.person_shown"
    assert seen(publish_governed_view(spark, view, f"{database}.person")) == OUTSIDER
    publish_governed_view(spark, view, f"{database}.person", groups=("admin",))
    assert len(seen(spark.table(view))) == 5
    tricky = [Mask("name", text="it's \\ hidden"), RowFilter("office", "x' OR '1'='1")]
    publish_governed_view(spark, view, f"{database}.person", tricky)
    assert seen(spark.table(view)) == []
    publish_governed_view(spark, view, f"{database}.person", tricky[:1])
    assert {name for name, _ in seen(spark.table(view))} == {"it's \\ hidden"}
    with pytest.raises(ValueError, match="salary"):
        publish_governed_view(spark, view, f"{database}.person", [Mask("salary")])


def test_session_view_follows_the_principal(spark, rows):
    rows.createOrReplaceTempView("person_rows")
    publish_session_view(spark, "person_shown", "person_rows")
    assert seen(spark.table("person_shown")) == OUTSIDER
    set_principal(spark, ["staff", "admin"])
    assert len(seen(spark.table("person_shown"))) == 5
    set_principal(spark, [])
    assert seen(spark.table("person_shown")) == OUTSIDER


def test_policy_functions(spark, rows):
    create_policy_functions(spark)
    query = "SELECT name_mask_policy(name), office FROM {rows} WHERE office_filter_policy(office)"
    assert seen(spark.sql(query, rows=rows)) == OUTSIDER
    set_principal(spark, ["admin"])
    assert len(seen(spark.sql(query, rows=rows))) == 5
    set_principal(spark, [])


def test_catalog_policy_functions(spark, rows, database):
    query = (
        f"SELECT {database}.name_mask_policy(name), office FROM {{rows}} "
        f"WHERE {database}.office_filter_policy(office)"
    )
    create_policy_functions(spark, namespace=database)
    assert seen(spark.sql(query, rows=rows)) == OUTSIDER
    create_policy_functions(spark, namespace=database, groups=["admin"])
    assert len(seen(spark.sql(query, rows=rows))) == 5


def test_namespace(spark, database):
    before = spark.catalog.currentDatabase()
    try:
        use_namespace(spark, database, "spark_catalog")
        assert spark.catalog.currentDatabase() == database
        with pytest.raises(Exception):
            use_namespace(spark, "default; DROP DATABASE x")
    finally:
        use_namespace(spark, before)


def test_odd_column_names(spark, database):
    odd = spark.createDataFrame([("ann", "RIO", 1)], "`first.name` STRING, `off``ice` STRING, n INT")
    policies = [Mask("first.name"), RowFilter("n", "1")]
    assert seen(governed(odd, policies[:1], ())) == [("REDACTED_PII", "RIO", 1)]
    odd.write.saveAsTable(f"{database}.odd")
    shown = publish_governed_view(spark, f"{database}.odd_shown", f"{database}.odd", policies[:1])
    assert seen(shown) == [("REDACTED_PII", "RIO", 1)] and shown.columns == odd.columns
