import re

import pytest
from pyspark.sql import functions as F

from rowsieve.functions.people import PERSON_SCHEMA, random_people
from rowsieve.operators.aggregate import grouped_stats, merge_stats, partial_stats, row_count
from rowsieve.operators.enrich import add_processing_time, align
from rowsieve.scratch import new_dir
from rowsieve.session import session_conf
from rowsieve.sinks.tables import (
    append_path,
    append_table,
    overwrite_table,
    read_merged,
    set_clustering,
    write_clustered_table,
    write_json,
    write_noop,
)

from conftest import multiset


def test_overwrite_and_append(spark, people, database):
    name = f"{database}.person"
    overwrite_table(people, name, comment="people, it's all")
    append_table(people, name)
    assert spark.table(name).count() == 12
    overwrite_table(people, name)
    assert spark.table(name).count() == 6


def test_append_widens_a_table(spark, people, database):
    name = f"{database}.person"
    append_table(people, name, merge_schema=True)
    append_table(people.withColumn("dt", F.lit("x")).select("dt", "office", "name", "age"), name, merge_schema=True)
    append_table(people.drop("office"), name, merge_schema=True)
    found = spark.table(name)
    assert found.columns == ["name", "age", "office", "dt"]
    assert found.filter("dt IS NULL").count() == 12
    assert found.filter("office IS NULL").count() == 8
    assert found.filter("name = 'ada' AND age = 41").count() == 3


def test_merge_by_path(spark, people, tmp_path):
    path = str(tmp_path / "p")
    append_path(people, path)
    append_path(people.withColumn("dt", F.lit("x")), path)
    assert read_merged(spark, path).filter("dt = 'x'").count() == 6
    declared = read_merged(spark, path, schema="name STRING, dt STRING")
    assert declared.count() == 12 and declared.columns == ["name", "dt"]


def test_json_files_are_bounded(spark, tmp_path):
    rows = random_people(spark, 1000, seed=1, partitions=20)
    write_json(rows, str(tmp_path / "a"), n_files=10)
    write_json(rows, str(tmp_path / "a"), n_files=3, wide=True)
    assert len(list((tmp_path / "a").glob("*.json"))) == 13
    write_json(rows, str(tmp_path / "b"), n_files=None, max_records_per_file=25)
    assert len(list((tmp_path / "b").glob("*.json"))) == 40
    assert spark.read.schema(PERSON_SCHEMA).json(str(tmp_path / "a")).count() == 2000


def test_noop_runs_everything(spark):
    failing = spark.range(3).select(F.raise_error(F.lit("computed")).alias("x"))
    with pytest.raises(Exception, match="computed"):
        write_noop(failing)
    write_noop(spark.range(3))


def test_clustered_table(spark, people, database):
    name = f"{database}.person"
    write_clustered_table(people, name, "office")
    set_clustering(spark, name, ["office", "name"])
    text = " ".join(str(row) for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect())
    assert re.search(r"clusteringColumns=\[\[\"office\"\],\[\"name\"\]\]", text)
    assert multiset(spark.table(name)) == multiset(people)


def test_summary_and_its_parts(spark):
    data = [("a", 1), ("a", 2), ("a", None), (None, 5), ("b", None)]
    df = spark.createDataFrame(data, "office STRING, age INT")
    expected = {("a", 3, 1.5), (None, 1, 5.0), ("b", 1, None)}
    assert {tuple(row) for row in grouped_stats(df).collect()} == expected
    loads = [df.filter("age IS NULL"), df.filter("age > 1"), df.filter("age = 1")]
    parts = partial_stats(loads[0], "office", "age")
    for load in loads[1:]:
        parts = parts.unionByName(partial_stats(load, "office", "age"))
    assert {tuple(row) for row in merge_stats(parts).collect()} == expected
    assert grouped_stats(df).schema.simpleString() == merge_stats(parts).schema.simpleString()
    assert row_count(df).collect()[0][0] == 5
    text = df.withColumn("age", F.coalesce(F.col("age").cast("string"), F.lit("old")))
    assert {tuple(row) for row in grouped_stats(text).collect()} == expected


def test_processing_time(spark, people):
    text = add_processing_time(people)
    assert dict(text.dtypes)["dt"] == "string"
    values = {row["dt"] for row in text.collect()}
    assert len(values) == 1 and re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", values.pop())
    stamp = add_processing_time(people, column="seen", as_type="timestamp")
    assert dict(stamp.dtypes)["seen"] == "timestamp"
    with pytest.raises(ValueError):
        add_processing_time(people, as_type="date")


def test_align(spark, people):
    from rowsieve.sources.files import as_schema

    schema = as_schema("office STRING, age STRING, zip INT")
    aligned = align(people, schema)
    assert aligned.columns == ["office", "age", "zip", "name"]
    assert align(people, schema, strict=True).columns == ["office", "age", "zip"]
    number = align(people.select(F.lit("old").alias("age")), as_schema("age INT"))
    assert number.collect()[0]["age"] is None
    with pytest.raises(ValueError, match="does not widen"):
        align(people, as_schema("age SMALLINT"), lossless=True)
    upper = people.withColumnRenamed("name", "NAME")
    assert align(upper, people.schema, lossless=True).collect() == people.collect()


def test_a_failing_overwrite_leaves_the_table(spark, people, database):
    name = f"{database}.people"
    overwrite_table(people, name)
    failing = people.withColumn("age", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        overwrite_table(failing, name)
    assert spark.table(name).count() == people.count()
    overwrite_table(spark.table(name).where("age > 20"), name)
    assert spark.table(name).count() == people.where("age > 20").count()


def test_appending_loses_no_value(spark, people, database):
    name = f"{database}.people"
    append_table(people, name)
    for bad in (people.withColumn("age", F.lit(5_000_000_000)), people.withColumn("age", F.lit("old"))):
        with pytest.raises(ValueError, match="does not widen"):
            append_table(bad, name, merge_schema=True)
    assert spark.table(name).count() == people.count()


def test_scratch_and_settings(spark):
    assert new_dir(spark, "x") != new_dir(spark, "x")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with session_conf(spark, {key: 3, "spark.sql.files.maxRecordsPerFile": 7}):
            assert spark.conf.get(key) == "3"
            raise RuntimeError
    assert spark.conf.get(key) == before
