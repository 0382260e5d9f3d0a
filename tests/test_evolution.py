"""Schemas that grow: logged versions, files by name, nested and widened tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.operators.enrich import align, joined_schema
from rowsieve.plans import dataflow
from rowsieve.plans.contract import parse_contract
from rowsieve.plans.dataflow import run
from rowsieve.sinks.tables import append_table, overwrite_table, set_comment
from rowsieve.sources.evolving import Evolving, all_files
from rowsieve.sources.files import SchemaLog, write_text


def flow_of(landing, out, fmt="csv", options=None, **more):
    spec = {
        "name": "f",
        "sources": [{"name": "rows", "path": str(landing), "format": fmt, "options": options or {}}],
        "transformations": [],
        "sinks": [{"name": "all", "input": "rows", "paths": [str(out / "all")], "format": "parquet", **more}],
    }
    return parse_contract(spec)


def load(spark, landing, out, **kw):
    return run(flow_of(landing, out, **kw), spark, checkpoint=str(out / "checkpoint"), processing_time=None)


def rows_at(spark, out):
    return spark.read.option("mergeSchema", "true").parquet(str(out / "all")).drop("load_id")


HEADER = {"header": "true", "inferSchema": "true"}


def test_csv_is_read_by_its_own_header(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a [1] b.csv").write_text("name,age\nada,41\nbo,12\n")
    load(spark, landing, tmp_path, options=HEADER)
    (landing / "b.csv").write_text('team,age,name\n"x,y",7,cy\n')
    (landing / "c.csv").write_text("AGE\n9\n")
    (landing / "d.csv").write_text("")
    load(spark, landing, tmp_path, options=HEADER)
    load(spark, landing, tmp_path, options=HEADER)
    found = {tuple(r) for r in rows_at(spark, tmp_path).select("name", "age", "team").collect()}
    assert found == {("ada", 41, None), ("bo", 12, None), ("cy", 7, "x,y"), (None, 9, None)}
    log = SchemaLog(spark, str(tmp_path / "checkpoint/schemas/rows"))
    assert [v.names for v in log.versions()] == [["name", "age"], ["name", "age", "team"]]


def test_csv_lines_that_do_not_fit_are_kept_whole(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text("name,age\nada,41\n")
    load(spark, landing, tmp_path, options=HEADER)
    (landing / "b.csv").write_text("name,age\nbo,old\ncy,3,extra\ndi,4\n")
    load(spark, landing, tmp_path, options=HEADER)
    found = {r["name"]: (r["age"], r["_corrupt_record"]) for r in rows_at(spark, tmp_path).collect()}
    assert found == {"ada": (41, None), "bo": (None, "bo,old"), "cy": (3, "cy,3,extra"), "di": (4, None)}


def test_csv_without_header_grows_to_the_right(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text("x;1\n")
    load(spark, landing, tmp_path, options={"sep": ";"})
    (landing / "b.csv").write_text("y;2;z\n")
    load(spark, landing, tmp_path, options={"sep": ";"})
    found = {tuple(r) for r in rows_at(spark, tmp_path).select("_c0", "_c1", "_c2").collect()}
    assert found == {("x", "1", None), ("y", "2", "z")}


def test_parquet_columns_and_types_grow(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s, 1 AS day").write.partitionBy("day").parquet(landing)
    load(spark, landing, tmp_path, fmt="parquet")
    later = spark.sql("SELECT 5000000000 AS id, named_struct('b', 'x') AS s, true AS more, 2 AS day")
    later.write.mode("append").partitionBy("day").parquet(landing)
    load(spark, landing, tmp_path, fmt="parquet")
    log = SchemaLog(spark, str(tmp_path / "checkpoint/schemas/rows"))
    found = spark.read.schema(log.current()).parquet(str(tmp_path / "all"))
    assert {(r.id, r.s.a, r.s.b, r.more, r.day) for r in found.collect()} == {(1, 1, None, None, 1), (5000000000, None, "x", True, 2)}


def test_a_type_without_a_common_one_stops_before_anything_is_written(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.sql("SELECT 1 AS id").write.parquet(landing)
    load(spark, landing, tmp_path, fmt="parquet")
    spark.sql("SELECT 'x' AS id, 2 AS more").write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="no common type|merge"):
        load(spark, landing, tmp_path, fmt="parquet")
    assert rows_at(spark, tmp_path).count() == 1


def test_a_batch_that_failed_is_read_again_with_its_columns(spark, tmp_path, monkeypatch):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text("name\nada\n")
    load(spark, landing, tmp_path, options=HEADER)
    (landing / "b.csv").write_text("team,name\nx,bo\n")
    with monkeypatch.context() as broken:
        broken.setattr(dataflow, "_write_all", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            load(spark, landing, tmp_path, options=HEADER)
    load(spark, landing, tmp_path, options=HEADER)
    assert {(r.name, r.team) for r in rows_at(spark, tmp_path).collect()} == {("ada", None), ("bo", "x")}


def test_batch_execution_reads_all_columns_too(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.sql("SELECT 1 AS id").write.parquet(landing)
    spark.sql("SELECT 2 AS id, 'x' AS more").write.mode("append").parquet(landing)
    run(flow_of(landing, tmp_path, fmt="parquet"), spark, execution="batch", processing_time=None)
    assert {tuple(r) for r in rows_at(spark, tmp_path).select("id", "more").collect()} == {(1, None), (2, "x")}


def test_schema_log(spark, tmp_path):
    place = str(tmp_path / "log")
    log = SchemaLog(spark, place)
    assert log.current() is None and log.versions() == []
    one, two = (T.StructType.fromDDL(ddl) for ddl in ("a INT", "a INT, b STRUCT<c: STRING>"))
    log.add(one)
    write_text(spark, f"{place}/.v2.json-broken", '{"type"')  # what a run left that ended while it wrote
    assert log.current() == one
    assert SchemaLog(spark, place).add(two) == two
    assert SchemaLog(spark, place).current() == two
    assert log.versions() == [one, two]


def test_schema_of_an_earlier_release(spark, tmp_path):
    place = str(tmp_path / "log")
    one = T.StructType.fromDDL("a INT")
    spark.createDataFrame([(one.json(),)], "value string").coalesce(1).write.text(place)
    log = SchemaLog(spark, place)
    assert log.current() == one
    log.add(T.StructType.fromDDL("a INT, b INT"))
    assert log.current().names == ["a", "b"]


def test_files_without_a_log(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    rows = Evolving(spark, str(tmp_path), fmt="csv", options={"header": "true"})
    assert [r.x for r in rows.read(all_files(spark, str(tmp_path))).collect()] == ["1"]
    assert rows.read([]).columns == ["x", "_corrupt_record"]


@pytest.mark.parametrize(
    ("one", "other", "joined"),
    [
        ("a INT", "A BIGINT, b STRING", "a BIGINT, b STRING"),
        ("a STRUCT<x: INT>", "a STRUCT<y: INT, X: DOUBLE>", "a STRUCT<x: DOUBLE, y: INT>"),
        ("a ARRAY<STRUCT<x: SMALLINT>>", "a ARRAY<STRUCT<x: INT>>", "a ARRAY<STRUCT<x: INT>>"),
        ("a MAP<STRING, FLOAT>", "a MAP<STRING, DOUBLE>", "a MAP<STRING, DOUBLE>"),
        ("a BIGINT", "a DECIMAL(10, 2)", "a DECIMAL(21, 2)"),
        ("a DECIMAL(20, 1)", "a DECIMAL(10, 8)", "a DECIMAL(27, 8)"),
        ("a INT", "a FLOAT", "a DOUBLE"),
        ("a VOID", "a STRING", "a STRING"),
    ],
)
def test_joined_schemas(one, other, joined):
    one, other, joined = map(T.StructType.fromDDL, (one, other, joined))
    assert joined_schema(one, other).simpleString() == joined.simpleString()
    both = joined_schema(other, one)
    assert sorted(f.name.lower() for f in both.fields) == sorted(f.name.lower() for f in joined.fields)


@pytest.mark.parametrize(
    ("one", "other"),
    [("a INT", "a STRING"), ("a BIGINT", "a DOUBLE"), ("a STRUCT<x: INT>", "a INT"), ("a DECIMAL(38, 0)", "a DECIMAL(38, 10)"), ("a MAP<INT, INT>", "a MAP<STRING, INT>")],
)
def test_schemas_without_a_common_one(one, other):
    with pytest.raises(ValueError, match="no common type"):
        joined_schema(T.StructType.fromDDL(one), T.StructType.fromDDL(other))


def test_nested_alignment(spark):
    rows = spark.sql("SELECT named_struct('X', 1, 'extra', 'e') AS s, array(named_struct('x', '7')) AS l, CAST(NULL AS STRUCT<x: INT>) AS n")
    wanted = T.StructType.fromDDL("s STRUCT<y: STRING, x: BIGINT>, l ARRAY<STRUCT<x: INT>>, n STRUCT<x: INT, z: INT>")
    (row,) = align(rows, wanted, strict=True).collect()
    assert (row.s.y, row.s.x, row.l[0].x, row.n) == (None, 1, 7, None)
    with pytest.raises(ValueError, match="not in the table"):
        align(rows.select("s"), wanted, strict=True, lossless=True)


def test_a_refused_type_changes_nothing(spark, database):
    name = f"{database}.t"
    append_table(spark.sql("SELECT 1 AS id"), name, merge_schema=True)
    with pytest.raises(ValueError, match="no common type"):
        append_table(spark.sql("SELECT 'x' AS id, 1 AS more"), name, merge_schema=True, widen=True)
    with pytest.raises(ValueError, match="does not widen"):
        append_table(spark.sql("SELECT 5000000000 AS id, 1 AS more"), name, merge_schema=True)
    assert spark.table(name).columns == ["id"]
    append_table(spark.sql("SELECT 5000000000 AS id"), name, merge_schema=True, widen=True)
    assert {r.id for r in spark.table(name).collect()} == {1, 5000000000}


def test_overwriting_keeps_the_layout(spark, database):
    name = f"{database}.t"
    spark.range(6).select("id", (F.col("id") % 2).alias("part")).write.partitionBy("part").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_team' = 'it''s us')")
    set_comment(spark, name, "kept")
    overwrite_table(spark.range(2).select("id", F.lit(1).alias("part")), name)
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["part"]
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["owner_team"] == "it's us"
    assert spark.catalog.getTable(name).description == "kept"
    overwrite_table(spark.range(2), name)  # without the partition column there is nothing to keep
    assert spark.table(name).columns == ["id"]


def test_an_overwrite_that_ended_between_the_renames_loses_no_table(spark, database):
    name = f"{database}.t"
    spark.range(3).write.saveAsTable(f"{name}__old")  # the old table, before the new one got its name
    overwrite_table(spark.range(5), name)
    assert spark.table(name).count() == 5
    assert not spark.catalog.tableExists(f"{name}__old")
