"""Files laid out by several columns."""

import random

import pytest
from pyspark.sql import functions as F

from rowsieve.sinks import layout
from rowsieve.sinks.layout import interleaved_key, laid_out, lay_out_loads, lay_out_table
from rowsieve.streaming.loads import PathSink, read_loads, write_load
from rowsieve.sources.files import write_text
from tests.conftest import multiset

SCHEMA = "a INT, b STRING, d DATE"


@pytest.fixture
def rows(spark):
    pick = random.Random(1)
    values = [(pick.randrange(1000), f"{pick.randrange(1000):04d}", f"2024-{pick.randrange(1, 13):02d}-01") for _ in range(3000)]
    values += [(7, "x", None)] * 1500 + [(None, None, None)] * 5  # a third of the rows are alike
    return spark.createDataFrame(values, "a INT, b STRING, d STRING").withColumn("d", F.col("d").cast("date"))


def test_key_interleaves_ranks(spark):
    frame = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    keys = frame.select("x", "y", interleaved_key(frame, ["x", "y"], bits=3).alias("key")).collect()

    def spread(n):
        return sum(((n >> bit) & 1) << (2 * bit) for bit in range(3))

    ranks = sorted({r.key for r in keys})
    assert len(ranks) > 40 and max(ranks) < 64
    for one in keys:  # each column alone goes up with its own values
        for other in keys:
            if one.x <= other.x and one.y <= other.y:
                assert one.key <= other.key
    assert spread(7) == 0b010101


def test_columns_of_all_kinds(rows):
    for by in (["a"], ["b", "a"], ["d", "a", "b"]):
        assert multiset(laid_out(rows, by)) == multiset(rows)
    with pytest.raises(ValueError, match="layout takes"):
        interleaved_key(rows, [])
    with pytest.raises(ValueError, match="no layout by"):
        interleaved_key(rows.select(F.array("a").alias("l")), ["l"])


def test_files_cover_small_ranges_and_equal_rows_are_spread(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    laid_out(spark.read.parquet(str(tmp_path / "in")), ["a", "b"], files=16).write.parquet(str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out")).select("*", "_metadata.file_path").groupBy("file_path")
    files = found.agg((F.max("a") - F.min("a")).alias("a"), F.count("*").alias("n")).collect()
    assert len(files) == 16
    assert max(f.n for f in files) < 1200  # 1,500 rows are alike
    assert sum((f.a or 0) for f in files) / 16 < 600
    assert multiset(spark.read.parquet(str(tmp_path / "out"))) == multiset(rows)


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert laid_out(empty, ["a", "b"]).count() == 0


@pytest.fixture
def loads(spark, rows, tmp_path):
    sink, checkpoint = PathSink(str(tmp_path / "rows")), str(tmp_path / "checkpoint")
    for batch in (0, 1, 2):
        write_load(rows.where(F.col("a") % 3 == batch), sink, "q", batch, checkpoint=checkpoint)
    for batch in (0, 1):
        write_text(spark, f"{checkpoint}/commits/{batch}", "v1")
    return sink, checkpoint


def test_only_new_committed_loads_are_laid_out(spark, loads, tmp_path):
    sink, checkpoint = loads
    more = {"staging": str(tmp_path / "staging"), "rows_per_file": 100}
    before = multiset(read_loads(spark, sink.path, SCHEMA))
    assert lay_out_loads(spark, sink.path, SCHEMA, ["a", "b"], **more) == ["q-0", "q-1"]
    assert lay_out_loads(spark, sink.path, SCHEMA, ["a", "b"], **more) == []
    assert multiset(read_loads(spark, sink.path, SCHEMA)) == before
    write_text(spark, f"{checkpoint}/commits/2", "v1")
    assert lay_out_loads(spark, sink.path, SCHEMA, ["a", "b"], **more) == ["q-2"]
    assert lay_out_loads(spark, sink.path, SCHEMA, ["b"], **more) == ["q-0", "q-1", "q-2"]


@pytest.mark.parametrize("calls", [1, 2, 3])
def test_a_layout_that_ended_in_between_is_finished(spark, loads, tmp_path, monkeypatch, calls):
    from rowsieve.streaming import loads as module

    sink, _ = loads
    before = multiset(read_loads(spark, sink.path, SCHEMA))
    done = []

    def some(work):
        return lambda *a: (done.append(1), 1 / 0 if len(done) > calls else work(*a))[1]

    with monkeypatch.context() as broken:
        for name in ("move", "remove"):
            broken.setattr(module, name, some(getattr(module, name)))
        with pytest.raises(ZeroDivisionError):
            lay_out_loads(spark, sink.path, SCHEMA, ["a"], staging=str(tmp_path / "staging"))
    lay_out_loads(spark, sink.path, SCHEMA, ["a"], staging=str(tmp_path / "staging"))
    assert multiset(read_loads(spark, sink.path, SCHEMA)) == before


def test_tables(spark, rows, database):
    name = f"{database}.t"
    rows.write.saveAsTable(name)
    lay_out_table(spark, name, ["a", "b"], files=8)
    assert multiset(spark.table(name)) == multiset(rows)
    assert "clusteringColumns" in {r.key for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert layout.BITS == 6
