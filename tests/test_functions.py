import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsieve.functions.people import PERSON_SCHEMA, people_from_ids, random_people
from rowsieve.functions.text import BLANKS, EDGE_BLANKS, PREFIX, clean_name, clean_name_udf
from rowsieve.plans.compare import compare_cleaning
from rowsieve.plans.generate import generate_people
from rowsieve.sources.files import read_files

from conftest import multiset

SIX = list(BLANKS)


def cleaned(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, name STRING")
    return [row[1] for row in df.select("id", column).orderBy("id").collect()]


def by_pattern(column):
    return F.concat(F.lit(PREFIX), F.regexp_replace(F.upper(column), EDGE_BLANKS, ""))


def test_native_equals_udf_on_the_six_blanks(spark):
    values = [a + "ann b" + b for a in SIX for b in SIX]
    values += ["", None, " \t ", "straße", "two\nlines ", "\n\nx\r\n", "UPPER"]
    native = cleaned(spark, values, clean_name("name"))
    assert native == cleaned(spark, values, clean_name_udf()("name"))
    assert native == cleaned(spark, values, clean_name_udf(arrow=True)("name"))
    assert native[0] == "EMP_ANN B" and native[len(SIX) ** 2 + 1] is None


TEXT = st.text(
    alphabet=st.sampled_from([*SIX, "a", "ß", "é", "\u0085", "\u2028", "\u2029", "\u00a0", "\u2003", "\x1c"]),
    max_size=8,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(TEXT, min_size=40, max_size=120))
def test_trimming_means_the_pattern(spark, values):
    assert cleaned(spark, values, clean_name("name")) == cleaned(spark, values, by_pattern(F.col("name")))


def test_line_ends_the_pattern_knows(spark):
    values = [f"a{x} {y}" for x in ("", " ", "\n") for y in ("\u0085", "\u2028", "\u2029", "\u0085\u2028", "\u0085 ", "\r\n\u0085")]
    assert cleaned(spark, values, clean_name("name")) == cleaned(spark, values, by_pattern(F.col("name")))


@pytest.mark.parametrize("make", [
    lambda spark, n: people_from_ids(spark.range(n)),
    lambda spark, n: random_people(spark, n, seed=7),
])
def test_distribution_of_synthetic_people(spark, make):
    n = 100_000
    rows = make(spark, n)
    assert rows.schema.simpleString() == "struct<name:string,age:int,office:string>"
    stats = rows.agg(
        F.count(F.lit(1)), F.min("age"), F.max("age"), F.count_if(F.col("age").isNull()) / n,
        F.count_if(F.col("office") == "") / n, F.count_if(F.col("office") == "RIO") / n,
        F.count_if((F.col("office") != "") & F.col("age").between(18, 64)) / n,
        F.count_distinct("name"),
    ).collect()[0]
    assert tuple(stats[:3]) == (n, 10, 84)
    assert stats[3] == pytest.approx(0.1, abs=0.01) and stats[4] == pytest.approx(0.1, abs=0.01)
    assert stats[5] == pytest.approx(0.45, abs=0.01)
    assert stats[6] == pytest.approx(0.9 * 0.9 * 47 / 75, abs=0.01)
    assert stats[7] == n


def test_synthetic_people_repeat(spark):
    few = people_from_ids(spark.range(0, 50, 1, 1)).collect()
    assert few == people_from_ids(spark.range(0, 50, 1, 8)).collect()
    assert few != people_from_ids(spark.range(0, 50, 1, 1), seed=1).collect()
    assert random_people(spark, 50, seed=3, partitions=2).collect() == random_people(
        spark, 50, seed=3, partitions=2
    ).collect()
    assert random_people(spark, 10).count() == 10


def test_comparison_job(spark, people):
    result = compare_cleaning(people, "name", runs=1, warm_up=False)
    rows = {row["variant"]: row for row in result.collect()}
    assert set(rows) == {"python_udf", "arrow_udf", "native"}
    assert all(row["row_count"] == 6 and row["seconds"] > 0 for row in rows.values())
    assert rows["python_udf"]["speedup"] == 1.0


def test_generator_job(spark, tmp_path):
    path = str(tmp_path / "people")
    generate_people(spark, path, 1000, seed=5)
    assert len(list((tmp_path / "people").glob("*.json"))) == 10
    rows = read_files(spark, path, PERSON_SCHEMA)
    assert rows.count() == 1000
    generate_people(spark, path, 1000, seed=5)
    assert multiset(read_files(spark, path, PERSON_SCHEMA).distinct()).total() == 1000
    generate_people(spark, path, 100, mode="overwrite", files=20)
    assert len(list((tmp_path / "people").glob("*.json"))) == 20
    assert read_files(spark, path, PERSON_SCHEMA).select("name").distinct().count() == 100
