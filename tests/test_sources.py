import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rowsieve.functions.people import PERSON_SCHEMA
from rowsieve.sources.files import (
    BATCH_BYTES,
    as_schema,
    bounded,
    empty_like,
    file_stream,
    infer_schema,
    kept_schema,
    normalise_path,
    read_files,
    read_variant,
)
from rowsieve.sources.rescue import _without_fractions, read_json_rescued, rescue_lines
from rowsieve.streaming.loads import append_stream

from conftest import plan_of

LINES = [
    ('{"name":"a","age":20,"office":"RIO"}', ("a", 20, "RIO", {}, None)),
    (
        '{"name":"b","age":"old","office":"RIO","extra":{"x":1}}',
        ("b", None, "RIO", {"age": "old", "extra": '{"x":1}'}, None),
    ),
    ('{"name":"c","age":"33","office":"RIO"}', ("c", None, "RIO", {"age": "33"}, None)),
    ("not json", (None, None, None, None, "not json")),
    ('{"name":"d","AGE":5}', ("d", None, None, {"AGE": "5"}, None)),
    ('{"name":"e","age":null,"zip":null}', ("e", None, None, {}, None)),
    ("{}", (None, None, None, {}, None)),
    ('{"name":"f","age":1.5}', ("f", None, None, {"age": "1.5"}, None)),
    ('{"name":"g","age":99999999999}', ("g", None, None, {"age": "99999999999"}, None)),
    ('{"name":"h","z":1,"z":2}', ("h", None, None, {"z": "2"}, None)),
    ("[1,2]", (None, None, None, None, "[1,2]")),
    ('{"name":"cut","age":1', (None, None, None, None, '{"name":"cut","age":1')),
]


def test_rescue_keeps_what_the_schema_loses(spark):
    df = spark.createDataFrame([(line,) for line, _ in LINES], "value STRING").coalesce(1)
    found = [tuple(row) for row in rescue_lines(df, PERSON_SCHEMA).collect()]
    assert found == [expected for _, expected in LINES]


def test_rescue_columns_can_be_read_alone(spark):
    df = spark.createDataFrame([(line,) for line, _ in LINES], "value STRING").coalesce(1)
    rescued = rescue_lines(df, PERSON_SCHEMA)
    for position, name in enumerate(rescued.columns):
        assert [row[0] for row in rescued.select(name).collect()] == [
            expected[position] for _, expected in LINES
        ]


FRACTIONS = [
    # line, whether the parser is spared its fractions, and name, age, rescued, corrupt
    ('{"name":"a.b","age":45.5}', True, ("a.b", None, {"age": "45.5"}, None)),
    ('{"age":45.5,"age":3}', True, (None, 3, {}, None)),
    ('{"age":3,"age":45.5}', True, (None, 3, {}, None)),
    ('{"age":1.5,"x":1,"x":2}', True, (None, None, {"age": "1.5", "x": "2"}, None)),
    ('{"age": 1.5}', False, (None, None, {"age": "1.5"}, None)),
    ('{"name":"\\"age\\":1.5,"}', False, ('"age":1.5,', None, {}, None)),
    ("{'name':'\"age\":1.5,'}", False, ('"age":1.5,', None, {}, None)),
    ('{"name":{"age":1.5},"age":2}', False, ('{"age":1.5}', 2, {}, None)),
    ('{"age":1.5,"!":2}', True, (None, None, {"age": "1.5", "!": "2"}, None)),
    ('{"age":1.5} x', True, (None, None, None, '{"age":1.5} x')),
]


def test_fractions_of_whole_numbers_are_rescued_without_a_parser_error(spark):
    schema = as_schema("name STRING, age INT")
    df = spark.createDataFrame([(line,) for line, _, _ in FRACTIONS], "value STRING").coalesce(1)
    assert [tuple(row) for row in rescue_lines(df, schema).collect()] == [row for _, _, row in FRACTIONS]
    read = df.select(_without_fractions(F.col("value"), schema).alias("read"), "value").collect()
    assert [row.read != row["value"] for row in read] == [spared for _, spared, _ in FRACTIONS]


def test_rescue_reserves_its_columns(spark):
    df = spark.createDataFrame([("{}",)], "value STRING")
    with pytest.raises(ValueError, match="reserved"):
        rescue_lines(df, "_rescued_data STRING")


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_strict_read_and_rescue_agree_on_typed_columns(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [line for line, _ in LINES if line[0] == "{"] + [""])
    strict = read_files(spark, f"{tmp_path}/in/*", PERSON_SCHEMA).collect()
    rescued = read_json_rescued(spark, f"{tmp_path}/in", PERSON_SCHEMA)
    typed = rescued.select("name", "age", "office").collect()
    assert sorted(map(repr, strict)) == sorted(map(repr, typed))


def test_path_normalisation():
    assert normalise_path("/data/person/*") == "/data/person"
    assert normalise_path("/data/*/person/*") == "/data/*/person"
    assert normalise_path("/data/person/*.json") == "/data/person/*.json"
    assert normalise_path("/data/person") == "/data/person"


def test_micro_batches_are_bounded():
    assert bounded(None) == {"maxBytesPerTrigger": BATCH_BYTES}
    assert bounded({"maxFilesPerTrigger": 3}) == {"maxFilesPerTrigger": 3}
    assert bounded({"maxbytespertrigger": 5}) == {"maxbytespertrigger": 5}


def test_inferred_schema(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [json.dumps({"name": "a", "age": 1})])
    write_lines(tmp_path / "in" / "b.json", [json.dumps({"name": "b", "late": True})])
    write_lines(tmp_path / "in" / "_state" / "c.json", [json.dumps({"hidden": 1})])
    everything = infer_schema(spark, f"{tmp_path}/in/*")
    assert everything.simpleString() == "struct<age:bigint,late:boolean,name:string>"


@pytest.mark.parametrize("stream", [False, True])
def test_variant_reads_keys_that_differ_in_case(spark, tmp_path, stream):
    write_lines(tmp_path / "in" / "a.json", ['{"age": 1, "AGE": "old"}', '{"age": 2}'])
    with pytest.raises(AnalysisException, match="COLUMN_ALREADY_EXISTS"):
        infer_schema(spark, f"{tmp_path}/in")
    rows = read_variant(spark, f"{tmp_path}/in/*", stream=stream)
    rows = rows.select(
        F.variant_get("record", "$.age", "int").alias("lower"),
        F.variant_get("record", "$.AGE", "string").alias("upper"),
    )
    if stream:
        append_stream(rows, "variant_rows", str(tmp_path / "c"))
        rows = spark.table("variant_rows")
    assert sorted(tuple(row) for row in rows.collect()) == [(1, "old"), (2, None)]


def test_a_kept_schema_and_rescue_lose_nothing(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [json.dumps({"name": "a", "age": 1})])
    schema = kept_schema(spark, str(tmp_path / "schema"), f"{tmp_path}/in")
    write_lines(tmp_path / "in" / "b.json", [json.dumps({"name": "b", "late": True})])
    assert kept_schema(spark, str(tmp_path / "schema"), f"{tmp_path}/in") == schema
    rows = read_json_rescued(spark, f"{tmp_path}/in", schema).orderBy("name").collect()
    assert [row["_rescued_data"] for row in rows] == [{}, {"late": "true"}]


def test_empty_relation_stays_a_stream(spark, people, tmp_path):
    assert empty_like(people).count() == 0
    assert empty_like(people).schema == people.schema
    (tmp_path / "in").mkdir()
    stream = empty_like(file_stream(spark, str(tmp_path / "in"), PERSON_SCHEMA))
    assert stream.isStreaming and stream.schema == PERSON_SCHEMA


def test_null_is_a_missing_key(spark, people, tmp_path):
    people.coalesce(1).write.json(str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.json")).read_text()
    assert '{"name":"cy","office":"RIO"}' in text.splitlines()
    back = read_files(spark, str(tmp_path / "out"), PERSON_SCHEMA)
    assert back.filter(F.col("age").isNull()).count() == 1


def test_other_formats(spark, people, tmp_path):
    people.write.option("header", True).csv(str(tmp_path / "csv"))
    back = read_files(spark, str(tmp_path / "csv"), PERSON_SCHEMA, fmt="CSV", options={"header": True})
    assert back.filter("age >= 18").count() == 4
    people.write.parquet(str(tmp_path / "parquet"))
    back = read_files(spark, str(tmp_path / "parquet"), fmt="parquet").select("age")
    assert "ReadSchema: struct<age:int>" in plan_of(back)


def as_text(value):
    """How a JSON value reads as text."""
    return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"))


texts = st.text(alphabet=st.sampled_from([*'ab:," {}\\', "é"]), max_size=6)
others = st.one_of(texts, st.integers(-5, 5), st.booleans(), st.just({"q": 1}), st.just([1, 2]))
records = st.fixed_dictionaries(
    {},
    optional={
        "name": st.one_of(st.none(), texts),
        "age": st.one_of(st.none(), st.integers(0, 99), others),
        "office": st.one_of(st.none(), texts),
        "AGE": st.one_of(st.none(), others),
        "x:y": st.one_of(st.none(), others),
        "zip": st.one_of(st.none(), others),
    },
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(records, st.booleans()), min_size=30, max_size=80))
def test_nothing_is_lost(spark, data):
    lines, expected = [], []
    for record, spaced in data:
        separators = (" , ", " : ") if spaced else (",", ":")
        lines.append((json.dumps(record, ensure_ascii=spaced, separators=separators),))
        age = record.get("age")
        readable = isinstance(age, int) and not isinstance(age, bool)
        lost = {
            key: as_text(value)
            for key, value in record.items()
            if value is not None and key not in ("name", "office") and not (key == "age" and readable)
        }
        expected.append(
            (record.get("name"), age if readable else None, record.get("office"), lost, None)
        )
    df = spark.createDataFrame(lines, "value STRING").coalesce(1)
    assert [tuple(row) for row in rescue_lines(df, PERSON_SCHEMA).collect()] == expected
