import pytest
from pyspark.sql import functions as F

from rowsieve.operators.rules import RuleError, compile_rules, register_rule, registered_rules
from rowsieve.operators.split import TRACE_COLUMN, annotate, rejected_rows, split, valid_rows

from conftest import multiset


def errors(df, rules, kind="map"):
    return {row["name"]: row[TRACE_COLUMN] for row in split(df, rules, kind=kind).ko.collect()}


@pytest.mark.parametrize("age_type", ["int", "bigint"])
def test_each_way_to_fail(people, rules, age_type):
    df = people.withColumn("age", F.col("age").cast(age_type))
    result = split(df, compile_rules(df, rules))
    assert [row["name"] for row in result.ok.collect()] == ["ada", "flo"]
    assert result.ok.columns == df.columns
    assert errors(df, compile_rules(df, rules)) == {
        "bo": {"office": "notEmpty", "age": "isAdult"},
        "cy": {"age": "notNull"},
        "di": {"age": "not_retirement_age"},
        "ed": {"office": "notEmpty"},
    }
    assert result.ko.schema[TRACE_COLUMN].dataType.simpleString() == "map<string,string>"


def test_qualified_codes_in_an_array(people, rules):
    found = errors(people, compile_rules(people, rules, code_style="qualified"), kind="array")
    assert found == {
        "bo": ["office_not_empty", "age_must_be_adult"],
        "cy": ["age_not_null"],
        "di": ["age_not_retirement_age"],
        "ed": ["office_not_empty"],
    }


def test_null_predicate_passes_unless_told_otherwise(people):
    adult = [{"field": "age", "validations": ["isAdult"]}]
    assert set(errors(people, compile_rules(people, adult))) == {"bo"}
    assert set(errors(people, compile_rules(people, adult, nulls="fail"))) == {"bo", "cy"}


def test_null_policy_of_a_block_and_of_one_expression(people):
    blocks = [
        {"field": "age", "validations": ["isAdult"], "null_policy": "fail"},
        {
            "field": "office",
            "sql_expressions": [
                {"error_code": "a", "expression": "age < 65"},
                {"error_code": "b", "expression": "age < 65", "null_policy": "fail"},
            ],
        },
    ]
    found = errors(people, compile_rules(people, blocks), kind="full")
    assert found["cy"] == {"age": ["isAdult"], "office": ["b"]}
    assert found["di"] == {"office": ["a", "b"]}


def test_several_failures_on_one_field(spark):
    df = spark.createDataFrame([("x", 70)], "name STRING, age INT")
    blocks = [
        {
            "field": "age",
            "sql_expressions": [
                {"error_code": "young", "expression": "age < 30"},
                {"error_code": "working", "expression": "age < 65"},
            ],
        }
    ]
    rules = compile_rules(df, blocks)
    assert errors(df, rules) == {"x": {"age": "young"}}
    assert errors(df, rules, kind="full") == {"x": {"age": ["young", "working"]}}
    assert errors(df, list(reversed(rules))) == {"x": {"age": "working"}}


def test_a_rule_stated_twice_counts_once(people):
    blocks = [
        {"field": "office", "validations": ["notEmpty"]},
        {"field": "age", "validations": ["notNull"]},
        {"field": "age", "validations": ["notNull", "isAdult"]},
    ]
    rules = compile_rules(people, blocks)
    assert [(rule.field, rule.code) for rule in rules] == [
        ("office", "notEmpty"),
        ("age", "notNull"),
        ("age", "isAdult"),
    ]
    assert errors(people, rules, kind="full")["cy"] == {"age": ["notNull"]}


def test_two_expressions_under_one_code(people):
    blocks = [
        {
            "field": "age",
            "sql_expressions": [
                {"error_code": "range", "expression": "age >= 18"},
                {"error_code": "range", "expression": "age < 65"},
            ],
        }
    ]
    rules = compile_rules(people, blocks)
    assert len(rules) == 1
    assert set(errors(people, rules)) == {"bo", "di"}
    blocks[0]["sql_expressions"][1]["null_policy"] = "fail"
    with pytest.raises(RuleError, match="two null policies"):
        compile_rules(people, blocks)


def test_unknown_rule(people):
    blocks = [{"field": "age", "validations": ["noSuchRule", "notNull"]}]
    with pytest.raises(RuleError, match="noSuchRule"):
        compile_rules(people, blocks)
    assert [rule.code for rule in compile_rules(people, blocks, on_unknown="skip")] == ["notNull"]


@pytest.mark.parametrize(
    "blocks, message",
    [
        ([{"field": "nope", "validations": ["notNull"]}, {"field": "age"}], r"\['nope'\] are not in the input"),
        ([{"validations": ["notNull"]}], "without a field"),
        ([{"field": "age", "sql_expressions": [{"error_code": "x", "expression": "age + 1"}]}], "not boolean"),
        ([{"field": "age", "sql_expressions": [{"error_code": "x", "expression": "nope > 1"}]}], "does not resolve"),
        ([{"field": "age", "sql_expressions": [{"error_code": "x", "expression": "age >"}]}], "does not resolve: .*PARSE"),
        ([{"field": "age", "sql_expressions": [{"expression": "age > 1"}]}], "no error code"),
        ([{"field": "age", "sql_expressions": [{"error_code": "x"}]}], "no expression"),
        ([{"field": "age", "validations": ["notNull"], "null_policy": "maybe"}], "null_policy"),
    ],
)
def test_bad_rules_fail_when_compiled(people, blocks, message):
    with pytest.raises(RuleError, match=message):
        compile_rules(people, blocks)


@pytest.mark.parametrize("option", [{"code_style": "x"}, {"nulls": "x"}, {"on_unknown": "x"}])
def test_bad_options(people, option):
    with pytest.raises(RuleError):
        compile_rules(people, [], **option)


def test_not_empty_does_not_trim_and_knows_types(spark):
    df = spark.createDataFrame([(" ", 0), ("", 1), (None, None)], "text STRING, number INT")
    blocks = [{"field": "text", "validations": ["notEmpty"]}]
    assert [r["text"] for r in valid_rows(df, compile_rules(df, blocks)).collect()] == [" "]
    blocks = [{"field": "number", "validations": ["notEmpty"]}]
    assert [r["number"] for r in valid_rows(df, compile_rules(df, blocks)).collect()] == [0, 1]


def test_adult_rule_on_text(spark):
    rows = [("17",), ("18",), ("18.5",), ("old",), (None,)]
    df = spark.createDataFrame(rows, "age STRING")
    rules = compile_rules(df, [{"field": "age", "validations": ["isAdult"]}])
    assert [row["age"] for row in rejected_rows(df, rules).collect()] == ["17"]


def test_quotes_in_codes_are_harmless(people):
    blocks = [{"field": "age", "sql_expressions": [{"error_code": "it's", "expression": "age < 65"}]}]
    assert errors(people, compile_rules(people, blocks)) == {"di": {"age": "it's"}}


def test_nested_fields(spark):
    df = spark.createDataFrame([(("RIO",),), (("",),)], "home STRUCT<city STRING>")
    rules = compile_rules(df, [{"field": "home.city", "validations": ["notEmpty"]}])
    assert [row[TRACE_COLUMN] for row in rejected_rows(df, rules).collect()] == [
        {"home.city": "notEmpty"}
    ]


def test_registered_rule(people):
    register_rule("inSpain", lambda column: column == "MADRID", "in_spain")
    assert "inSpain" in registered_rules()
    blocks = [{"field": "office", "validations": ["inSpain"]}]
    found = errors(people, compile_rules(people, blocks, code_style="qualified"), kind="array")
    assert found["cy"] == ["office_in_spain"] and "di" not in found
    register_rule("typed", lambda column, dtype: F.lit(dtype.simpleString() == "int"))
    blocks = [{"field": "age", "validations": ["typed"]}]
    assert split(people, compile_rules(people, blocks)).ko.count() == 0
    with pytest.raises(RuleError):
        register_rule("", lambda column: column)


@pytest.mark.parametrize("kind, dtype", [
    ("map", "map<string,string>"), ("array", "array<string>"), ("full", "map<string,array<string>>"),
])
def test_without_rules_all_rows_are_valid(people, kind, dtype):
    result = split(people, [], kind=kind)
    assert multiset(result.ok) == multiset(people)
    assert result.ko.count() == 0
    assert result.ko.schema[TRACE_COLUMN].dataType.simpleString() == dtype


def test_trace_types_and_clean_rows(people, rules):
    compiled = compile_rules(people, rules)
    for kind, dtype in [
        ("map", "map<string,string>"), ("array", "array<string>"), ("full", "map<string,array<string>>"),
    ]:
        marked = annotate(people, compiled, kind=kind)
        assert marked.schema[TRACE_COLUMN].dataType.simpleString() == dtype
        sizes = {row["name"]: row["n"] for row in marked.withColumn("n", F.size(TRACE_COLUMN)).collect()}
        assert sizes == {"ada": 0, "bo": 2, "cy": 1, "di": 1, "ed": 1, "flo": 0}
    with pytest.raises(RuleError):
        annotate(people, compiled, kind="list")


def test_rule_order_decides_the_map_and_not_the_split(people, rules):
    compiled = compile_rules(people, [*rules, {"field": "age", "sql_expressions": [
        {"error_code": "old", "expression": "age < 60"}]}])
    turned = list(reversed(compiled))
    assert multiset(split(people, compiled).ok) == multiset(split(people, turned).ok)
    assert errors(people, compiled)["di"] == {"age": "not_retirement_age"}
    assert errors(people, turned)["di"] == {"age": "old"}


@pytest.mark.parametrize("expression", ["rand() < 0.5", "count(*) > 1", "uuid() = name", "row_number() OVER (ORDER BY age) > 1"])
def test_rules_judge_one_row_and_always_alike(people, expression):
    blocks = [{"field": "age", "sql_expressions": [{"error_code": "x", "expression": expression}]}]
    with pytest.raises(RuleError, match="deterministic check of one row"):
        compile_rules(people, blocks)


def test_registered_rules_are_checked_too(people):
    register_rule("broken", lambda column: column + 1)
    with pytest.raises(RuleError, match="broken"):
        compile_rules(people, [{"field": "age", "validations": ["broken"]}])
    register_rule("isShort", lambda column: F.coalesce(F.length(column) < 5, F.lit(True)), total=True)
    rules = compile_rules(people, [{"field": "office", "validations": ["isShort"]}])
    assert rules[0].total and set(errors(people, rules)) == {"di", "flo"}
