"""Rules whose evaluation would raise an error."""

import pytest
from pyspark.sql import functions as F

from rowsieve.operators.attempt import tried, without_errors
from rowsieve.operators.rules import RuleError, compile_rules, register_rule
from rowsieve.operators.split import is_ok, rejected_rows, split, valid_rows
from rowsieve.session import session_conf
from tests.conftest import plan_of

ROWS = [
    (1, 2147483647, 2147483647, "7", "(", [1, 2], "2024-02-30"),
    (2, 1, 0, "x", "a\\", [1], "2024-02-29"),
    (3, -2147483648, -1, "x", "x", None, "never"),
    (4, None, 3, None, "x%", [], None),
]
SCHEMA = "id INT, a INT, b INT, t STRING, p STRING, l ARRAY<INT>, d STRING"


@pytest.fixture
def rows(spark):
    frame = spark.createDataFrame(ROWS, f"{SCHEMA}")
    return frame.withColumn("s", F.when(F.col("id") < 4, F.struct("a", "t")))


CASES = {
    "a + b < 10": {2, 4},
    "a - b < 0": {3, 4},
    "a * b < 10": {2, 4},
    "a / b > 0": {1, 3, 4},
    "a % b = 0": {1, 3, 4},
    "a div b > 0": {1, 3, 4},
    "pmod(a, b) = 0": {1, 3, 4},
    "-a < 5": {1, 2, 4},
    "abs(a) >= 1": {1, 2, 4},
    "CAST(t AS INT) = 7": {1, 4},
    "t > 3": {1, 4},
    "CAST(t AS INT) = 7 OR id = 2": {1, 2, 4},
    "l[1] = 2": {1, 3},
    "element_at(l, 2) = 2": {1, 3},
    "t LIKE p OR id = 2": {2, 3, 4},
    "t RLIKE p": {3, 4},
    "to_date(d) = DATE'2024-02-29'": {2, 4},
    "s.a + 1 < 10": {2, 3, 4},
    "CASE WHEN id < 3 THEN a + b ELSE 1 END < 10": {2, 3, 4},
    "a + b BETWEEN 0 AND 3": {2, 4},
    "coalesce(a + b, 1) = 1 AND t IN ('7', 'x')": {1, 2, 3, 4},
    "if(a + 1 > 0, true, false)": {2},
}


def rules_of(frame, expression, **more):
    return compile_rules(frame, [{"field": "id", "sql_expressions": [{"error_code": "e", "expression": expression}]}], **more)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("expression", CASES)
def test_errors_break_the_rule(spark, rows, expression, ansi):
    if ansi == "false" and "to_date" in expression:
        pytest.skip("what has no form without errors follows the session")
    with session_conf(spark, {"spark.sql.ansi.enabled": ansi}):
        ok, ko = split(rows, rules_of(rows, expression))
        assert [sorted(r.id for r in side.collect()) for side in (ok, ko)] == [sorted(CASES[expression]), sorted({1, 2, 3, 4} - CASES[expression])]


def test_strict_null_policy(rows):
    rules = rules_of(rows, "a + b < 10", nulls="fail")
    assert {r.id for r in valid_rows(rows, rules).collect()} == {2}
    assert {r.id for r in rejected_rows(rows, rules).collect()} == {1, 3, 4}


def test_registered_rules_do_not_raise(rows):
    register_rule("seven", lambda column: column.cast("int") == 7, total=True)
    rules = compile_rules(rows, [{"field": "t", "validations": ["seven"]}])
    assert {r.id for r in valid_rows(rows, rules).collect()} == {1, 4}
    assert {r.id for r in rejected_rows(rows, rules).collect()} == {2, 3}


@pytest.mark.parametrize("expression", ["t RLIKE '('", "t LIKE 'a\\\\'", "id = 1 OR t RLIKE '[a'"])
def test_written_patterns_are_checked_first(rows, expression):
    with pytest.raises(RuleError, match="is not a pattern"):
        rules_of(rows, expression)


@pytest.mark.parametrize("expression", ["t LIKE 'a\\\\%_'", "t RLIKE '^[a-z]+$'", "a < 10 AND t = 'x'", "a BETWEEN 1 AND b", "CAST(a AS BIGINT) < 10"])
def test_what_cannot_fail_stays_as_it_is(rows, expression):
    predicate = F.expr(expression)
    assert without_errors(rows, predicate) == (predicate, None)


def test_plain_comparisons_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(valid_rows(frame, [*rules_of(frame, "a < 65"), *rules_of(frame, "a + b < 10")]))
    assert "PushedFilters: [Or(LessThan(a,65),IsNull(a))]" in plan


@pytest.mark.parametrize("expression", ["a + 1", "rand() * a < 1", "count(a) + 1 > 0", "nothing + 1 < 2"])
def test_what_is_no_check_of_a_row_is_still_refused(rows, expression):
    with pytest.raises(RuleError):
        rules_of(rows, expression)


def test_the_settings_of_the_session_are_left_alone(spark, rows, monkeypatch):
    changed = []
    monkeypatch.setattr(type(spark.conf), "set", lambda self, *a: changed.append(a))
    is_ok(rules_of(rows, "a + b < 10 OR to_date(d) > DATE'2020-01-01'"))
    assert not changed


def test_tried(spark, rows):
    found = rows.select("id", tried(F.expr("CAST(t AS INT) = 7")).alias("x")).collect()
    assert {r.id: r.x for r in found} == {1: True, 2: None, 3: None, 4: None}
