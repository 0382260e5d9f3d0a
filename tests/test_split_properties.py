from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import annotate, split

# Each named or SQL check next to its meaning in Python: True, False, or None for NULL.
CHECKS = {
    ("office", "notNull"): (None, lambda age, office: office is not None),
    ("office", "notEmpty"): (None, lambda age, office: office is not None and office != ""),
    ("age", "notNull"): (None, lambda age, office: age is not None),
    ("age", "isAdult"): (None, lambda age, office: None if age is None else age >= 18),
    ("age", "working"): ("age < 65", lambda age, office: None if age is None else age < 65),
    ("office", "known"): (
        "office IN ('RIO', 'MADRID')",
        lambda age, office: None if office is None else office in ("RIO", "MADRID"),
    ),
}

rows_of = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 90)),
        st.sampled_from([None, "", " ", "RIO", "MADRID", "PARIS"]),
    ),
    min_size=1,
    max_size=25,
)
rules_of = st.lists(
    st.tuples(st.sampled_from(sorted(CHECKS)), st.sampled_from(["pass", "fail"])),
    min_size=1,
    max_size=6,
    unique_by=lambda item: item[0],
)


def block(key, policy):
    expression, _ = CHECKS[key]
    field, code = key
    if expression is None:
        return {"field": field, "validations": [code], "null_policy": policy}
    rule = {"error_code": code, "expression": expression}
    return {"field": field, "sql_expressions": [rule], "null_policy": policy}


def failed(key, policy, age, office):
    verdict = CHECKS[key][1](age, office)
    return verdict is False or (verdict is None and policy == "fail")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_of, chosen=rules_of)
def test_split_means_what_the_rules_say(spark, rows, chosen):
    data = [(i, age, office) for i, (age, office) in enumerate(rows)]
    df = spark.createDataFrame(data, "id INT, age INT, office STRING").coalesce(1)
    rules = compile_rules(df, [block(key, policy) for key, policy in chosen])
    expected = {
        i: [key for key, policy in chosen if failed(key, policy, age, office)]
        for i, age, office in data
    }
    sides = split(df, rules, kind="array", column="array")
    ok = sides.ok.collect()
    marked = annotate(annotate(sides.ko, rules, kind="map", column="map"), rules, kind="full", column="full")
    rejected = marked.collect()
    traces = {kind: {row["id"]: row[kind] for row in rejected} for kind in ("map", "array", "full")}
    assert Counter(row["id"] for row in ok) == Counter(i for i, codes in expected.items() if not codes)
    bad = {i: codes for i, codes in expected.items() if codes}
    assert traces["array"] == {i: [code for _, code in codes] for i, codes in bad.items()}
    full = {}
    for i, codes in bad.items():
        full[i] = {}
        for field, code in codes:
            full[i].setdefault(field, []).append(code)
    assert traces["full"] == full
    assert traces["map"] == {
        i: {field: codes[0] for field, codes in fields.items()} for i, fields in full.items()
    }
