"""Registered queries that are one batch plan each."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve_checks.inputs import ORDER_RULES, PERSON_RULES, people, table
from rowsieve.functions.people import people_from_ids
from rowsieve.functions.text import clean_name, clean_name_udf
from rowsieve.operators.aggregate import grouped_stats, row_count
from rowsieve.operators.enrich import TIME_FORMAT, add_processing_time, align
from rowsieve.operators.governance import (
    PERSON_POLICIES,
    create_policy_functions,
    governed,
    publish_session_view,
    set_principal,
)
from rowsieve.operators.metrics import (
    expectation_metrics,
    observe_rules,
    observed_failures,
    rejects_by_code,
)
from rowsieve.operators.rules import compile_rules, register_rule
from rowsieve.operators.split import TRACE_COLUMN, annotate, rejected_rows, split, valid_rows
from rowsieve.plans.compare import compare_cleaning
from rowsieve.sinks.tables import write_noop
from rowsieve.sources.files import as_schema, empty_like

KEYS = ("l_orderkey", "l_linenumber")
ADULT_ONLY = [{"field": "age", "validations": ["isAdult"]}]


def _judged(spark: SparkSession, sf_dir: str, **options):
    rows = people(spark, sf_dir)
    return rows, compile_rules(rows, PERSON_RULES, **options)


def gold_office_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    return grouped_stats(valid_rows(rows, rules), "office", "age")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    return split(rows, rules).ok


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    return split(rows, rules).ko.drop(TRACE_COLUMN)


def error_codes_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir, code_style="qualified")
    bad = rejected_rows(rows, rules, kind="array")
    return bad.select(*KEYS, F.concat_ws(",", TRACE_COLUMN).alias("codes"))


def annotated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir, code_style="qualified")
    marked = annotate(rows, rules, kind="array")
    return marked.select(
        *KEYS, F.size(TRACE_COLUMN).alias("n_errors"), F.concat_ws(",", TRACE_COLUMN).alias("codes")
    )


def error_map_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    errors = F.col(TRACE_COLUMN)
    return rejected_rows(rows, rules, kind="map").select(
        *KEYS, errors["office"].alias("office_error"), errors["age"].alias("age_error")
    )


def error_map_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    # "Older than 40" fails next to the other age rules, so a field has several codes.
    rows = people(spark, sf_dir)
    extra = {"error_code": "too_young", "expression": "age >= 40"}
    rules = compile_rules(rows, [*PERSON_RULES, {"field": "age", "sql_expressions": [extra]}])
    errors = F.col(TRACE_COLUMN)
    return rejected_rows(rows, rules, kind="full").select(
        *KEYS,
        F.concat_ws(",", errors["office"]).alias("office_errors"),
        F.concat_ws(",", errors["age"]).alias("age_errors"),
    )


def duplicate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule stated twice for a field: one entry in the trace."""
    rows = people(spark, sf_dir)
    twice = [
        {"field": "office", "validations": ["notEmpty"]},
        {"field": "age", "validations": ["notNull"]},
        {"field": "age", "validations": ["notNull", "isAdult"]},
    ]
    bad = rejected_rows(rows, compile_rules(rows, twice))
    return rejects_by_code(bad)


def null_policy_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir)
    return valid_rows(rows, compile_rules(rows, ADULT_ONLY, nulls="pass"))


def null_policy_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir)
    return valid_rows(rows, compile_rules(rows, ADULT_ONLY, nulls="fail"))


def no_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir)
    ok, ko = split(rows, [])
    both = ok.withColumn("side", F.lit("ok")).unionByName(
        ko.drop(TRACE_COLUMN).withColumn("side", F.lit("ko"))
    )
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


def empty_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_like(people(spark, sf_dir))


def rejects_per_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir, code_style="qualified")
    return rejects_by_code(rejected_rows(rows, rules, kind="array"))


def rejects_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    return rejects_by_code(rejected_rows(rows, rules, kind="full"))


def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir, code_style="qualified")
    return expectation_metrics(rows, rules)


def observed_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same failures, counted while another action reads the rows."""
    rows, rules = _judged(spark, sf_dir, code_style="qualified")
    observed, observation = observe_rules(rows, rules, f"observed-{uuid.uuid4()}")
    write_noop(observed)
    failures = observed_failures(observation.get, rules)
    rows = [(field, rule, failed) for (field, rule), failed in failures.items()]
    return spark.createDataFrame(rows, "field STRING, rule STRING, failed BIGINT")


def brand_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return grouped_stats(parts, "p_brand", "p_size", count_as="parts", mean_as="average_size")


def order_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rules = compile_rules(orders, ORDER_RULES)
    bad = rejected_rows(orders, rules, kind="array")
    return bad.select("o_orderkey", F.concat_ws(",", TRACE_COLUMN).alias("codes"))


def custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_rule("notNegative", lambda column: column >= 0, "not_negative")
    customers = table(spark, sf_dir, "customer")
    blocks = [{"field": "c_acctbal", "validations": ["notNull", "notEmpty", "notNegative"]}]
    rules = compile_rules(customers, blocks, code_style="qualified")
    bad = rejected_rows(customers, rules, kind="array")
    return bad.select("c_custkey", F.concat_ws(",", TRACE_COLUMN).alias("codes"))


def total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


def _masked(spark: SparkSession, sf_dir: str, groups) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    return governed(valid_rows(rows, rules), PERSON_POLICIES, groups)


def masked_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, ())


def masked_view_admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, ("admin",))


def masked_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rules = _judged(spark, sf_dir)
    shown = governed(rejected_rows(rows, rules), PERSON_POLICIES, ())
    errors = F.col(TRACE_COLUMN)
    return shown.select(*KEYS, "name", "office", errors["age"].alias("age_error"))


def session_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a session sees through a view as an outsider and as an admin."""
    people(spark, sf_dir).createOrReplaceTempView("person_rows")
    publish_session_view(spark, "person_shown", "person_rows")
    outsider = spark.table("person_shown").withColumn("seen_by", F.lit("outsider"))
    outsider = outsider.groupBy("seen_by", "office").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("name") == "REDACTED_PII").alias("masked")
    )
    set_principal(spark, ("admin",))
    admin = spark.table("person_shown").withColumn("seen_by", F.lit("admin"))
    admin = admin.groupBy("seen_by", "office").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("name") == "REDACTED_PII").alias("masked")
    )
    result = outsider.unionByName(admin)
    set_principal(spark, ())
    return result


def policy_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_policy_functions(spark)
    rows = people(spark, sf_dir)
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, name_mask_policy(name) AS name, office FROM {rows} "
        "WHERE office_filter_policy(office)",
        rows=rows,
    )


def _padded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(
            F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).otherwise(F.lit("")),
            F.lower("c_name"),
            F.when(F.col("c_custkey") % 4 == 0, F.lit("   ")).otherwise(F.lit("")),
        ).alias("name"),
    )


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _padded_customers(spark, sf_dir)
    return rows.select("c_custkey", clean_name("name").alias("processed_name"))


def clean_names_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _padded_customers(spark, sf_dir)
    return rows.select("c_custkey", clean_name_udf()("name").alias("processed_name"))


def clean_names_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _padded_customers(spark, sf_dir)
    return rows.select("c_custkey", clean_name_udf(arrow=True)("name").alias("processed_name"))


def cleaning_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir)
    result = compare_cleaning(rows, "name", runs=1)
    return result.select("variant", "row_count", (F.col("seconds") > 0).alias("timed"))


def processing_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_processing_time(table(spark, sf_dir, "customer"))
    well_formed = F.date_format(F.to_timestamp("dt", TIME_FORMAT), TIME_FORMAT) == F.col("dt")
    return rows.select("c_custkey", F.coalesce(well_formed, F.lit(False)).alias("well_formed"))


def processing_time_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_processing_time(table(spark, sf_dir, "customer"), as_type="timestamp")
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("dt")
    return rows.select("c_custkey", (age == 0).alias("well_formed"))


def synthetic_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_from_ids(table(spark, sf_dir, "orders"), "o_orderkey", seed=42)


def aligned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another declared schema: a column cast, one missing, one kept, the rest dropped."""
    events = table(spark, sf_dir, "events")
    schema = "event_id BIGINT, user_id STRING, event_type INT, office STRING"
    return align(events, as_schema(schema), strict=True)


def inferred_text_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that came as text, some of them words: such a row is rejected with the rule's code, the run goes on."""
    rows = people(spark, sf_dir)
    text = F.when(F.col("l_orderkey") % 11 == 0, F.lit("old")).otherwise(F.col("age").cast("string"))
    rows = rows.withColumn("age", text)
    rules = compile_rules(rows, [{"field": "age", "sql_expressions": [{"error_code": "too_old", "expression": "age < 65"}]}])
    ko = split(rows, rules, kind="array").ko
    return ko.select("l_orderkey", "l_linenumber", "age", F.concat_ws(",", TRACE_COLUMN).alias("codes"))


def rule_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A division by zero rejects its row under both null policies; a missing value only where NULL fails."""
    rows = people(spark, sf_dir).withColumn("parts", F.col("l_linenumber") - 1)
    expression = "age / parts > 10"
    out = []
    for policy in ("pass", "fail"):
        block = {"field": "age", "sql_expressions": [{"error_code": "share", "expression": expression, "null_policy": policy}]}
        sides = split(rows, compile_rules(rows, [block]))
        for side, part in zip(("ok", "ko"), sides):
            out.append(part.select("l_orderkey", "l_linenumber", F.lit(policy).alias("policy"), F.lit(side).alias("side")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


QUERIES = {
    "inferred_text_age": inferred_text_age,
    "rule_division": rule_division,
    "gold_office_stats": gold_office_stats,
    "valid_rows": valid,
    "rejected_rows": rejected,
    "error_codes_array": error_codes_array,
    "annotated_rows": annotated_rows,
    "error_map_first": error_map_first,
    "error_map_full": error_map_full,
    "duplicate_rules": duplicate_rules,
    "null_policy_pass": null_policy_pass,
    "null_policy_fail": null_policy_fail,
    "no_rules": no_rules,
    "empty_relation": empty_relation,
    "rejects_by_code": rejects_per_code,
    "rejects_by_field": rejects_per_field,
    "expectation_metrics": expectations,
    "observed_expectations": observed_expectations,
    "brand_stats": brand_stats,
    "order_rules": order_rules,
    "custom_rule": custom_rule,
    "row_count": total_rows,
    "masked_view": masked_view,
    "masked_view_admin": masked_view_admin,
    "masked_rejects": masked_rejects,
    "session_view": session_view,
    "policy_functions": policy_functions,
    "clean_names": clean_names,
    "clean_names_udf": clean_names_udf,
    "clean_names_arrow": clean_names_arrow,
    "cleaning_comparison": cleaning_comparison,
    "processing_time_text": processing_time_text,
    "processing_time_stamp": processing_time_stamp,
    "synthetic_people": synthetic_people,
    "aligned_rows": aligned_rows,
}
