"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from rowsieve_checks import evolution
from rowsieve_checks.inputs import PERSON_COLUMNS

PERSON = f"WITH person AS (SELECT {PERSON_COLUMNS} FROM lineitem)"

BAD_OFFICE = "(office IS NULL OR office = '')"
BAD = f"({BAD_OFFICE} OR age IS NULL OR age < 18 OR age >= 65)"
PEOPLE = "l_orderkey, l_linenumber, name, age, office"
KEYS = "l_orderkey, l_linenumber"

CODES = f"""concat_ws(',',
  CASE WHEN {BAD_OFFICE} THEN 'office_not_empty' END,
  CASE WHEN age IS NULL THEN 'age_not_null' END,
  CASE WHEN age < 18 THEN 'age_must_be_adult' END,
  CASE WHEN age >= 65 THEN 'age_not_retirement_age' END)"""
FIRST_OFFICE = f"CASE WHEN {BAD_OFFICE} THEN 'notEmpty' END AS office_error"
FIRST_AGE = """CASE WHEN age IS NULL THEN 'notNull' WHEN age < 18 THEN 'isAdult'
  WHEN age >= 65 THEN 'not_retirement_age' END AS age_error"""

VALID = f"{PERSON} SELECT {PEOPLE} FROM person WHERE NOT {BAD}"
REJECTED = f"{PERSON} SELECT {PEOPLE} FROM person WHERE {BAD}"
REJECTED_CODES = f"{PERSON} SELECT {KEYS}, {CODES} AS codes FROM person WHERE {BAD}"
REJECTED_FIRST = f"{PERSON} SELECT {PEOPLE}, {FIRST_OFFICE}, {FIRST_AGE} FROM person WHERE {BAD}"
GOLD = f"""{PERSON} SELECT office, count(*) AS total_employees, round(avg(age), 1) AS average_age
  FROM person WHERE NOT {BAD} GROUP BY office"""
ALL_PEOPLE = f"{PERSON} SELECT {PEOPLE} FROM person"


def _failed(rule: str, condition: str) -> str:
    field = rule.split("_")[0]
    return f"""SELECT '{field}' AS field, '{rule}' AS rule,
      count(*) FILTER (WHERE {condition}) AS failed FROM person"""


FAILURES = " UNION ALL ".join(
    _failed(rule, condition)
    for rule, condition in (
        ("office_not_empty", BAD_OFFICE),
        ("age_not_null", "age IS NULL"),
        ("age_must_be_adult", "age < 18"),
        ("age_not_retirement_age", "age >= 65"),
    )
)

CLEANED = "SELECT c_custkey, concat('EMP_', upper(c_name)) AS processed_name FROM customer"
WELL_FORMED = "SELECT c_custkey, true AS well_formed FROM customer"

GOVERNED_OUTSIDER = f"""{PERSON}
  SELECT l_orderkey, l_linenumber, 'REDACTED_PII' AS name, age, office FROM person"""

RESCUE = f"""{PERSON}, line AS (
  SELECT *, CASE WHEN l_orderkey % 19 = 3 THEN 'corrupt' WHEN l_orderkey % 13 = 0 THEN 'old'
    WHEN l_orderkey % 13 = 1 THEN 'text' WHEN l_orderkey % 13 = 2 THEN 'upper'
    ELSE 'fits' END AS kind
  FROM person)
SELECT
  CASE WHEN kind <> 'corrupt' THEN l_orderkey END AS l_orderkey,
  CASE WHEN kind <> 'corrupt' THEN l_linenumber END AS l_linenumber,
  CASE WHEN kind <> 'corrupt' THEN name END AS name,
  CASE WHEN kind = 'fits' THEN age END AS age,
  CASE WHEN kind IN ('fits', 'old', 'text') THEN office END AS office"""
RESCUED = f"""{RESCUE},
  CAST(CASE kind WHEN 'corrupt' THEN NULL WHEN 'old' THEN 2
    WHEN 'fits' THEN 0 ELSE CASE WHEN age IS NULL THEN 0 ELSE 1 END END AS INT) AS n_rescued,
  CASE kind WHEN 'old' THEN 'old' WHEN 'text' THEN CAST(age AS STRING) END AS rescued_age,
  CASE kind WHEN 'old' THEN concat('{{"x":', CAST(l_linenumber AS STRING), '}}') END
    AS rescued_extra,
  CASE kind WHEN 'upper' THEN CAST(age AS STRING) END AS rescued_upper_age,
  CASE kind WHEN 'corrupt' THEN concat('no json ', name) END AS corrupt_record
FROM line"""


def _draw(k: int) -> str:
    word = f"substr(md5(concat('42:', CAST(o_orderkey AS STRING))), {8 * k + 1}, 8)"
    return f"(CAST(CAST(concat('0x', {word}) AS BIGINT) AS DOUBLE) / 4294967296.0)"


SYNTHETIC = f"""SELECT concat('User_', CAST(o_orderkey AS STRING)) AS name,
  CASE WHEN {_draw(0)} < 0.1 THEN NULL ELSE CAST(floor({_draw(1)} * 75 + 10) AS INT) END AS age,
  CASE WHEN {_draw(2)} < 0.1 THEN '' WHEN {_draw(3)} < 0.5 THEN 'MADRID' ELSE 'RIO' END AS office
FROM orders"""

TEAM = "CASE WHEN l_linenumber > 3 THEN 'late' END AS team"
_SHARE = "CASE WHEN age IS NULL THEN NULL WHEN l_linenumber = 1 THEN false ELSE CAST(age AS DOUBLE) / (l_linenumber - 1) > 10 END"

ORACLE = {
    **evolution.oracle(PERSON, CODES, GOLD),
    "inferred_text_age": f"""{PERSON} SELECT {KEYS},
      CASE WHEN l_orderkey % 11 = 0 THEN 'old' ELSE CAST(age AS STRING) END AS age, 'too_old' AS codes
      FROM person WHERE l_orderkey % 11 = 0 OR age >= 65""",
    "rule_division": f"""{PERSON}, judged AS (SELECT {KEYS}, {_SHARE} AS good FROM person)
      SELECT {KEYS}, 'pass' AS policy, CASE WHEN coalesce(good, true) THEN 'ok' ELSE 'ko' END AS side FROM judged
      UNION ALL SELECT {KEYS}, 'fail', CASE WHEN coalesce(good, false) THEN 'ok' ELSE 'ko' END FROM judged""",
    "stream_schema_merge": f"{PERSON} SELECT {PEOPLE}, {TEAM} FROM person",
    "registered_table_widened": f"{PERSON} SELECT {PEOPLE}, {TEAM} FROM person",
    "append_case_and_type": ALL_PEOPLE,
    "overwrite_no_input": f"{PERSON} SELECT count(*) FILTER (WHERE false) AS rows FROM person",
    "inferred_two_runs": f"""{PERSON} SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
      CASE WHEN l_linenumber <= 3 THEN CAST(age AS BIGINT) END AS age,
      CASE WHEN l_linenumber > 3 AND age IS NOT NULL THEN concat(CAST(age AS STRING), '.5') END AS rescued_age,
      CASE WHEN l_linenumber > 3 THEN 'late' END AS rescued_team FROM person""",
    "gold_parts_added_later": GOLD,
    "no_rule_contract": f"""{PERSON} SELECT 'ok' AS side, count(*) AS rows FROM person
      UNION ALL SELECT 'ko', count(*) FILTER (WHERE false) FROM person""",
    "contract_from_file": GOLD,
    "run_then_governed": f"""{PERSON} SELECT {KEYS}, 'REDACTED_PII' AS name, office,
      CASE WHEN {BAD} THEN 'ko' ELSE 'ok' END AS side FROM person WHERE office = 'RIO'""",
    "masked_rescue": f"""{PERSON} SELECT {KEYS}, 'HR_ONLY' AS name, true AS hidden FROM person
      WHERE l_orderkey % 19 <> 3""",
    "rescue_nested": """WITH o AS (SELECT o_orderkey AS k, concat('c', CAST(o_custkey AS STRING)) AS c, o_orderkey % 4 AS kind FROM orders)
      SELECT CASE WHEN kind <> 3 THEN k END AS id,
        CASE WHEN kind IN (0, 1) THEN c WHEN kind = 2 THEN c END AS city,
        CAST(CASE WHEN kind IN (0, 1) THEN 9 END AS INT) AS zip,
        CASE kind WHEN 1 THEN concat('{"city":"', c, '","zip":9,"street":"x"}')
          WHEN 2 THEN concat('{"city":"', c, '","zip":"nine"}') END AS rescued_to,
        CASE WHEN kind = 3 THEN concat('{"id":', CAST(k AS STRING), ',"to":{"city":"', c, '","zip":9}} {"id":1}') END AS corrupt_record
      FROM o""",
    "rescue_options": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(0 AS INT) AS n_rescued FROM orders""",
    "layered_two_refreshes": GOLD,
    "layered_widened": f"{PERSON} SELECT {PEOPLE}, {TEAM} FROM person WHERE NOT {BAD}",
    "layered_full": GOLD,
    "generated_people": """SELECT count(*) AS rows, count(*) AS names, true AS ages_in_range, true AS known_offices
      FROM orders""",
    "gold_office_stats": GOLD,
    "valid_rows": VALID,
    "rejected_rows": REJECTED,
    "error_codes_array": REJECTED_CODES,
    "annotated_rows": f"""{PERSON} SELECT {KEYS}, {CODES} AS codes,
      CAST(CASE WHEN {BAD_OFFICE} THEN 1 ELSE 0 END
        + CASE WHEN age IS NULL OR age < 18 OR age >= 65 THEN 1 ELSE 0 END AS INT) AS n_errors
      FROM person""",
    "error_map_first": f"""{PERSON} SELECT {KEYS}, {FIRST_OFFICE}, {FIRST_AGE}
      FROM person WHERE {BAD}""",
    "error_map_full": f"""{PERSON} SELECT {KEYS},
      concat_ws(',', CASE WHEN {BAD_OFFICE} THEN 'notEmpty' END) AS office_errors,
      concat_ws(',', CASE WHEN age IS NULL THEN 'notNull' END,
        CASE WHEN age < 18 THEN 'isAdult' END,
        CASE WHEN age >= 65 THEN 'not_retirement_age' END,
        CASE WHEN age < 40 THEN 'too_young' END) AS age_errors
      FROM person WHERE {BAD} OR age < 40""",
    "duplicate_rules": f"""{PERSON}
      SELECT 'office' AS field, 'notEmpty' AS code, count(*) AS rejects
        FROM person WHERE {BAD_OFFICE}
      UNION ALL SELECT 'age', 'notNull', count(*) FROM person WHERE age IS NULL
      UNION ALL SELECT 'age', 'isAdult', count(*) FROM person WHERE age < 18""",
    "null_policy_pass": f"{PERSON} SELECT {PEOPLE} FROM person WHERE age >= 18 OR age IS NULL",
    "null_policy_fail": f"{PERSON} SELECT {PEOPLE} FROM person WHERE coalesce(age >= 18, false)",
    "no_rules": f"{PERSON} SELECT 'ok' AS side, count(*) AS rows FROM person",
    "empty_relation": f"{PERSON} SELECT {PEOPLE} FROM person WHERE false",
    "rejects_by_code": f"""{PERSON}, f AS ({FAILURES})
      SELECT rule AS code, failed AS rejects FROM f WHERE failed > 0""",
    "rejects_by_field": f"""{PERSON}
      SELECT 'office' AS field, 'notEmpty' AS code, count(*) AS rejects
        FROM person WHERE {BAD_OFFICE}
      UNION ALL SELECT 'age', 'notNull', count(*) FROM person WHERE age IS NULL
      UNION ALL SELECT 'age', 'isAdult', count(*) FROM person WHERE age < 18
      UNION ALL SELECT 'age', 'not_retirement_age', count(*) FROM person WHERE age >= 65""",
    "expectation_metrics": f"""{PERSON}, f AS ({FAILURES}),
      n AS (SELECT count(*) AS total FROM person)
      SELECT field, rule, failed, total - failed AS passed, total FROM f, n""",
    "observed_expectations": f"{PERSON} {FAILURES}",
    "brand_stats": """SELECT p_brand, count(*) AS parts, round(avg(p_size), 1) AS average_size
      FROM part GROUP BY p_brand""",
    "order_rules": """WITH judged AS (SELECT o_orderkey, concat_ws(',',
        CASE WHEN NOT (o_totalprice >= 5000) THEN 'too_small' END,
        CASE WHEN NOT (o_totalprice < 400000 OR o_orderpriority <> '1-URGENT')
          THEN 'large_and_urgent' END,
        CASE WHEN o_orderstatus IS NULL OR o_orderstatus = '' THEN 'notEmpty' END,
        CASE WHEN NOT (o_orderstatus <> 'O' OR o_orderdate >= TIMESTAMP '1993-01-01')
          THEN 'open_and_old' END) AS codes FROM orders)
      SELECT o_orderkey, codes FROM judged WHERE codes <> ''""",
    "custom_rule": """SELECT c_custkey, 'c_acctbal_not_negative' AS codes
      FROM customer WHERE c_acctbal < 0""",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "masked_view": f"{GOVERNED_OUTSIDER} WHERE NOT {BAD} AND office = 'RIO'",
    "masked_view_admin": VALID,
    "masked_rejects": f"""{PERSON} SELECT {KEYS}, 'REDACTED_PII' AS name, office, {FIRST_AGE}
      FROM person WHERE {BAD} AND office = 'RIO'""",
    "session_view": f"""{PERSON}
      SELECT 'outsider' AS seen_by, office, count(*) AS rows, count(*) AS masked
        FROM person WHERE office = 'RIO' GROUP BY office
      UNION ALL SELECT 'admin', office, count(*), 0 FROM person GROUP BY office""",
    "policy_functions": f"""{PERSON} SELECT {KEYS}, 'REDACTED_PII' AS name, office
      FROM person WHERE office = 'RIO'""",
    "clean_names": CLEANED,
    "clean_names_udf": CLEANED,
    "clean_names_arrow": CLEANED,
    "cleaning_comparison": """SELECT v.variant, n.row_count, true AS timed
      FROM (VALUES ('python_udf'), ('arrow_udf'), ('native')) AS v(variant),
        (SELECT count(*) AS row_count FROM lineitem) AS n""",
    "processing_time_text": WELL_FORMED,
    "processing_time_stamp": WELL_FORMED,
    "synthetic_people": SYNTHETIC,
    "aligned_rows": """SELECT event_id, CAST(user_id AS STRING) AS user_id,
      TRY_CAST(event_type AS INT) AS event_type, CAST(NULL AS STRING) AS office FROM events""",
    "stream_split_ok": VALID,
    "stream_split_ko": REJECTED_FIRST,
    "stream_gold": GOLD,
    "split_store_ok": VALID,
    "split_store_ko": REJECTED_FIRST,
    "split_store_counts": f"""{PERSON} SELECT CASE WHEN {BAD} THEN 'ko' ELSE 'ok' END AS side,
      count(*) AS rows FROM person GROUP BY 1""",
    "stream_replay": ALL_PEOPLE,
    "stream_incremental": ALL_PEOPLE,
    "stream_append_table": ALL_PEOPLE,
    "stream_rescue": RESCUED,
    "batch_rescue": RESCUED,
    "strict_schema": f"{RESCUE} FROM line",
    # Inference reads every whole JSON number as BIGINT.
    "inferred_ingest": f"""{PERSON} SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
      name, CAST(age AS BIGINT) AS age, office FROM person""",
    "variant_ingest": ALL_PEOPLE,
    "json_roundtrip": "SELECT * FROM customer",
    "table_overwrite_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "schema_merge": """SELECT c_custkey, c_name, CAST(NULL AS STRING) AS dt FROM customer
      UNION ALL SELECT c_custkey, c_name, 'later' FROM customer""",
    "table_schema_merge": """SELECT c_custkey, c_name, CAST(NULL AS STRING) AS dt FROM customer
      UNION ALL SELECT c_custkey, c_name, 'later' FROM customer
      UNION ALL SELECT c_custkey, c_name, NULL FROM customer""",
    "namespaced_table": "SELECT * FROM supplier",
    "clustered_table": ALL_PEOPLE,
    "governed_table_view": f"{GOVERNED_OUTSIDER} WHERE office = 'RIO'",
    "contract_ok": VALID,
    "contract_ko": REJECTED_FIRST,
    "contract_store_ko": REJECTED_FIRST,
    "contract_gold": GOLD,
    "contract_gold_from_parts": GOLD,
    "contract_batch_ko": REJECTED_FIRST,
    "audit_row": f"""{PERSON} SELECT 'person-quality' AS pipeline_name, 'dev' AS environment,
      count(*) FILTER (WHERE NOT {BAD}) AS rows_ok, count(*) FILTER (WHERE {BAD}) AS rows_ko,
      'ok' AS status FROM person""",
    "layered_ok": VALID,
    "layered_ko": REJECTED_CODES,
    "layered_gold": GOLD,
}
