"""Inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Person rows out of lineitem, with NULL ages and empty offices put in by arithmetic. The same
# text runs on Spark and DuckDB.
PERSON_COLUMNS = """
  l_orderkey, l_linenumber,
  concat('User_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS name,
  CAST(CASE WHEN (l_orderkey*7+l_linenumber) % 10 = 0 THEN NULL
       ELSE 10 + (l_orderkey*31+l_linenumber*17) % 75 END AS INT) AS age,
  CASE WHEN (l_orderkey*3+l_linenumber) % 10 = 0 THEN ''
       WHEN l_linenumber % 2 = 0 THEN 'MADRID' ELSE 'RIO' END AS office
"""
PERSON_SCHEMA = "l_orderkey BIGINT, l_linenumber INT, name STRING, age INT, office STRING"

# The production rules.
PERSON_RULES = [
    {"field": "office", "validations": ["notEmpty"]},
    {
        "field": "age",
        "validations": ["notNull", "isAdult"],
        "sql_expressions": [{"error_code": "not_retirement_age", "expression": "age < 65"}],
    },
]

ORDER_RULES = [
    {
        "field": "o_totalprice",
        "sql_expressions": [
            {"error_code": "too_small", "expression": "o_totalprice >= 5000"},
            {
                "error_code": "large_and_urgent",
                "expression": "o_totalprice < 400000 OR o_orderpriority <> '1-URGENT'",
            },
        ],
    },
    {
        "field": "o_orderstatus",
        "validations": ["notEmpty"],
        "sql_expressions": [
            {
                "error_code": "open_and_old",
                "expression": "o_orderstatus <> 'O' OR o_orderdate >= TIMESTAMP_NTZ'1993-01-01'",
            }
        ],
    },
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return spark.sql(f"SELECT {PERSON_COLUMNS} FROM {{rows}}", rows=rows)


# Lines that do not fit the schema: text where a number belongs, undeclared keys, a key in the
# wrong case, and lines that are no JSON.
OFF_SCHEMA_COLUMNS = """
  CASE
    WHEN l_orderkey % 19 = 3 THEN concat('no json ', name)
    WHEN l_orderkey % 13 = 0 THEN to_json(named_struct('l_orderkey', l_orderkey,
      'l_linenumber', l_linenumber, 'name', name, 'age', 'old', 'office', office,
      'extra', named_struct('x', l_linenumber)))
    WHEN l_orderkey % 13 = 1 THEN to_json(named_struct('l_orderkey', l_orderkey,
      'l_linenumber', l_linenumber, 'name', name, 'age', CAST(age AS STRING), 'office', office))
    WHEN l_orderkey % 13 = 2 THEN to_json(named_struct('l_orderkey', l_orderkey,
      'l_linenumber', l_linenumber, 'name', name, 'AGE', age))
    ELSE to_json(named_struct('l_orderkey', l_orderkey,
      'l_linenumber', l_linenumber, 'name', name, 'age', age, 'office', office))
  END AS value
"""


def off_schema_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir)
    return spark.sql(f"SELECT {OFF_SCHEMA_COLUMNS} FROM {{rows}}", rows=rows)
