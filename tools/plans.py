"""Print the physical plans of the main operators over a stored table: plans.py [sf_dir]."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bench import session  # noqa: E402
from rowsieve.functions.text import clean_name  # noqa: E402
from rowsieve.operators.aggregate import grouped_stats  # noqa: E402
from rowsieve.operators.governance import PERSON_POLICIES, governed  # noqa: E402
from rowsieve.operators.metrics import expectation_metrics, rejects_by_code  # noqa: E402
from rowsieve.operators.rules import compile_rules  # noqa: E402
from rowsieve.operators.split import split  # noqa: E402
from rowsieve.scratch import new_dir  # noqa: E402
from rowsieve.sinks.tables import clustered  # noqa: E402
from rowsieve_checks.inputs import PERSON_RULES, people  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session("8")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    path = new_dir(spark, "people")
    people(spark, sf_dir).drop("l_orderkey", "l_linenumber").write.parquet(path)
    rows = spark.read.parquet(path)
    rules = compile_rules(rows, PERSON_RULES)
    sides = split(rows, rules)
    plans = {
        "valid rows": sides.ok,
        "rejected rows with the map trace": sides.ko,
        "gold summary": grouped_stats(sides.ok, "office", "age"),
        "rejects by code": rejects_by_code(split(rows, rules, kind="array").ko),
        "expectation metrics": expectation_metrics(rows, rules),
        "governed rows, outsider": governed(rows, PERSON_POLICIES, ()),
        "cleaned names": rows.select(clean_name("name").alias("processed_name")),
        "clustered layout": clustered(rows, "office"),
    }
    for title, frame in plans.items():
        print(f"## {title}\n\n```")
        frame.explain("simple")
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
