"""Time the alternatives behind the design on generated people: measure.py [rows] [cpus].

Prints a Markdown table; best of three runs after a warm-up, no-op sink unless a load is timed.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bench import session  # noqa: E402
from rowsieve.functions.people import PERSON_SCHEMA  # noqa: E402
from rowsieve.operators.aggregate import grouped_stats  # noqa: E402
from rowsieve.operators.rules import compile_rules  # noqa: E402
from rowsieve.operators.split import (  # noqa: E402
    TRACE_COLUMN,
    annotate,
    rejected_rows,
    valid_rows,
)
from rowsieve.plans.compare import compare_cleaning  # noqa: E402
from rowsieve.plans.contract import parse_contract  # noqa: E402
from rowsieve.plans.dataflow import run  # noqa: E402
from rowsieve.plans.generate import generate_people  # noqa: E402
from rowsieve.scratch import new_dir  # noqa: E402
from rowsieve.sinks.tables import write_noop  # noqa: E402
from rowsieve.sources.files import file_stream, read_files  # noqa: E402
from rowsieve.sources.rescue import read_json_rescued  # noqa: E402
from rowsieve_checks.inputs import PERSON_RULES as RULES  # noqa: E402
from rowsieve.streaming.loads import (  # noqa: E402
    PathSink,
    drain,
    split_store,
    split_stream,
    write_load,
)

def best(action, runs: int = 3) -> float:
    timings = []
    for _ in range(runs + 1):
        started = time.monotonic()
        action()
        timings.append(time.monotonic() - started)
    return min(timings[1:])


def main() -> None:
    n_rows = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    spark = session(sys.argv[2] if len(sys.argv) > 2 else "8")
    root = new_dir(spark, "measure")
    landing, stored = f"{root}/in", f"{root}/parquet"
    generate_people(spark, landing, n_rows, seed=1)
    json_rows = read_files(spark, landing, PERSON_SCHEMA)
    json_rows.write.parquet(stored)
    rows = spark.read.parquet(stored)
    rules = compile_rules(rows, RULES)

    def show(what: str, action) -> None:
        print(f"| {what} | {n_rows:,} | {best(action):.2f} |", flush=True)

    print("| What | Rows | Seconds |\n|---|---|---|")
    for name, took in [(r["variant"], r["seconds"]) for r in compare_cleaning(json_rows).collect()]:
        print(f"| cleaning from JSON: {name} | {n_rows:,} | {took:.2f} |", flush=True)
    for name, took in [(r["variant"], r["seconds"]) for r in compare_cleaning(rows).collect()]:
        print(f"| cleaning from parquet: {name} | {n_rows:,} | {took:.2f} |", flush=True)

    marked = annotate(rows, rules)
    clean = F.size(TRACE_COLUMN) == 0
    show("valid side, verdict pushed down", lambda: write_noop(valid_rows(rows, rules)))
    show("valid side, trace first", lambda: write_noop(marked.filter(clean).drop(TRACE_COLUMN)))
    for kind in ("map", "array", "full"):
        rejects = rejected_rows(rows, rules, kind=kind)
        show(f"rejected side, {kind} trace", lambda rejects=rejects: write_noop(rejects))
    show("rejected side, trace first", lambda: write_noop(marked.filter(~clean)))
    show("gold from all rows", lambda: write_noop(grouped_stats(valid_rows(rows, rules))))
    show("strict JSON scan", lambda: write_noop(json_rows))
    show(
        "rescued JSON scan", lambda: write_noop(read_json_rescued(spark, landing, PERSON_SCHEMA))
    )

    stream = file_stream(spark, landing, PERSON_SCHEMA)

    def one_store() -> None:
        out = new_dir(spark, "store")
        split_store(stream, rules, PathSink(f"{out}/rows"), f"{out}/checkpoint")

    def two_sinks() -> None:
        out = new_dir(spark, "sinks")
        split_stream(
            stream, rules, PathSink(f"{out}/ok"), PathSink(f"{out}/ko"), f"{out}/checkpoint"
        )

    def two_streams() -> None:
        out = new_dir(spark, "streams")
        marked = annotate(stream, rules)
        for side, frame in (("ok", marked.filter(clean)), ("ko", marked.filter(~clean))):
            sink = PathSink(f"{out}/{side}")
            drain(
                frame,
                f"{out}/checkpoint-{side}",
                lambda batch, q, i, sink=sink: write_load(batch, sink, q, i),
            )

    show("load: one pass into a store", one_store)
    show("load: one stream, two sinks", two_sinks)
    show("load: two streams, trace first", two_streams)

    def contract(sinks: list) -> None:
        out = new_dir(spark, "flow")
        flow = parse_contract(
            {
                "name": "people",
                "sources": [{"name": "person_inputs", "path": landing}],
                "transformations": [
                    {"name": "v", "type": "validate_fields", "params": {"validations": RULES}}
                ],
                "sinks": sinks,
                "summaries": [
                    {
                        "name": "gold",
                        "input": sinks[0]["name"],
                        "by": "office",
                        "value": "age",
                        "path": "{out}/gold",
                    }
                ],
            },
            {"out": out},
        )
        schemas = {"person_inputs": PERSON_SCHEMA}
        run(flow, spark, checkpoint=f"{out}/c", schemas=schemas, audit_path=f"{out}/audit")

    sides = [{"name": f"p_{side}", "paths": [f"{{out}}/{side}"]} for side in ("ok", "ko")]
    show("contract run, two sinks, gold, audit", lambda: contract(sides))
    store = [{"name": "store", "input": "v", "paths": ["{out}/store"]}]
    show("contract run, store, gold, audit", lambda: contract(store))
    spark.stop()


if __name__ == "__main__":
    main()
