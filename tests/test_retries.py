"""Tasks that fail and run again: rows and counts stay whole. Needs a session that retries tasks,
so it has a process of its own."""

import subprocess
import sys
from pathlib import Path

SCRIPT = '''
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from rowsieve.functions.people import PERSON_SCHEMA, people_from_ids
from rowsieve.operators.metrics import observe_rules
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import split
from rowsieve.sources.files import file_stream, read_files
from rowsieve.streaming.loads import PathSink, read_loads, read_side, split_store, split_stream

root = sys.argv[1]
spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
people_from_ids(spark.range(0, 4000, 1, 8)).write.json(root + "/in")

def fail_once(batches):
    # Hands over its rows first, so that a failed attempt has written and counted some.
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

blocks = [
    {"field": "office", "validations": ["notEmpty"]},
    {"field": "age", "validations": ["notNull", "isAdult"]},
]
stream = file_stream(spark, root + "/in", PERSON_SCHEMA).mapInPandas(fail_once, PERSON_SCHEMA)
rules = compile_rules(stream, blocks)
batch = read_files(spark, root + "/in", PERSON_SCHEMA)
expected = split(batch, compile_rules(batch, blocks))
ok, ko = expected.ok.count(), expected.ko.count()

report = split_store(stream, rules, PathSink(root + "/store"), root + "/c1")
assert (report.rows_ok, report.rows_ko) == (ok, ko), report
assert read_side(spark, root + "/store", "ok", PERSON_SCHEMA).count() == ok
assert read_side(spark, root + "/store", "ko", PERSON_SCHEMA).count() == ko

sinks = PathSink(root + "/ok", mode="overwrite"), PathSink(root + "/ko")
report = split_stream(stream, rules, *sinks, root + "/c2")
assert (report.rows_ok, report.rows_ko) == (ok, ko), report
assert read_loads(spark, root + "/ok", PERSON_SCHEMA).exceptAll(expected.ok).count() == 0
assert read_loads(spark, root + "/ok", PERSON_SCHEMA).count() == ok
print("whole")
'''


def test_repeated_tasks_change_nothing(tmp_path):
    root = Path(__file__).resolve().parent.parent
    result = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)],
        cwd=root,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert result.stdout.strip().endswith("whole"), result.stderr[-3000:]
