"""Registered queries that write, load or refresh something and read it back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve_checks.inputs import PERSON_RULES, PERSON_SCHEMA, off_schema_lines, people, table
from rowsieve.operators.aggregate import grouped_stats
from rowsieve.operators.governance import (
    PERSON_POLICIES,
    Mask,
    governed,
    publish_governed_view,
    publish_governed_views,
    use_namespace,
)
from rowsieve.operators.rules import compile_rules
from rowsieve.operators.split import TRACE_COLUMN
from rowsieve.plans.contract import load_contract, parse_contract
from rowsieve.plans.dataflow import run
from rowsieve.plans.generate import generate_people
from rowsieve.plans.layers import quality_layers, refresh
from rowsieve.scratch import new_dir
from rowsieve.sinks.tables import (
    append_path,
    append_table,
    overwrite_table,
    read_merged,
    set_clustering,
    write_clustered_table,
    write_json,
)
from rowsieve.sources.files import (
    file_stream,
    infer_schema,
    read_files,
    read_table,
    read_variant,
)
from rowsieve.sources.rescue import RESCUED, read_json_rescued
from rowsieve.streaming.loads import (
    PathSink,
    append_stream,
    drain,
    read_loads,
    read_side,
    register_loads,
    split_batch,
    split_store,
    split_stream,
    write_load,
)


def _database(spark: SparkSession) -> str:
    """A database of its own, with its tables in the shared folder."""
    name = f"checks_{uuid.uuid4().hex}"
    place = new_dir(spark, "database")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    return name


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """The people as JSON lines in a directory that arrives file by file."""
    path = f"{new_dir(spark, 'landing')}/person"
    write_json(people(spark, sf_dir), path, n_files=None, mode="error")
    return path


def _stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return file_stream(spark, _landing(spark, sf_dir), PERSON_SCHEMA, options=options)


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _stream(spark, sf_dir)
    rules = compile_rules(rows, PERSON_RULES)
    out = new_dir(spark, "loads")
    ok, ko = PathSink(f"{out}/ok", mode="overwrite"), PathSink(f"{out}/ko")
    split_stream(rows, rules, ok, ko, f"{out}/checkpoint")
    ko_schema = f"{PERSON_SCHEMA}, {TRACE_COLUMN} MAP<STRING,STRING>"
    return (
        read_loads(spark, ok.path, PERSON_SCHEMA),
        read_loads(spark, ko.path, ko_schema),
    )


def _with_errors(ko: DataFrame) -> DataFrame:
    errors = F.col(TRACE_COLUMN)
    return ko.withColumns(
        {"office_error": errors["office"], "age_error": errors["age"]}
    ).drop(TRACE_COLUMN)


def stream_split_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir)[0]


def stream_split_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_errors(_loaded(spark, sf_dir)[1])


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_stats(_loaded(spark, sf_dir)[0], "office", "age")


def _store(spark: SparkSession, sf_dir: str) -> str:
    rows = _stream(spark, sf_dir)
    path = new_dir(spark, "store")
    rules = compile_rules(rows, PERSON_RULES)
    split_store(rows, rules, PathSink(f"{path}/rows"), f"{path}/checkpoint")
    return f"{path}/rows"


def split_store_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_side(spark, _store(spark, sf_dir), "ok", PERSON_SCHEMA)


def split_store_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_errors(read_side(spark, _store(spark, sf_dir), "ko", PERSON_SCHEMA))


def split_store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store written from a batch frame, both sides counted."""
    rows = people(spark, sf_dir)
    path = new_dir(spark, "store")
    split_batch(rows, compile_rules(rows, PERSON_RULES), PathSink(path))
    sides = [
        read_side(spark, path, side, PERSON_SCHEMA)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("side", F.lit(side))
        for side in ("ok", "ko")
    ]
    return sides[0].unionByName(sides[1])


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch written twice, as after a failure: each row is there once."""
    rows = _stream(spark, sf_dir, maxFilesPerTrigger=1)
    out = new_dir(spark, "replay")
    sink = PathSink(f"{out}/rows", mode="overwrite")

    def twice(batch: DataFrame, query_id: str, batch_id: int) -> None:
        write_load(batch, sink, query_id, batch_id)
        write_load(batch, sink, query_id, batch_id)

    drain(rows, f"{out}/checkpoint", twice)
    return read_loads(spark, sink.path, PERSON_SCHEMA)


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals, three drains: new files are loaded once, the third finds nothing."""
    landing, out = f"{new_dir(spark, 'landing')}/person", new_dir(spark, "incremental")
    rows = people(spark, sf_dir)
    sink = PathSink(f"{out}/rows")
    for half in (0, 1, None):
        if half is not None:
            arrived = rows.filter(F.col("l_orderkey") % 2 == half)
            write_json(arrived, landing, n_files=None)
        stream = file_stream(spark, f"{landing}/*", PERSON_SCHEMA)
        drain(
            stream,
            f"{out}/checkpoint",
            lambda batch, query_id, batch_id: write_load(batch, sink, query_id, batch_id),
        )
    return read_loads(spark, sink.path, PERSON_SCHEMA)


def stream_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_database(spark)}.person"
    append_stream(_stream(spark, sf_dir), name, new_dir(spark, "checkpoint"))
    return read_table(spark, name)


def _rescued(spark: SparkSession, sf_dir: str, *, stream: bool) -> DataFrame:
    path = f"{new_dir(spark, 'lines')}/person"
    off_schema_lines(spark, sf_dir).write.text(path)
    rows = read_json_rescued(spark, path, PERSON_SCHEMA, stream=stream)
    schema = rows.schema
    if stream:
        out = new_dir(spark, "rescued")
        sink = PathSink(f"{out}/rows")
        drain(
            rows,
            f"{out}/checkpoint",
            lambda batch, query_id, batch_id: write_load(batch, sink, query_id, batch_id),
        )
        rows = read_loads(spark, sink.path, schema)
    rescued = F.col(RESCUED)
    return rows.select(
        *PERSON_NAMES,
        F.size(rescued).alias("n_rescued"),
        rescued["age"].alias("rescued_age"),
        rescued["extra"].alias("rescued_extra"),
        rescued["AGE"].alias("rescued_upper_age"),
        "_corrupt_record",
    ).withColumnRenamed("_corrupt_record", "corrupt_record")


PERSON_NAMES = ("l_orderkey", "l_linenumber", "name", "age", "office")


def stream_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rescued(spark, sf_dir, stream=True)


def batch_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rescued(spark, sf_dir, stream=False)


def strict_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines without rescue: what does not fit is NULL."""
    path = f"{new_dir(spark, 'lines')}/person"
    off_schema_lines(spark, sf_dir).write.text(path)
    return read_files(spark, path, PERSON_SCHEMA)


def inferred_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landing(spark, sf_dir)
    schema = infer_schema(spark, path)
    rows = file_stream(spark, path, schema)
    out = new_dir(spark, "inferred")
    sink = PathSink(f"{out}/rows")
    drain(
        rows,
        f"{out}/checkpoint",
        lambda batch, query_id, batch_id: write_load(batch, sink, query_id, batch_id),
    )
    return read_loads(spark, sink.path, schema).select(*PERSON_NAMES)


def variant_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records loaded without a schema, and typed when they are used."""
    rows = read_variant(spark, _landing(spark, sf_dir))
    types = {"l_orderkey": "bigint", "l_linenumber": "int", "name": "string", "age": "int"}
    types["office"] = "string"
    return rows.select(
        *[F.variant_get("record", f"$.{name}", dtype).alias(name) for name, dtype in types.items()]
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_dir(spark, 'json')}/customer"
    customers = table(spark, sf_dir, "customer")
    write_json(customers, path)
    return read_files(spark, path, customers.schema)


def table_overwrite_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwritten twice, then appended to: one copy, and one more."""
    name = f"{_database(spark)}.customer"
    customers = table(spark, sf_dir, "customer")
    overwrite_table(customers, name, comment="customers, it's a copy")
    overwrite_table(customers, name)
    append_table(customers, name)
    return read_table(spark, name)


def schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with and without a column side by side in a directory."""
    path = f"{new_dir(spark, 'merge')}/customer"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    append_path(customers, path)
    append_path(customers.withColumn("dt", F.lit("later")), path)
    return read_merged(spark, path)


def table_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table that gains a column, and then gets rows without it."""
    name = f"{_database(spark)}.customer"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    append_table(customers, name, merge_schema=True)
    append_table(customers.withColumn("dt", F.lit("later")), name, merge_schema=True)
    append_table(customers.select("c_name", "c_custkey"), name, merge_schema=True)
    return read_table(spark, name)


def namespaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written and read by its short name inside a namespace."""
    before = spark.catalog.currentDatabase()
    rows = table(spark, sf_dir, "supplier")
    try:
        use_namespace(spark, _database(spark), "spark_catalog")
        overwrite_table(rows, "supplier")
        return read_table(spark, "supplier")
    finally:
        use_namespace(spark, before)


def clustered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_database(spark)}.person"
    write_clustered_table(people(spark, sf_dir), name, "office")
    set_clustering(spark, name, "office")
    return read_table(spark, name)


def governed_table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load first, then governance: a catalog view over a written table."""
    database = _database(spark)
    overwrite_table(people(spark, sf_dir), f"{database}.person")
    return publish_governed_view(spark, f"{database}.person_shown", f"{database}.person")


def contract(root: str, landing: str) -> dict:
    """A contract in the shape of the production one, with its summary and audit spelled out."""
    return {
        "name": "person-quality",
        "sources": [{"name": "person_inputs", "path": f"{landing}/*", "format": "JSON"}],
        "transformations": [
            {
                "name": "validation",
                "type": "validate_fields",
                "params": {"input": "person_inputs", "validations": PERSON_RULES},
            }
        ],
        "sinks": [
            {
                "name": "person_ok",
                "paths": ["{root}/{env_catalog}/events/person"],
                "format": "PARQUET",
                "mode": "OVERWRITE",
            },
            {
                "name": "person_ko",
                "input": "validation_ko",
                "paths": ["{root}/{env_catalog}/discards/person"],
                "format": "PARQUET",
                "saveMode": "OVERWRITE",
            },
            {
                "name": "person_store",
                "input": "validation",
                "paths": ["{root}/{env_catalog}/store"],
                "format": "PARQUET",
            },
        ],
        "summaries": [
            {
                "name": "person_gold_office_stats",
                "input": "person_ok",
                "by": "office",
                "value": "age",
                "path": "{root}/{env_catalog}/gold",
            },
            {
                "name": "person_gold_from_parts",
                "input": "person_ok",
                "by": "office",
                "value": "age",
                "path": "{root}/{env_catalog}/gold_from_parts",
                "parts": "{root}/{env_catalog}/gold_parts",
            },
        ],
    }


def _run_contract(spark: SparkSession, sf_dir: str, execution: str = "stream") -> str:
    root = new_dir(spark, "flow")
    params = {"env_catalog": "dev", "root": root}
    flow = parse_contract(contract(root, _landing(spark, sf_dir)), params)
    run(
        flow,
        spark,
        params,
        execution=execution,
        checkpoint=f"{root}/checkpoint",
        schemas={"person_inputs": PERSON_SCHEMA},
        audit_path=f"{root}/audit",
    )
    return root


def contract_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_contract(spark, sf_dir)
    rows = read_loads(spark, f"{root}/dev/events/person", f"{PERSON_SCHEMA}, dt STRING")
    return rows.drop("dt")


def contract_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_contract(spark, sf_dir)
    schema = f"{PERSON_SCHEMA}, dt STRING, {TRACE_COLUMN} MAP<STRING,STRING>"
    return _with_errors(read_loads(spark, f"{root}/dev/discards/person", schema)).drop("dt")


def contract_store_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_run_contract(spark, sf_dir)}/dev/store"
    return _with_errors(read_side(spark, path, "ko", f"{PERSON_SCHEMA}, dt STRING")).drop("dt")


def contract_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_run_contract(spark, sf_dir)}/dev/gold")


def contract_gold_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_run_contract(spark, sf_dir)}/dev/gold_from_parts")


def contract_batch_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_contract(spark, sf_dir, execution="batch")
    return _with_errors(spark.read.parquet(f"{root}/dev/discards/person")).drop("dt")


def audit_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = spark.read.parquet(f"{_run_contract(spark, sf_dir)}/audit")
    return audit.select("pipeline_name", "environment", "rows_ok", "rows_ko", "status")


def _layers(spark: SparkSession, sf_dir: str) -> str:
    database, landing = _database(spark), _landing(spark, sf_dir)
    layers = quality_layers(
        "person",
        lambda: file_stream(spark, landing, PERSON_SCHEMA),
        PERSON_RULES,
        by="office",
        value="age",
    )
    refresh(spark, layers, namespace=database, checkpoint=new_dir(spark, "checkpoint"))
    return database


def layered_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_layers(spark, sf_dir)}.person_standard_ok").drop("dt")


def layered_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    ko = spark.table(f"{_layers(spark, sf_dir)}.person_standard_ko")
    return ko.select(
        "l_orderkey", "l_linenumber", F.concat_ws(",", TRACE_COLUMN).alias("codes")
    )


def _layers_twice(spark: SparkSession, sf_dir: str) -> str:
    """Two arrivals and two refreshes; the second one brings a column that the first did not have."""
    database, landing, checkpoint = _database(spark), new_dir(spark, "landing"), new_dir(spark, "checkpoint")
    for rows, schema in zip(_halves(spark, sf_dir), (PERSON_SCHEMA, TEAM_SCHEMA)):
        write_json(rows, landing)
        layers = quality_layers(
            "person", lambda schema=schema: file_stream(spark, landing, schema), PERSON_RULES, by="office", value="age"
        )
        refresh(spark, layers, namespace=database, checkpoint=checkpoint)
    return database


def layered_two_refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_layers_twice(spark, sf_dir)}.person_gold_office_stats")


def layered_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_layers_twice(spark, sf_dir)}.person_standard_ok").drop("dt")


def layered_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of raw again at each refresh."""
    database, landing = _database(spark), _landing(spark, sf_dir)
    layers = quality_layers(
        "person", lambda: file_stream(spark, landing, PERSON_SCHEMA), PERSON_RULES, by="office", value="age", full=True
    )
    for _ in range(2):
        refresh(spark, layers, namespace=database, checkpoint=f"{landing}-checkpoint")
    return spark.table(f"{database}.person_gold_office_stats")


def layered_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_layers(spark, sf_dir)}.person_gold_office_stats")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The people in two arrivals; the second one has a column more."""
    rows = people(spark, sf_dir)
    return rows.where("l_linenumber <= 3"), rows.where("l_linenumber > 3").withColumn("team", F.lit("late"))


TEAM_SCHEMA = f"{PERSON_SCHEMA}, team STRING"


def stream_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that arrives in the second run reaches the table."""
    name, landing, checkpoint = f"{_database(spark)}.person", new_dir(spark, "landing"), new_dir(spark, "checkpoint")
    for rows, schema in zip(_halves(spark, sf_dir), (PERSON_SCHEMA, TEAM_SCHEMA)):
        write_json(rows, landing)
        append_stream(file_stream(spark, landing, schema), name, checkpoint)
    return read_table(spark, name)


def registered_table_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered directory of loads gains a column with its second load."""
    name, out = f"{_database(spark)}.person", new_dir(spark, "registered")
    sink = PathSink(f"{out}/rows")
    for number, rows in enumerate(_halves(spark, sf_dir)):
        load = write_load(rows, sink, "query", number)
        register_loads(spark, name, sink.path, rows.schema, loads=[load])
    return read_table(spark, name).drop("load_id")


def append_case_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another case are the same columns, narrower ones widen, and what would lose values is refused."""
    name = f"{_database(spark)}.person"
    first, second = _halves(spark, sf_dir)
    append_table(first, name, merge_schema=True)
    second = second.drop("team")
    append_table(second.withColumnRenamed("name", "NAME").withColumn("AGE", F.col("age").cast("smallint")), name, merge_schema=True)
    try:
        append_table(second.withColumn("age", F.col("age").cast("bigint")), name, merge_schema=True)
    except ValueError:
        return read_table(spark, name)
    raise AssertionError("a narrowing append must be refused")


def _flow(spark: SparkSession, root: str, landing: str, *, rules, schemas=None, parts: str | None = None, ko: bool = True, mode="OVERWRITE"):
    """Run a small flow over a landing directory, once more with each call."""
    sinks = [{"name": "flow_ok", "paths": [f"{root}/ok"], "format": "PARQUET", "mode": mode}]
    if ko:
        sinks.append({"name": "flow_ko", "paths": [f"{root}/ko"], "format": "PARQUET", "mode": mode})
    steps = [] if rules is None else [{"name": "checks", "type": "validate_fields", "params": {"validations": rules}}]
    spec = {"name": "flow", "sources": [{"name": "rows", "path": landing}], "transformations": steps, "sinks": sinks}
    spec["summaries"] = [{"name": "gold", "input": "flow_ok", "by": "office", "value": "age", "path": f"{root}/gold"}]
    if parts:
        spec["summaries"][0]["parts"] = parts
    if rules is None:
        del spec["summaries"]
    return run(parse_contract(spec), spark, checkpoint=f"{root}/checkpoint", schemas=schemas or {}, processing_time=None)


def overwrite_no_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new checkpoint without input leaves nothing in a sink to overwrite."""
    root, landing = new_dir(spark, "flow"), new_dir(spark, "landing")
    write_json(people(spark, sf_dir).limit(0), landing)
    people(spark, sf_dir).write.parquet(f"{root}/ok")
    _flow(spark, root, landing, rules=PERSON_RULES, schemas={"rows": PERSON_SCHEMA})
    rows = spark.read.schema(PERSON_SCHEMA).parquet(f"{root}/ok")
    return rows.agg(F.count(F.lit(1)).alias("rows"))


def inferred_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of the first run holds for the second; what differs then is rescued."""
    root, landing = new_dir(spark, "flow"), new_dir(spark, "landing")
    first, second = _halves(spark, sf_dir)
    write_json(first, landing)
    _flow(spark, root, landing, rules=[{"field": "office", "validations": ["notNull"]}], mode="APPEND")
    write_json(second.withColumn("age", F.col("age") + 0.5), landing)
    _flow(spark, root, landing, rules=[{"field": "office", "validations": ["notNull"]}], mode="APPEND")
    schema = "l_orderkey BIGINT, l_linenumber BIGINT, name STRING, age BIGINT, office STRING, _rescued_data MAP<STRING,STRING>"
    rows = read_loads(spark, f"{root}/ok", schema)
    rescued = F.col("_rescued_data")
    return rows.select("l_orderkey", "l_linenumber", "age", rescued["age"].alias("rescued_age"), rescued["team"].alias("rescued_team"))


def gold_parts_added_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts switched on in the second run cover the loads of the first."""
    root, landing = new_dir(spark, "flow"), new_dir(spark, "landing")
    schemas = {"rows": PERSON_SCHEMA}
    first, second = _halves(spark, sf_dir)
    write_json(first, landing)
    _flow(spark, root, landing, rules=PERSON_RULES, schemas=schemas, mode="APPEND")
    write_json(second.drop("team"), landing)
    _flow(spark, root, landing, rules=PERSON_RULES, schemas=schemas, mode="APPEND", parts=f"{root}/parts")
    return spark.read.parquet(f"{root}/gold")


def no_rule_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a validate step the valid side is the input and the rejected one is empty, with its trace."""
    root = new_dir(spark, "flow")
    _flow(spark, root, _landing(spark, sf_dir), rules=None, schemas={"rows": PERSON_SCHEMA})
    trace = f"{PERSON_SCHEMA}, {TRACE_COLUMN} MAP<STRING,STRING>"
    sides = {"ok": read_loads(spark, f"{root}/ok", PERSON_SCHEMA), "ko": read_loads(spark, f"{root}/ko", trace)}
    counts = [rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("side", F.lit(side)) for side, rows in sides.items()]
    return counts[0].unionByName(counts[1])


def contract_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract comes from a file in the shared folder, its placeholders from the parameters."""
    root, landing = new_dir(spark, "flow"), _landing(spark, sf_dir)
    place = f"{root}/contract"
    text = json.dumps(contract("{root}", landing))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(place)
    params = {"env_catalog": "dev", "root": root}
    flow = load_contract(place, params, spark=spark)
    run(flow, spark, params, checkpoint=f"{root}/checkpoint", schemas={"person_inputs": PERSON_SCHEMA})
    return spark.read.parquet(f"{root}/dev/gold")


def run_then_governed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, then one set of policies on its valid and rejected tables."""
    root, database = new_dir(spark, "flow"), _database(spark)
    spec = contract(root, _landing(spark, sf_dir))
    spec["sinks"] = spec["sinks"][:2]
    for sink, side in zip(spec["sinks"], ("ok", "ko")):
        sink["table"] = f"{database}.person_{side}"
    params = {"env_catalog": "dev", "root": root}
    run(parse_contract(spec, params), spark, params, checkpoint=f"{root}/checkpoint", schemas={"person_inputs": PERSON_SCHEMA})
    shown = publish_governed_views(spark, {f"{database}.shown_{side}": f"{database}.person_{side}" for side in ("ok", "ko")})
    parts = [
        rows.select("l_orderkey", "l_linenumber", "name", "office", F.lit(view.rpartition("_")[2]).alias("side"))
        for view, rows in shown.items()
    ]
    return parts[0].unionByName(parts[1])


def masked_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outsider sees neither a masked name nor what was rescued beside it; every mask of a column holds."""
    path = f"{new_dir(spark, 'lines')}/person"
    off_schema_lines(spark, sf_dir).write.text(path)
    rows = read_json_rescued(spark, path, PERSON_SCHEMA).where("name is not null")
    shown = governed(rows, [*PERSON_POLICIES, Mask("name", "HR_ONLY", "hr")], ["admin"])
    return shown.select("l_orderkey", "l_linenumber", "name", F.col(RESCUED).isNull().alias("hidden"))


def rescue_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested keys and nested values of another type are rescued; a line of two documents is kept as text."""
    path = f"{new_dir(spark, 'lines')}/orders"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    document = F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"), F.lit(',"to":{"city":"c'), F.col("o_custkey").cast("string"))
    kind = F.pmod("o_orderkey", F.lit(4))
    end = F.when(kind == 0, '","zip":9}}').when(kind == 1, '", "zip": 9, "street":"x"}}').when(kind == 2, '","zip":"nine"}}')
    rows.select(F.concat(document, end.otherwise('","zip":9}} {"id":1}')).alias("value")).write.text(path)
    found = read_json_rescued(spark, path, "id BIGINT, to STRUCT<city: STRING, zip: INT>")
    return found.select(
        "id", F.col("to.city").alias("city"), F.col("to.zip").alias("zip"), F.col(RESCUED)["to"].alias("rescued_to"),
        F.col("_corrupt_record").alias("corrupt_record"),
    )


def rescue_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of the JSON parser hold for rescued lines as for strict ones."""
    path = f"{new_dir(spark, 'lines')}/orders"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))
    rows.write.json(path)
    found = read_json_rescued(spark, path, "o_orderkey BIGINT, day DATE", options={"dateFormat": "dd/MM/yyyy"})
    return found.select("o_orderkey", F.col("day").cast("string").alias("day"), F.size(RESCUED).alias("n_rescued"))


def generated_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many seeded random people as there are orders, landed by the job: rows and ranges."""
    path = f"{new_dir(spark, 'people')}/person"
    orders = table(spark, sf_dir, "orders").count()
    generate_people(spark, path, orders, seed=7)
    rows = read_files(spark, path, "name STRING, age INT, office STRING")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("name").alias("names"),
        F.bool_and(F.coalesce(F.col("age").between(10, 84), F.lit(True))).alias("ages_in_range"),
        F.bool_and(F.coalesce(F.col("office").isin("MADRID", "RIO", ""), F.lit(False))).alias("known_offices"),
    )


QUERIES = {
    "stream_schema_merge": stream_schema_merge,
    "registered_table_widened": registered_table_widened,
    "append_case_and_type": append_case_and_type,
    "overwrite_no_input": overwrite_no_input,
    "inferred_two_runs": inferred_two_runs,
    "gold_parts_added_later": gold_parts_added_later,
    "no_rule_contract": no_rule_contract,
    "contract_from_file": contract_from_file,
    "run_then_governed": run_then_governed,
    "masked_rescue": masked_rescue,
    "rescue_nested": rescue_nested,
    "rescue_options": rescue_options,
    "layered_two_refreshes": layered_two_refreshes,
    "layered_widened": layered_widened,
    "layered_full": layered_full,
    "generated_people": generated_people,
    "stream_split_ok": stream_split_ok,
    "stream_split_ko": stream_split_ko,
    "stream_gold": stream_gold,
    "split_store_ok": split_store_ok,
    "split_store_ko": split_store_ko,
    "split_store_counts": split_store_counts,
    "stream_replay": stream_replay,
    "stream_incremental": stream_incremental,
    "stream_append_table": stream_append_table,
    "stream_rescue": stream_rescue,
    "batch_rescue": batch_rescue,
    "strict_schema": strict_schema,
    "inferred_ingest": inferred_ingest,
    "variant_ingest": variant_ingest,
    "json_roundtrip": json_roundtrip,
    "table_overwrite_append": table_overwrite_append,
    "schema_merge": schema_merge,
    "table_schema_merge": table_schema_merge,
    "namespaced_table": namespaced_table,
    "clustered_table": clustered_table,
    "governed_table_view": governed_table_view,
    "contract_ok": contract_ok,
    "contract_ko": contract_ko,
    "contract_store_ko": contract_store_ko,
    "contract_gold": contract_gold,
    "contract_gold_from_parts": contract_gold_from_parts,
    "contract_batch_ko": contract_batch_ko,
    "audit_row": audit_row,
    "layered_ok": layered_ok,
    "layered_ko": layered_ko,
    "layered_gold": layered_gold,
}
