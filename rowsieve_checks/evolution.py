"""Registered queries about what changes between runs: columns, types, rules, repeats, bindings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.operators.governance import Mask, base_of, bind_all, bind_policies
from rowsieve.operators.rules import compile_rules, register_rule
from rowsieve.operators.split import TRACE_COLUMN, annotate
from rowsieve.plans.contract import parse_contract
from rowsieve.plans.dataflow import run
from rowsieve.plans.layers import Layer, quality_layers, refresh
from rowsieve.plans.ledger import Ledger
from rowsieve.scratch import new_dir
from rowsieve.sinks.layout import lay_out_loads
from rowsieve.sinks.tables import append_table, overwrite_table, write_json
from rowsieve.sources.files import file_stream, move, write_text
from rowsieve.sources.rescue import read_json_rescued
from rowsieve.streaming.loads import PathSink, drain, read_loads, register_loads, write_load
from rowsieve_checks.inputs import PERSON_RULES, PERSON_SCHEMA, off_schema_lines, people, table
from rowsieve_checks.loads import _database


def _landed(spark: SparkSession, sf_dir: str, fmt: str, options: dict) -> tuple[DataFrame, DataFrame]:
    """Two runs over a directory whose later files have a column more, one less, in another order."""
    root, landing = new_dir(spark, "evolving"), new_dir(spark, "landing")
    rows = people(spark, sf_dir)
    first = rows.where("l_linenumber <= 3")
    second = rows.where("l_linenumber > 3").select("office", F.lit("late").alias("team"), "age", "l_linenumber", "l_orderkey")
    spec = {
        "name": "evolving",
        "sources": [{"name": "rows", "path": landing, "format": fmt, "options": options}],
        "transformations": [
            {"name": "checks", "type": "validate_fields", "params": {"validations": [{"field": "age", "validations": ["notNull"]}]}}
        ],
        "sinks": [{"name": f"checks_{side}", "paths": [f"{root}/{side}"], "format": "PARQUET"} for side in ("ok", "ko")],
    }
    for sink, side in zip(spec["sinks"], ("ok", "ko")):
        sink["input"] = f"checks_{side}"
        sink["table"] = f"{_database(spark)}.rows_{side}"
    for part in (first, second):
        writer = part.write.format(fmt).mode("append")
        writer.options(**options).save(landing)
        run(parse_contract(spec), spark, checkpoint=f"{root}/checkpoint", processing_time=None)
    return tuple(spark.table(sink["table"]) for sink in spec["sinks"])


def _both_sides(sides: tuple[DataFrame, DataFrame]) -> DataFrame:
    names = ["l_orderkey", "l_linenumber", "name", "age", "office", "team"]
    parts = [rows.select(*names, F.lit(side).alias("side")) for rows, side in zip(sides, ("ok", "ko"))]
    return parts[0].unionByName(parts[1])


def schema_evolves_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later CSV file has its columns in another order, one of them new: the values are under their names."""
    sides = _landed(spark, sf_dir, "csv", {"header": "true", "inferSchema": "true"})
    types = {"l_orderkey": "bigint", "l_linenumber": "int", "age": "int"}
    # CSV has no difference between an empty text and none, and inference finds the narrowest number.
    found = _both_sides(sides).withColumns({name: F.col(name).cast(dtype) for name, dtype in types.items()})
    return found.withColumn("office", F.coalesce("office", F.lit("")))


def schema_evolves_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only later Parquet files have reaches both sides."""
    return _both_sides(_landed(spark, sf_dir, "parquet", {}))


def nested_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields inside structs, arrays of structs and maps are added by later appends, whatever their order."""
    name = f"{_database(spark)}.customer"
    rows = table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    first = rows.where("c_custkey % 2 = 0").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.struct(nation.alias("nation")).alias("home")).alias("who"),
        F.array(F.struct(key.alias("a"))).alias("tags"),
        F.create_map(F.lit("k"), F.struct(nation.alias("v"))).alias("facts"),
    )
    second = rows.where("c_custkey % 2 = 1").select(
        F.array(F.struct(F.col("c_mktsegment").alias("b"), key.alias("a"))).alias("tags"),
        F.struct(F.struct(F.col("c_mktsegment").alias("segment"), nation.alias("NATION")).alias("home"), F.col("c_acctbal").alias("balance")).alias("who"),
        F.create_map(F.lit("k"), F.struct(F.lit("w").alias("w"))).alias("facts"),
        "c_custkey",
    )
    append_table(first, name, merge_schema=True)
    append_table(second, name, merge_schema=True)
    found = spark.table(name)
    return found.select(
        "c_custkey", "who.name", "who.home.nation", "who.home.segment", "who.balance",
        F.col("tags")[0]["a"].alias("tag_a"), F.col("tags")[0]["b"].alias("tag_b"),
        F.col("facts")["k"]["v"].alias("fact_v"), F.col("facts")["k"]["w"].alias("fact_w"),
    )


def widened_type_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wider numbers in a later append widen the table's columns, also inside a struct; no value is lost."""
    name = f"{_database(spark)}.lineitem"
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    number = F.col("l_linenumber")
    first = rows.where("l_linenumber <= 3").select(
        "l_orderkey", number.cast("int").alias("n"), F.struct(number.cast("smallint").alias("n")).alias("s"), number.cast("float").alias("x")
    )
    large = number + F.lit(5_000_000_000)
    second = rows.where("l_linenumber > 3").select(
        "l_orderkey", large.cast("bigint").alias("n"), F.struct(large.cast("bigint").alias("n")).alias("s"), (number / 3).cast("double").alias("x")
    )
    for part in (first, second):
        append_table(part, name, merge_schema=True, widen=True)
    return spark.table(name).select("l_orderkey", "n", F.col("s.n").alias("nested_n"), "x")


def _judged(spark: SparkSession, rows: DataFrame, validations: list[dict]) -> DataFrame:
    rules = compile_rules(rows, validations)
    judged = annotate(rows, rules, kind="array")
    return judged.select("l_orderkey", "l_linenumber", F.concat_ws(",", TRACE_COLUMN).alias("codes"))


_NUMBERS = """SELECT l_orderkey, l_linenumber,
    CAST(CASE WHEN l_linenumber = 1 THEN 2147483647 WHEN l_linenumber = 5 THEN NULL ELSE l_orderkey END AS INT) AS a,
    CAST(CASE WHEN l_linenumber <= 2 THEN 2147483647 - l_linenumber ELSE l_linenumber - 4 END AS INT) AS b"""


def rule_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, products and divisions that have no result break a rule; the other side of an OR keeps its say."""
    rows = spark.sql(f"{_NUMBERS} FROM {{rows}}", rows=table(spark, sf_dir, "lineitem"))
    expressions = {
        "sum": "a + b < 5000", "sum_or": "a + b < 5000 OR l_linenumber = 1", "product": "a * b * b > -3", "quotient": "1000 div b < 600 AND 10 % b = 0",
    }
    checks = [{"error_code": code, "expression": text} for code, text in expressions.items()]
    return _judged(spark, rows, [{"field": "a", "sql_expressions": checks}])


_PATTERNS = """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 6 THEN NULL ELSE concat('User_', l_linenumber) END AS t,
    CASE l_linenumber WHEN 1 THEN '(' WHEN 2 THEN 'User_[2-9]' WHEN 3 THEN '[0-9' WHEN 4 THEN '_5' ELSE 'r_' END AS p,
    CASE l_linenumber WHEN 1 THEN concat('User', chr(92)) WHEN 2 THEN concat('User', chr(92), '__') WHEN 3 THEN 'User%' WHEN 4 THEN 'U_x' ELSE '%' END AS q"""


def rule_bad_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose pattern is none break the rule, and the run goes on."""
    rows = spark.sql(f"{_PATTERNS} FROM {{rows}}", rows=table(spark, sf_dir, "lineitem"))
    checks = [{"error_code": "rlike", "expression": "t RLIKE p"}, {"error_code": "like", "expression": "t LIKE q"}]
    return _judged(spark, rows, [{"field": "t", "sql_expressions": checks}])


_AMOUNTS = """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 1 THEN 'many' WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN '99999999999'
        ELSE CAST(l_linenumber - 5 AS STRING) END AS amount"""


def custom_rule_raises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered rule whose cast has no result for a row rejects the row."""
    register_rule("positiveAmount", lambda column: column.cast("int") > 0)
    rows = spark.sql(f"{_AMOUNTS} FROM {{rows}}", rows=table(spark, sf_dir, "lineitem"))
    return _judged(spark, rows, [{"field": "amount", "validations": ["positiveAmount"]}])


def _interrupted(spark: SparkSession, sf_dir: str, *, repeat: bool) -> str:
    """Two arrivals; of the second batch the valid side is written, the rejected one fails. Perhaps it is repeated."""
    root, landing = new_dir(spark, "interrupted"), new_dir(spark, "landing")
    spec = {
        "name": "interrupted",
        "sources": [{"name": "rows", "path": landing}],
        "transformations": [{"name": "checks", "type": "validate_fields", "params": {"validations": PERSON_RULES}}],
        "sinks": [
            {"name": "ok", "input": "checks_ok", "paths": [f"{root}/ok"], "format": "PARQUET"},
            {"name": "ko", "input": "checks_ko", "paths": [f"{root}/ko", f"{root}/more/ko"], "format": "PARQUET"},
        ],
    }
    settings = {"checkpoint": f"{root}/checkpoint", "schemas": {"rows": PERSON_SCHEMA}, "audit_path": f"{root}/audit"}
    flow, rows = parse_contract(spec), people(spark, sf_dir)
    write_json(rows.where("l_linenumber <= 3"), landing)
    run(flow, spark, processing_time=None, **settings)
    move(spark, f"{root}/more", f"{root}/aside")
    write_text(spark, f"{root}/more", "no directory")
    write_json(rows.where("l_linenumber > 3"), landing)
    try:
        run(flow, spark, processing_time=None, **settings)
    except Exception:  # noqa: BLE001  whatever a file system says to a file in place of a directory
        pass
    else:
        raise AssertionError("the second batch cannot be written")
    if repeat:
        move(spark, f"{root}/aside", f"{root}/more")
        run(flow, spark, processing_time=None, **settings)
    return root


def _sides(spark: SparkSession, root: str, *places: str) -> DataFrame:
    trace = f"{PERSON_SCHEMA}, {TRACE_COLUMN} MAP<STRING,STRING>"
    parts = [
        read_loads(spark, f"{root}/{place}", trace if place.endswith("ko") else PERSON_SCHEMA)
        .select("l_orderkey", "l_linenumber")
        .withColumn("place", F.lit(place))
        for place in places
    ]
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def half_written_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a batch that is written on one side only, neither side shows."""
    return _sides(spark, _interrupted(spark, sf_dir, repeat=False), "ok", "ko")


def audit_after_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a failed run and its repeat the audit's sums are what the sinks hold, and each load is in the ledger once."""
    root = _interrupted(spark, sf_dir, repeat=True)
    audit = spark.read.parquet(f"{root}/audit")
    sums = audit.agg(F.sum("rows_ok").alias("rows_ok"), F.sum("rows_ko").alias("rows_ko"), F.count_if(F.col("status") == "failed").alias("failed"))
    held = [_sides(spark, root, place).agg(F.count(F.lit(1)).alias(f"in_{place}")) for place in ("ok", "ko")]
    settled = Ledger(spark, f"{root}/checkpoint").settled()
    return sums.join(held[0]).join(held[1]).withColumn("loads", F.lit(len(settled)).cast("bigint"))


def bound_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables show what an outsider may see under their own names, also after loads that bring rows and a column."""
    database, rows = _database(spark), people(spark, sf_dir)
    tables = {side: f"{database}.person_{side}" for side in ("early", "late")}
    overwrite_table(rows.where("l_linenumber <= 2"), tables["early"])
    append_table(rows.where("l_linenumber = 3"), tables["late"])
    bind_all(spark, tables.values())
    append_table(rows.where("l_linenumber > 3").withColumn("team", F.lit("late")), tables["late"], merge_schema=True)
    overwrite_table(rows.where("l_linenumber <= 2").withColumn("team", F.lit("new")), tables["early"])
    parts = [spark.table(name).select("l_orderkey", "l_linenumber", "name", "office", "team", F.lit(side).alias("side")) for side, name in tables.items()]
    return parts[0].unionByName(parts[1])


def renamed_rescue_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rescued text under other names, written, registered and governed: an outsider sees none of it."""
    database, out, path = _database(spark), new_dir(spark, "rescued"), f"{new_dir(spark, 'lines')}/person"
    off_schema_lines(spark, sf_dir).write.text(path)
    rows = read_json_rescued(spark, path, PERSON_SCHEMA, rescued="leftover", corrupt="broken").withColumnRenamed("broken", "unreadable")
    sink, name = PathSink(f"{out}/rows"), f"{database}.person"
    register_loads(spark, name, sink.path, rows.schema, loads=[write_load(rows, sink, "query", 0)])
    shown = bind_policies(spark, name, [Mask("name")])
    inside = spark.table(base_of(spark, name)).select(F.count("leftover").alias("n_leftover"), F.count("unreadable").alias("n_unreadable"))
    seen = shown.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.count("leftover").alias("seen_leftover"), F.count("unreadable").alias("seen_unreadable"))
    return seen.join(inside)


def _layers_under_two_rules(spark: SparkSession, sf_dir: str) -> str:
    """The first arrival is judged by laxer rules; a refresh by the production rules brings the second."""
    database, landing, checkpoint = _database(spark), new_dir(spark, "landing"), new_dir(spark, "checkpoint")
    rows = people(spark, sf_dir)
    lax = [{"field": "age", "validations": ["notNull"], "sql_expressions": [{"error_code": "young", "expression": "age > 12"}]}]
    for part, rules in ((rows.where("l_linenumber <= 3"), lax), (rows.where("l_linenumber > 3"), PERSON_RULES)):
        write_json(part, landing)
        layers = quality_layers("person", lambda: file_stream(spark, landing, PERSON_SCHEMA), rules, by="office", value="age")
        refresh(spark, layers, namespace=database, checkpoint=checkpoint)
    return database


def layers_after_rule_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a change of the rules all rows have the verdict of the new ones."""
    database = _layers_under_two_rules(spark, sf_dir)
    ok, ko = (spark.table(f"{database}.person_standard_{side}") for side in ("ok", "ko"))
    keys = ["l_orderkey", "l_linenumber"]
    return ok.select(*keys, F.lit("").alias("codes")).unionByName(ko.select(*keys, F.concat_ws(",", TRACE_COLUMN).alias("codes")))


def gold_after_rule_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary is that of the rows that the new rules accept."""
    return spark.table(f"{_layers_under_two_rules(spark, sf_dir)}.person_gold_office_stats")


def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming layer drops rows that break an expectation; its counts, over several batches and two refreshes."""
    database, landing, checkpoint = _database(spark), new_dir(spark, "landing"), new_dir(spark, "checkpoint")
    rows, counts = people(spark, sf_dir), []
    for half in (0, 1):
        write_json(rows.where(F.col("l_orderkey") % 2 == half).repartition(3), landing)
        layer = Layer(
            "person_ok",
            lambda: file_stream(spark, landing, PERSON_SCHEMA, options={"maxFilesPerTrigger": 2}),
            stream=True,
            expectations=lambda frame: compile_rules(frame, PERSON_RULES, code_style="qualified"),
        )
        (report,) = refresh(spark, [layer], namespace=database, checkpoint=checkpoint)
        counts += [(half, field, rule, failed, report.rows, report.dropped) for (field, rule), failed in report.failures.items()]
    shape = "half BIGINT, field STRING, rule STRING, failed BIGINT, rows BIGINT, dropped BIGINT"
    kept = spark.table(f"{database}.person_ok").groupBy((F.col("l_orderkey") % 2).alias("half")).agg(F.count(F.lit(1)).alias("kept"))
    return spark.createDataFrame(counts, shape).join(kept, "half")


def clustered_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads laid out by two columns after they were written: the rows of each, and whether its files cover small ranges of both."""
    out, landing = new_dir(spark, "laid-out"), new_dir(spark, "landing")
    sink, checkpoint, rows = PathSink(f"{out}/rows"), f"{out}/checkpoint", people(spark, sf_dir)
    for part in range(3):
        write_json(rows.where(F.col("l_orderkey") % 3 == part).repartition(4), landing)
        stream = file_stream(spark, landing, PERSON_SCHEMA)
        drain(stream, checkpoint, lambda batch, q, n: write_load(batch, sink, q, n, checkpoint=checkpoint))
        if part:  # the first call has two loads to lay out, the second one only the third
            size = -(-rows.count() // 48)
            lay_out_loads(spark, sink.path, PERSON_SCHEMA, ["l_orderkey", "age"], staging=f"{out}/staging", rows_per_file=size)
    found = spark.read.parquet(sink.path).select("*", "_metadata.file_path")

    def span(name: str) -> Column:
        return F.max(name) - F.min(name)

    whole = found.agg(span("l_orderkey").alias("all_keys"), span("age").alias("all_ages"))
    files = found.groupBy("file_path").agg(span("l_orderkey").alias("keys"), span("age").alias("ages"), F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("key"))
    files = files.join(whole).groupBy((F.col("key") % 3).alias("part"))
    return files.agg(
        F.sum("n").alias("rows"),
        (F.count(F.lit(1)) >= 8).alias("several_files"),
        (F.avg(F.col("keys") / F.col("all_keys")) < 0.5).alias("few_keys"),
        (F.avg(F.col("ages") / F.col("all_ages")) < 0.5).alias("few_ages"),
    )


QUERIES = {
    "clustered_loads": clustered_loads,
    "stream_expectations": stream_expectations,
    "layers_after_rule_change": layers_after_rule_change,
    "gold_after_rule_change": gold_after_rule_change,
    "bound_tables": bound_tables,
    "renamed_rescue_masked": renamed_rescue_masked,
    "half_written_batch": half_written_batch,
    "audit_after_repeat": audit_after_repeat,
    "rule_overflow": rule_overflow,
    "rule_bad_pattern": rule_bad_pattern,
    "custom_rule_raises": custom_rule_raises,
    "schema_evolves_csv": schema_evolves_csv,
    "schema_evolves_parquet": schema_evolves_parquet,
    "nested_schema_merge": nested_schema_merge,
    "widened_type_merge": widened_type_merge,
}

_PEOPLE_EVOLVED = """{person} SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 3 THEN name END AS name, age, office,
    CASE WHEN l_linenumber > 3 THEN 'late' END AS team, CASE WHEN age IS NULL THEN 'ko' ELSE 'ok' END AS side FROM person"""


def oracle(person: str, codes: str, gold: str) -> dict[str, str]:
    """The SQL of these queries, given that of the person rows, of the codes of a row, and of the summary."""
    evolved = _PEOPLE_EVOLVED.format(person=person)
    big = "CAST(a AS BIGINT) + b"
    wide = "CAST(a AS BIGINT) * b"
    zero = "CAST(0 AS BIGINT)"
    bad = "(office IS NULL OR office = '' OR age IS NULL OR age < 18 OR age >= 65)"
    expected = "\n UNION ALL ".join(
        f"""SELECT l_orderkey % 2 AS half, '{rule.split("_")[0]}' AS field, '{rule}' AS rule, count(*) FILTER ({broken}) AS failed,
            count(*) FILTER (NOT {bad}) AS rows, count(*) FILTER ({bad}) AS dropped, count(*) FILTER (NOT {bad}) AS kept
            FROM person GROUP BY 1"""
        for rule, broken in {
            "office_not_empty": "office IS NULL OR office = ''", "age_not_null": "age IS NULL", "age_must_be_adult": "age < 18", "age_not_retirement_age": "age >= 65",
        }.items()
    )
    return {
        "clustered_loads": """SELECT l_orderkey % 3 AS part, count(*) AS rows, true AS several_files, true AS few_keys, true AS few_ages
            FROM lineitem GROUP BY 1""",
        "stream_expectations": f"{person} {expected}",
        "layers_after_rule_change": f"{person} SELECT l_orderkey, l_linenumber, {codes} AS codes FROM person",
        "gold_after_rule_change": gold,
        "bound_tables": f"""{person} SELECT l_orderkey, l_linenumber, 'REDACTED_PII' AS name, office,
            CASE WHEN l_linenumber <= 2 THEN 'new' WHEN l_linenumber > 3 THEN 'late' END AS team,
            CASE WHEN l_linenumber <= 2 THEN 'early' ELSE 'late' END AS side FROM person WHERE office = 'RIO'""",
        "renamed_rescue_masked": f"""SELECT 'REDACTED_PII' AS name, count(*) AS rows, {zero} AS seen_leftover, {zero} AS seen_unreadable,
            count(*) FILTER (l_orderkey % 19 <> 3) AS n_leftover, count(*) FILTER (l_orderkey % 19 = 3) AS n_unreadable FROM lineitem""",
        "half_written_batch": f"""{person} SELECT l_orderkey, l_linenumber, CASE WHEN {bad} THEN 'ko' ELSE 'ok' END AS place
            FROM person WHERE l_linenumber <= 3""",
        "audit_after_repeat": f"""{person} SELECT count(*) FILTER (NOT {bad}) AS rows_ok, count(*) FILTER ({bad}) AS rows_ko,
            CAST(1 AS BIGINT) AS failed, count(*) FILTER (NOT {bad}) AS in_ok, count(*) FILTER ({bad}) AS in_ko,
            CAST(2 AS BIGINT) AS loads FROM person""",
        "rule_overflow": f"""SELECT l_orderkey, l_linenumber, concat_ws(',',
            CASE WHEN a IS NOT NULL AND {big} NOT BETWEEN -2147483648 AND 4999 THEN 'sum' END,
            CASE WHEN a IS NOT NULL AND {big} NOT BETWEEN -2147483648 AND 4999 AND l_linenumber <> 1 THEN 'sum_or' END,
            CASE WHEN a IS NULL THEN NULL WHEN {wide} NOT BETWEEN -2147483648 AND 2147483647 THEN 'product'
                WHEN {wide} * b NOT BETWEEN -2 AND 2147483647 THEN 'product' END,
            CASE WHEN b = 0 THEN 'quotient' WHEN NOT (1000 // b < 600 AND 10 % b = 0) THEN 'quotient' END) AS codes
            FROM ({_NUMBERS} FROM lineitem)""",
        "rule_bad_pattern": f"""SELECT l_orderkey, l_linenumber, concat_ws(',',
            CASE WHEN t IS NOT NULL AND l_linenumber NOT IN (2, 5, 7) THEN 'rlike' END,
            CASE WHEN t IS NOT NULL AND l_linenumber IN (1, 4) THEN 'like' END) AS codes FROM ({_PATTERNS} FROM lineitem)""",
        "custom_rule_raises": f"""SELECT l_orderkey, l_linenumber,
            CASE WHEN amount IS NOT NULL AND coalesce(TRY_CAST(amount AS INT), 0) <= 0 THEN 'positiveAmount' ELSE '' END AS codes
            FROM ({_AMOUNTS} FROM lineitem)""",
        "schema_evolves_csv": evolved,
        "schema_evolves_parquet": evolved,
        "nested_schema_merge": """SELECT c_custkey, CASE WHEN even THEN c_name END AS name, c_nationkey AS nation,
            CASE WHEN NOT even THEN c_mktsegment END AS segment, CASE WHEN NOT even THEN c_acctbal END AS balance, c_custkey AS tag_a,
            CASE WHEN NOT even THEN c_mktsegment END AS tag_b, CASE WHEN even THEN c_nationkey END AS fact_v,
            CASE WHEN NOT even THEN 'w' END AS fact_w FROM (SELECT *, c_custkey % 2 = 0 AS even FROM customer)""",
        "widened_type_merge": """SELECT l_orderkey, CASE WHEN l_linenumber <= 3 THEN l_linenumber ELSE l_linenumber + 5000000000 END AS n,
            CASE WHEN l_linenumber <= 3 THEN l_linenumber ELSE l_linenumber + 5000000000 END AS nested_n,
            CASE WHEN l_linenumber <= 3 THEN CAST(l_linenumber AS DOUBLE) ELSE CAST(l_linenumber AS DOUBLE) / 3 END AS x FROM lineitem""",
    }
