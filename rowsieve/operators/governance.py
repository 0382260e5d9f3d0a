"""Column masks and row filters as governed views.

They shape what a reader of the view sees. Open-source Spark does not enforce them against a
session that can read the table or set the session variable: grant the view, not the table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import LEFTOVER, columns_ddl, quote_name, quote_part, quote_text
from rowsieve.sources.files import move, path_exists, read_text, remove, write_text

# Fixed values of the person policies.
ADMIN = "admin"
REDACTED = "REDACTED_PII"
OPEN_OFFICE = "RIO"

GROUPS_VARIABLE = "principal_groups"


@dataclass(frozen=True)
class Mask:
    """Members of ``group`` see ``column``; everybody else sees ``text``, also for NULL."""

    column: str
    text: str = REDACTED
    group: str = ADMIN


@dataclass(frozen=True)
class RowFilter:
    """Members of ``group`` see all rows; everybody else those where ``column`` = ``value``."""

    column: str
    value: str = OPEN_OFFICE
    group: str = ADMIN


@dataclass(frozen=True)
class Hide:
    """Members of ``group`` see ``column``; for everybody else it is NULL."""

    column: str
    group: str = ADMIN


#: Usual names of columns in which sources keep what did not fit the schema.
LEFTOVER_COLUMNS = ("_rescued_data", "_corrupt_record")

Policy = Mask | RowFilter | Hide

PERSON_POLICIES: tuple[Policy, ...] = (Mask("name"), RowFilter("office"))


def _masks(schema: T.StructType, policies: Sequence[Policy]) -> dict[str, list[Mask | Hide]]:
    """The masks by column, all of which hold. A mask puts text in place of text, so the column must be one.

    Columns that keep what did not fit a schema may hold any masked value, so they are hidden as long as
    something is masked and no policy of their own says otherwise. They are known by their comment,
    which they keep when they are renamed, written and registered, or by their usual names.
    """
    masks: dict[str, list[Mask | Hide]] = {}
    for policy in policies:
        if isinstance(policy, (Mask, Hide)):
            masks.setdefault(policy.column, []).append(policy)
    text = {field.name for field in schema.fields if isinstance(field.dataType, T.StringType)}
    masked = {name for name, found in masks.items() if any(isinstance(p, Mask) for p in found)}
    if not masked <= text:
        raise ValueError(f"no text columns to mask: {sorted(masked - text)}")
    groups = sorted({policy.group for found in masks.values() for policy in found})
    for field in schema.fields:
        leftover = field.name in LEFTOVER_COLUMNS or field.metadata.get("comment") == LEFTOVER
        if leftover and field.name not in masks:
            masks[field.name] = [Hide(field.name, group) for group in groups]
    return masks


def governed(df: DataFrame, policies: Sequence[Policy], groups: Iterable[str]) -> DataFrame:
    """``df`` as a principal in ``groups`` may see it.

    Filters come first, so they see unmasked values. Membership is a literal: for an outsider
    the mask folds to a constant, the masked column is not even read, and the row filter
    reaches the scan.
    """
    member = set(groups)
    for policy in policies:
        if isinstance(policy, RowFilter):
            df = df.filter(F.lit(policy.group in member) | (F.col(policy.column) == policy.value))
    masks = _masks(df.schema, policies)
    columns = []
    for name in df.columns:
        column = F.col(quote_part(name))
        for mask in masks.get(name, ()):
            other = F.lit(mask.text) if isinstance(mask, Mask) else F.lit(None)
            column = F.when(F.lit(mask.group in member), column).otherwise(other)
        columns.append(column.alias(name))
    return df.select(*columns)


def _governed_select(spark: SparkSession, table: str, policies: Sequence[Policy], member) -> str:
    schema = spark.table(table).schema
    columns, masks = schema.names, _masks(schema, policies)
    shown = [quote_part(column) for column in columns]
    for name, found in masks.items():
        case = quote_part(name)
        for mask in found:
            other = quote_text(mask.text) if isinstance(mask, Mask) else "NULL"
            case = f"CASE WHEN {member(mask.group)} THEN {case} ELSE {other} END"
        shown[columns.index(name)] = f"{case} AS {quote_part(name)}"
    kept = [
        f"({member(p.group)} OR {quote_part(p.column)} = {quote_text(p.value)})"
        for p in policies
        if isinstance(p, RowFilter)
    ]
    where = f" WHERE {' AND '.join(kept)}" if kept else ""
    return f"SELECT {', '.join(shown)} FROM {quote_name(table)}{where}"


def publish_governed_view(
    spark: SparkSession,
    view: str,
    table: str,
    policies: Sequence[Policy] = PERSON_POLICIES,
    *,
    groups: Iterable[str] = (),
) -> DataFrame:
    """Create (or replace) a catalog view of ``table`` for principals in ``groups``."""
    members = set(groups)
    body = _governed_select(
        spark, table, policies, lambda group: "true" if group in members else "false"
    )
    spark.sql(f"CREATE OR REPLACE VIEW {quote_name(view)} AS {body}")
    return spark.table(view)


def publish_governed_views(
    spark: SparkSession,
    tables: Mapping[str, str],
    policies: Sequence[Policy] = PERSON_POLICIES,
    *,
    groups: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Bind one set of policies to several tables: a governed view per ``{view: table}``."""
    return {
        view: publish_governed_view(spark, view, table, policies, groups=groups)
        for view, table in tables.items()
    }


#: What the hidden table of a bound one is called, and where the view keeps what it was made of.
_BASE = "__base"
_POLICIES, _GROUPS = "rowsieve.policies", "rowsieve.groups"


def base_of(spark: SparkSession, table: str) -> str:
    """The table that loads write to: the hidden one if policies are bound to ``table``, else itself."""
    base = f"{table}{_BASE}"
    return base if spark.catalog.tableExists(base) else table


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "VIEW"


def _bind(spark: SparkSession, table: str, policies: Sequence[Policy], groups: Iterable[str]) -> None:
    members = sorted(set(groups))
    body = _governed_select(spark, base_of(spark, table), policies, lambda group: "true" if group in members else "false")
    kept = json.dumps([{"kind": type(policy).__name__, **asdict(policy)} for policy in policies])
    facts = {_POLICIES: kept, _GROUPS: json.dumps(members)}
    pairs = ", ".join(f"{quote_text(key)} = {quote_text(value)}" for key, value in facts.items())
    spark.sql(f"CREATE OR REPLACE VIEW {quote_name(table)} TBLPROPERTIES ({pairs}) AS {body}")


def bind_policies(
    spark: SparkSession,
    table: str,
    policies: Sequence[Policy] = PERSON_POLICIES,
    *,
    groups: Iterable[str] = (),
) -> DataFrame:
    """Bind policies to a table or view itself: its name now shows what principals in ``groups`` may see.

    The rows move to a hidden name, of which this library's loads write under the old one, and with columns that
    a later load brings the policies are bound again. Binding anew replaces the policies. A run
    that ended between the two steps is finished by the next call.

    Files stay where they are, as streams know them by their places: a managed table becomes one of the same
    directory that a drop does not delete.
    """
    _finish_take_over(spark, table)
    if base_of(spark, table) == table:
        kind = "VIEW" if _is_view(spark, table) else "TABLE"
        _governed_select(spark, table, policies, lambda group: "false")  # policies that do not fit move nothing
        if kind == "TABLE" and spark.catalog.getTable(table).tableType == "MANAGED":
            _take_over(spark, table)
        else:
            spark.sql(f"ALTER {kind} {quote_name(table)} RENAME TO {quote_name(table + _BASE)}")
    _bind(spark, table, policies, groups)
    return spark.table(table)


def _note_of(spark: SparkSession, table: str) -> str:
    """Where it is written down that a table is being taken over."""
    *namespace, name = table.split(".")
    database = ".".join(namespace) or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_{name}{_BASE}.json"


def _take_over(spark: SparkSession, table: str) -> None:
    """Make the hidden table of a managed one's directory, and drop the managed one without its files.

    They step aside for the drop. What is needed to go on is written down first.
    """
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").collect()
    facts = {row.col_name: row.data_type for row in rows}
    columns = spark.catalog.listColumns(table)
    kept = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").collect()}
    note = {
        "location": facts["Location"],
        "columns": columns_ddl(spark.table(table).schema.fields),
        "format": facts["Provider"],
        "partitions": [c.name for c in columns if c.isPartition],
        "properties": {k: v for k, v in kept.items() if not k.startswith(("spark.sql.", "option.")) and k != "transient_lastDdlTime"},
        "comment": facts.get("Comment"),
    }
    write_text(spark, _note_of(spark, table), json.dumps(note))
    _finish_take_over(spark, table)


def _finish_take_over(spark: SparkSession, table: str) -> None:
    place = _note_of(spark, table)
    if not path_exists(spark, place):
        return
    note, base = json.loads(read_text(spark, place)), f"{table}{_BASE}"
    location, aside = note["location"], f"{note['location']}__aside"
    if spark.catalog.tableExists(table) and not spark.catalog.tableExists(base):
        if path_exists(spark, location):
            move(spark, location, aside)
        spark.sql(f"DROP TABLE {quote_name(table)}")
    if path_exists(spark, aside):
        move(spark, aside, location)
    parts = f" PARTITIONED BY ({', '.join(map(quote_part, note['partitions']))})" if note["partitions"] else ""
    pairs = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in note["properties"].items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote_name(base)} ({note['columns']}) USING {note['format']}{parts} "
        f"LOCATION {quote_text(location)}" + (f" COMMENT {quote_text(note['comment'])}" if note["comment"] else "")
        + (f" TBLPROPERTIES ({pairs})" if pairs else "")
    )
    if note["partitions"]:
        spark.sql(f"MSCK REPAIR TABLE {quote_name(base)} SYNC PARTITIONS")
    remove(spark, place)


def bind_all(
    spark: SparkSession, tables: Iterable[str], policies: Sequence[Policy] = PERSON_POLICIES, *, groups: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Bind one set of policies to several tables."""
    members = list(groups)
    return {table: bind_policies(spark, table, policies, groups=members) for table in tables}


def bound_policies(spark: SparkSession, table: str) -> tuple[list[Policy], list[str]] | None:
    """The policies and groups bound to a table, if there are any."""
    if base_of(spark, table) == table or not spark.catalog.tableExists(table):
        return None
    facts = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").collect()}
    kinds = {kind.__name__: kind for kind in (Mask, RowFilter, Hide)}
    found = json.loads(facts[_POLICIES])
    return [kinds[fact.pop("kind")](**fact) for fact in found], json.loads(facts[_GROUPS])


def rebind(spark: SparkSession, table: str) -> None:
    """Bind a table's policies again, to the columns that it has now; nothing for one without policies."""
    bound = bound_policies(spark, table)
    if bound is not None:
        _bind(spark, table, *bound)


def unbind_policies(spark: SparkSession, table: str) -> None:
    """Give a table its rows back."""
    base = base_of(spark, table)
    if base == table:
        return
    spark.sql(f"DROP VIEW IF EXISTS {quote_name(table)}")
    kind = "VIEW" if _is_view(spark, base) else "TABLE"
    spark.sql(f"ALTER {kind} {quote_name(base)} RENAME TO {quote_name(table)}")


def set_principal(spark: SparkSession, groups: Iterable[str]) -> None:
    """Say which groups this session's principal is in; session views and functions follow."""
    members = ", ".join(quote_text(group) for group in groups)
    spark.sql(
        f"DECLARE OR REPLACE VARIABLE {GROUPS_VARIABLE} ARRAY<STRING> "
        f"DEFAULT CAST(array({members}) AS ARRAY<STRING>)"
    )


def _in_session_groups(group: str) -> str:
    return f"array_contains(system.session.{GROUPS_VARIABLE}, {group})"


def publish_session_view(
    spark: SparkSession,
    view: str,
    table: str,
    policies: Sequence[Policy] = PERSON_POLICIES,
    *,
    groups: Iterable[str] = (),
) -> DataFrame:
    """A temporary view that follows the groups :func:`set_principal` gives this session.

    The session starts as a member of ``groups``. The variable is folded when a query is
    planned, so an outsider gets the same pruned and pushed-down plan as through a view made
    for that principal.
    """
    set_principal(spark, groups)
    body = _governed_select(
        spark, table, policies, lambda group: _in_session_groups(quote_text(group))
    )
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quote_name(view)} AS {body}")
    return spark.table(view)


def create_policy_functions(
    spark: SparkSession, *, groups: Iterable[str] = (), namespace: str | None = None
) -> None:
    """SQL functions ``name_mask_policy`` and ``office_filter_policy``; the optimizer inlines them.

    Without a ``namespace`` they belong to the session, come with ``is_group_member``, and read
    the session's groups, which start as ``groups``. In a namespace they are catalog functions
    for principals in ``groups``; those cannot refer to a session's variable.
    """
    if namespace is None:
        set_principal(spark, groups)
        member = _in_session_groups("wanted")
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION is_group_member(wanted STRING) "
            f"RETURNS BOOLEAN RETURN {member}"
        )
        create, prefix = "CREATE OR REPLACE TEMPORARY FUNCTION", ""
        admin = f"is_group_member({quote_text(ADMIN)})"
    else:
        create, prefix = "CREATE OR REPLACE FUNCTION", f"{quote_name(namespace)}."
        admin = "true" if ADMIN in set(groups) else "false"
    spark.sql(
        f"{create} {prefix}name_mask_policy(name STRING) RETURNS STRING "
        f"RETURN IF({admin}, name, {quote_text(REDACTED)})"
    )
    spark.sql(
        f"{create} {prefix}office_filter_policy(office STRING) RETURNS BOOLEAN "
        f"RETURN {admin} OR office = {quote_text(OPEN_OFFICE)}"
    )


def use_namespace(spark: SparkSession, schema: str, catalog: str | None = None) -> None:
    """Switch to ``catalog.schema``; the names are bound as parameters, not spliced."""
    if catalog is not None:
        spark.catalog.setCurrentCatalog(catalog)
    spark.sql("USE IDENTIFIER(:name)", args={"name": quote_name(schema)})
