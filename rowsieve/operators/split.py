"""Verdicts, error traces and the valid / rejected split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.operators.rules import Rule, RuleError

# Fixed value: the name readers of the rejected table use for the trace.
TRACE_COLUMN = "arraycoderrorbyfield"
TRACES = ("map", "array", "full")


class Split(NamedTuple):
    ok: DataFrame
    ko: DataFrame


def is_ok(rules: Sequence[Rule]) -> Column:
    """True for a row that breaks no rule; always true without rules."""
    return reduce(and_, (rule.passed() for rule in rules), F.lit(True))


def is_ko(rules: Sequence[Rule]) -> Column:
    """The complement of :func:`is_ok`; always false without rules."""
    return reduce(or_, (rule.failed() for rule in rules), F.lit(False))


# The traces below use no lambdas: higher-order functions are interpreted and keep their
# operator out of whole-stage codegen. Passed rules leave an empty marker, and array_remove
# drops the markers. Maps are built from two such arrays, which lose the same positions.


def _codes(rules: Sequence[Rule]) -> Column:
    marked = [F.when(rule.failed(), F.lit(rule.code)).otherwise(F.lit("")) for rule in rules]
    return F.array_remove(F.array(*marked), "")


def _by_field(rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    fields: dict[str, list[Rule]] = {}
    for rule in rules:
        fields.setdefault(rule.field, []).append(rule)
    return fields


def array_trace(rules: Sequence[Rule]) -> Column:
    """``array<string>`` of the failed codes in rule order; empty for a clean row."""
    if not rules:
        return F.array().cast("array<string>")
    return _codes(rules)


def _map(rules: Sequence[Rule], value_of: Callable[[Sequence[Rule]], Column], empty) -> Column:
    fields, values = [], []
    for field, checks in _by_field(rules).items():
        broken = reduce(or_, (rule.failed() for rule in checks))
        fields.append(F.when(broken, F.lit(field)).otherwise(F.lit("")))
        values.append(value_of(checks))
    return F.map_from_arrays(
        F.array_remove(F.array(*fields), ""), F.array_remove(F.array(*values), empty)
    )


def _first_code(rules: Sequence[Rule]) -> Column:
    code = F.lit("")
    for rule in reversed(rules):
        code = F.when(rule.failed(), F.lit(rule.code)).otherwise(code)
    return code


def map_trace(rules: Sequence[Rule]) -> Column:
    """``map<string,string>`` field → first failing code; one entry per field at most."""
    if not rules:
        return F.create_map().cast("map<string,string>")
    return _map(rules, _first_code, "")


def full_trace(rules: Sequence[Rule]) -> Column:
    """``map<string,array<string>>`` field → every failed code, in rule order."""
    if not rules:
        return F.create_map().cast("map<string,array<string>>")
    return _map(rules, _codes, F.array().cast("array<string>"))


def trace(rules: Sequence[Rule], kind: str = "map") -> Column:
    if kind == "map":
        return map_trace(rules)
    if kind == "array":
        return array_trace(rules)
    if kind == "full":
        return full_trace(rules)
    raise RuleError(f"trace must be one of {list(TRACES)}, not {kind!r}")


def annotate(
    df: DataFrame, rules: Sequence[Rule], *, kind: str = "map", column: str = TRACE_COLUMN
) -> DataFrame:
    """All rows, with their error trace."""
    return df.withColumn(column, trace(rules, kind))


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule: plain predicates, so they are pushed into the scan."""
    return df.filter(is_ok(rules))


def rejected_rows(
    df: DataFrame, rules: Sequence[Rule], *, kind: str = "map", column: str = TRACE_COLUMN
) -> DataFrame:
    """Rows that break a rule. The trace is computed above the filter, for these rows only.

    Without rules this is an empty relation that still has the typed trace column and still
    is a stream when ``df`` is one.
    """
    rejected = df.filter(is_ko(rules))
    return annotate(rejected, rules, kind=kind, column=column)


def split(
    df: DataFrame, rules: Sequence[Rule], *, kind: str = "map", column: str = TRACE_COLUMN
) -> Split:
    """Every input row lands on exactly one side. Works on batch and streaming frames."""
    return Split(valid_rows(df, rules), rejected_rows(df, rules, kind=kind, column=column))
