"""Named and SQL rules, compiled from a contract into boolean Columns."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.operators.attempt import PatternError, without_errors

# The rule names and the adult age a contract relies on.
ADULT_AGE = 18
NOT_NULL = "notNull"
NOT_EMPTY = "notEmpty"
IS_ADULT = "isAdult"

NULL_POLICIES = ("pass", "fail")
CODE_STYLES = ("short", "qualified")


class RuleError(ValueError):
    """A contract names a rule, field or expression that cannot be compiled."""


@dataclass(frozen=True)
class Rule:
    """One check on a row.

    ``nulls`` says what a predicate that evaluates to NULL means: "pass" is the SQL CHECK
    reading (only FALSE fails), "fail" wants an explicit TRUE. ``total`` marks a predicate that
    is never NULL, which spares the filter its IS NULL branch.

    ``reads`` is set on a predicate whose evaluation could raise an error (a cast, arithmetic, a pattern): the
    columns and fields it reads. It gives NULL in place of an error
    (:func:`rowsieve.operators.attempt.without_errors`), and a row that has all of these values and still gets
    no answer breaks the rule.
    """

    field: str
    code: str
    predicate: Column
    nulls: str = "pass"
    total: bool = False
    reads: tuple[str, ...] | None = None

    def _unanswered(self) -> Column:
        """The predicate is NULL because a value is missing."""
        if self.reads is None:
            return self.predicate.isNull()
        missing = reduce(or_, (F.col(path).isNull() for path in self.reads), F.lit(False))
        return self.predicate.isNull() & missing

    def passed(self) -> Column:
        # `p OR p IS NULL` rather than coalesce(p, true): Catalyst rewrites the IS NULL over a
        # comparison to one over the column, so the whole term reaches the parquet reader.
        if self.total or self.nulls == "fail":
            # NULL AND TRUE would stay NULL; a filter drops it either way.
            return self.predicate
        return self.predicate | self._unanswered()

    def failed(self) -> Column:
        if self.reads is not None and self.nulls == "pass":
            return ~F.coalesce(self.passed(), F.lit(False))
        if self.total or self.nulls == "pass":
            return ~self.predicate
        return ~self.predicate | self.predicate.isNull()


def fingerprint(rules: Sequence[Rule]) -> str:
    """What tells one set of rules from another: fields, codes, predicates, null policies, in their order."""
    facts = [[rule.field, rule.code, str(rule.predicate), rule.nulls, rule.reads] for rule in rules]
    return hashlib.sha256(json.dumps(facts).encode()).hexdigest()


@dataclass(frozen=True)
class NamedCheck:
    """A registered rule: builds a predicate from a column and that column's type."""

    build: Callable[[Column, T.DataType], Column]
    label: str
    total: bool = False


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def _not_null(column: Column, dtype: T.DataType) -> Column:
    return column.isNotNull()


def _not_empty(column: Column, dtype: T.DataType) -> Column:
    # Comparing a non-string with '' is a cast error under ANSI; such a value is never empty.
    if not _is_text(dtype):
        return column.isNotNull()
    return column.isNotNull() & (column != F.lit(""))


def _is_adult(column: Column, dtype: T.DataType) -> Column:
    # An inferred schema may hand over text; unreadable numbers become NULL, as for a strict read.
    number = column.try_cast("double") if _is_text(dtype) else column
    return number >= F.lit(ADULT_AGE)


_REGISTRY: dict[str, NamedCheck] = {
    NOT_NULL: NamedCheck(_not_null, "not_null", total=True),
    NOT_EMPTY: NamedCheck(_not_empty, "not_empty", total=True),
    IS_ADULT: NamedCheck(_is_adult, "must_be_adult"),
}


def register_rule(
    name: str, build: Callable[..., Column], label: str | None = None, *, total: bool = False
) -> None:
    """Make ``name`` usable in contracts.

    ``build`` takes the column, or the column and its data type. ``label`` is the part after
    ``<field>_`` in qualified codes. ``total`` promises a predicate that is never NULL.
    """
    if not name:
        raise RuleError("a rule needs a name")
    takes_type = len(inspect.signature(build).parameters) >= 2
    check = build if takes_type else (lambda column, dtype: build(column))
    _REGISTRY[name] = NamedCheck(check, label or name, total)


def registered_rules() -> tuple[str, ...]:
    return tuple(_REGISTRY)


# Checking costs two analyses per compilation, which happens once per micro-batch; only a
# contract that fails them is looked at rule by rule, to say what is wrong with it.


def _types_of(frame: DataFrame, columns: Sequence[Column]) -> list[T.DataType] | None:
    try:
        return [field.dataType for field in frame.select(*columns).schema.fields]
    except AnalysisException:
        return None


def _field_types(frame: DataFrame, fields: Iterable[str]) -> dict[str, T.DataType]:
    names = list(dict.fromkeys(fields))
    types = _types_of(frame, [F.col(name) for name in names])
    if types is None:
        unknown = [name for name in names if _types_of(frame, [F.col(name)]) is None]
        raise RuleError(f"rule fields {unknown} are not in the input {frame.columns}")
    return dict(zip(names, types))


def _analyse(frame: DataFrame, rules: Sequence[Rule]) -> AnalysisException | None:
    try:
        frame.agg(*[F.bool_and(rule.predicate) for rule in rules]).schema
    except AnalysisException as error:
        return error
    return None


def _check_predicates(frame: DataFrame, rules: Sequence[Rule]) -> None:
    """Every predicate is a boolean of one row that comes out the same when computed again.

    Spark refuses anything else as the argument of an aggregate, so analysing one is the check.
    """
    if not rules or _analyse(frame, rules) is None:
        return
    for rule in rules:
        error = _analyse(frame, [rule])
        if error is None:
            continue
        types = _types_of(frame, [rule.predicate])
        if types is None:
            wrong = "does not resolve"
        elif not isinstance(types[0], T.BooleanType):
            wrong = f"is {types[0].simpleString()}, not boolean"
        else:
            wrong = "is not a deterministic check of one row"
        reason = str(error).strip().splitlines()[0]
        raise RuleError(f"rule {rule.code!r} of {rule.field!r} {wrong}: {reason}") from error


def _without_errors(frame: DataFrame, predicate: Column, code: str, field: str) -> tuple[Column, tuple[str, ...] | None]:
    try:
        return without_errors(frame, predicate)
    except PatternError as error:
        raise RuleError(f"rule {code!r} of {field!r}: {error}") from error


def _choice(value: str, allowed: Sequence[str], what: str) -> str:
    if value not in allowed:
        raise RuleError(f"{what} must be one of {list(allowed)}, not {value!r}")
    return value


def compile_rules(
    frame: DataFrame,
    validations: Sequence[Mapping],
    *,
    code_style: str = "short",
    nulls: str = "pass",
    on_unknown: str = "raise",
) -> list[Rule]:
    """Turn contract blocks into rules, in contract order.

    Each block is ``{"field", "validations": [name, …], "sql_expressions": [{"error_code",
    "expression"}, …]}``; a block or an SQL rule may carry its own ``null_policy``. ``frame``
    only supplies the schema, nothing is executed, and it may be a stream. Rules have to be
    deterministic: the sides are computed apart, and lost tasks again, with the same verdict.

    A rule stated twice counts once. Two different expressions under one code of one field
    become a single rule that holds when both hold.
    """
    _choice(code_style, CODE_STYLES, "code_style")
    _choice(nulls, NULL_POLICIES, "nulls")
    _choice(on_unknown, ("raise", "skip"), "on_unknown")
    for block in validations:
        if not block.get("field"):
            raise RuleError(f"validation block without a field: {dict(block)}")
    types = _field_types(frame, (block["field"] for block in validations))

    compiled: dict[tuple[str, str], tuple[Rule, set]] = {}

    def add(rule: Rule, identity: tuple) -> None:
        if not rule.code:
            raise RuleError(f"a rule on {rule.field!r} has no error code")
        _choice(rule.nulls, NULL_POLICIES, "null_policy")
        if code_style == "qualified":
            rule = replace(rule, code=f"{rule.field}_{rule.code}")
        key = (rule.field, rule.code)
        if key not in compiled:
            compiled[key] = (rule, {identity})
            return
        known, seen = compiled[key]
        if identity in seen:
            return
        if known.nulls != rule.nulls:
            raise RuleError(f"code {rule.code!r} of {rule.field!r} has two null policies")
        both = known.predicate & rule.predicate
        reads = None if known.reads is rule.reads is None else (*(known.reads or ()), *(rule.reads or ()))
        merged = replace(known, predicate=both, total=known.total and rule.total, reads=reads)
        compiled[key] = (merged, seen | {identity})

    for block in validations:
        field = block["field"]
        policy = block.get("null_policy", nulls)
        for name in block.get("validations") or ():
            check = _REGISTRY.get(name)
            if check is None:
                if on_unknown == "skip":
                    continue
                raise RuleError(f"unknown rule {name!r} on {field!r}; known: {list(_REGISTRY)}")
            code = check.label if code_style == "qualified" else name
            predicate, reads = _without_errors(frame, check.build(F.col(field), types[field]), code, field)
            total = check.total and reads is None
            add(Rule(field, code, predicate, policy, total, reads), ("named", name))
        for sql_rule in block.get("sql_expressions") or ():
            expression = sql_rule.get("expression")
            if not expression:
                raise RuleError(f"an SQL rule on {field!r} has no expression")
            sql_policy, code = sql_rule.get("null_policy", policy), sql_rule.get("error_code")
            predicate, reads = _without_errors(frame, F.expr(expression), code, field)
            add(Rule(field, code, predicate, sql_policy, reads=reads), ("sql", expression))
    rules = [rule for rule, _ in compiled.values()]
    _check_predicates(frame, rules)
    return rules
