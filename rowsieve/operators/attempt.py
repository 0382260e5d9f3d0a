"""Predicates that give NULL where their evaluation would raise an error.

Spark's functions raise on an overflow, an invalid cast, an index that is not there, a bad pattern. A predicate is
analysed as it is; its tree is then put together again with the forms that give NULL instead (``try_add``,
``try_cast`` and so on), so in ``a + b < 10 OR c`` an overflow leaves the other side its say. Where a
tree has something without such a form, the predicate as a whole is tried (:func:`tried`).
Nothing here depends on a setting of the session, and none is changed.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.names import quote_part
from rowsieve.operators.enrich import widens


class PatternError(ValueError):
    """A pattern that is written out in a predicate is not valid."""


class _Unknown(Exception):
    """A tree has an expression that has no form without errors here."""


_NO, _YES = datetime.date(1970, 1, 1), datetime.date(1970, 1, 2)


def tried(predicate: Column) -> Column:
    """``predicate``, or NULL where any part of it raises an error.

    ``try_add`` of a date and a number of days gives NULL for whatever goes wrong inside, not for overflows only.
    """
    return F.try_add(F.lit(_NO), predicate.cast("int")) == F.lit(_YES)


def _operator(of: Callable) -> Callable:
    return lambda node, parts: reduce(of, parts)


def _function(name: str) -> Callable:
    return lambda node, parts: F.call_function(name, *parts)


#: Expressions that give a value for every input. The second kind is called by its name in SQL.
_TOTAL = {
    "And": _operator(and_),
    "Or": _operator(or_),
    "Not": lambda node, parts: ~parts[0],
    "LessThan": _operator(lt),
    "LessThanOrEqual": _operator(le),
    "GreaterThan": _operator(gt),
    "GreaterThanOrEqual": _operator(ge),
    "EqualTo": _operator(eq),
    "EqualNullSafe": lambda node, parts: parts[0].eqNullSafe(parts[1]),
    "IsNull": lambda node, parts: parts[0].isNull(),
    "IsNotNull": lambda node, parts: parts[0].isNotNull(),
    "In": lambda node, parts: parts[0].isin(*parts[1:]),
    "StartsWith": lambda node, parts: parts[0].startswith(parts[1]),
    "EndsWith": lambda node, parts: parts[0].endswith(parts[1]),
    "Contains": lambda node, parts: parts[0].contains(parts[1]),
    "GetMapValue": lambda node, parts: F.try_element_at(*parts),
    "GetStructField": lambda node, parts: parts[0].getField(node.childSchema().fieldNames()[node.ordinal()]),
    "CaseWhen": lambda node, parts: _case(parts),
} | {
    kind: _function(name)
    for kind, name in {
        "IsNaN": "isnan", "Length": "length", "Upper": "upper", "Lower": "lower", "StringTrim": "trim", "Coalesce": "coalesce",
        "If": "if", "Size": "size", "Concat": "concat", "Substring": "substring", "Year": "year", "Month": "month",
        "DayOfMonth": "day", "Greatest": "greatest", "Least": "least", "CreateArray": "array", "CreateNamedStruct": "named_struct",
    }.items()
}


def _case(parts: list[Column]) -> Column:
    *pairs, other = parts if len(parts) % 2 else [*parts, F.lit(None)]
    case = F.when(pairs[0], pairs[1])
    for i in range(2, len(pairs), 2):
        case = case.when(pairs[i], pairs[i + 1])
    return case.otherwise(other)


def _nonzero(name: str) -> Callable:
    # The lowest number divided by -1 is the one other case that overflows.
    def divided(node, parts: list[Column]) -> Column:
        one, other = parts
        low = (other == -1) & F.try_subtract(F.lit(0).cast(_type(node.children().head())), one).isNull()
        return F.when((other != 0) & ~F.coalesce(low, F.lit(False)), F.call_function(name, one, other))

    return divided


def _negative(node, value: Column) -> Column:
    return F.try_subtract(F.lit(0).cast(_type(node)), value)


#: Expressions on numbers that may fail, each in a form that gives NULL then.
_NUMERIC = {
    "Add": lambda node, parts: F.try_add(*parts),
    "Subtract": lambda node, parts: F.try_subtract(*parts),
    "Multiply": lambda node, parts: F.try_multiply(*parts),
    "Divide": lambda node, parts: F.try_divide(*parts),
    "Remainder": lambda node, parts: F.try_mod(*parts),
    "IntegralDivide": _nonzero("div"),
    "Pmod": lambda node, parts: F.when(parts[1] != 0, F.pmod(*parts)),
    "UnaryMinus": lambda node, parts: _negative(node, parts[0]),
    "Abs": lambda node, parts: F.when(parts[0] >= 0, parts[0]).otherwise(_negative(node, parts[0])),
}
#: Others of that kind.
_RISKY = {
    "GetArrayItem": lambda node, parts: F.get(*parts),
    "ElementAt": lambda node, parts: F.try_element_at(*parts),
}


#: Expressions with a mode of evaluation.
_MODES = ("Cast", "Add", "Subtract", "Multiply", "Divide", "Remainder", "IntegralDivide", "Pmod")


def _type(node) -> T.DataType:
    return T._parse_datatype_json_string(node.dataType().json())


def _children(node) -> list:
    return [node.children().apply(i) for i in range(node.children().size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _walk(node) -> Iterator:
    yield node
    for child in _children(node):
        yield from _walk(child)


def _path(node) -> str | None:
    """A column or a field inside one, as it is written; None for anything else."""
    if _kind(node) == "AttributeReference":
        return quote_part(node.name())
    if _kind(node) == "GetStructField":
        outer = _path(node.child())
        return outer and f"{outer}.{quote_part(node.childSchema().fieldNames()[node.ordinal()])}"
    return None


def _reads(node) -> Iterator[str]:
    path = _path(node)
    if path is not None:
        yield path
        return
    for child in _children(node):
        yield from _reads(child)


def _literal(node) -> str | None:
    """The text of a literal string, None for anything else."""
    if _kind(node) != "Literal" or not isinstance(_type(node), T.StringType) or node.value() is None:
        return None
    return node.value().toString()


def _like_pattern(escape: str) -> str:
    """What a valid pattern of LIKE matches: the escape stands before a wildcard or itself."""
    e = re.escape(escape)
    return rf"(?s)^(?:[^{e}]|{e}[_%{e}])*$"


def _gives_null(node) -> bool:
    """Whether a node is a form without errors already."""
    kind = _kind(node)
    return kind.startswith("Try") or kind in _MODES and str(node.evalMode()) == "TRY"


def _may_fail(node) -> bool:
    kind = _kind(node)
    if kind in ("AttributeReference", "Literal", "Alias", "Between", "With", "CommonExpressionRef", "CommonExpressionDef"):
        return False
    if _gives_null(node):
        return False
    if kind == "Cast":
        # A literal is cast when the query is planned, and a wider type takes every value.
        child = node.child()
        return bool(child.references().size()) and not widens(_type(child), _type(node))
    if kind in ("Like", "RLike"):
        return _literal(_children(node)[1]) is None
    return kind not in _TOTAL and kind not in ("InSet", "StructsToJson", "UnaryPositive")


def _check_patterns(frame: DataFrame, tree) -> None:
    """Patterns that are written out are compiled here, and not for the first row."""
    for node in _walk(tree):
        kind = _kind(node)
        pattern = _literal(_children(node)[1]) if kind in ("Like", "RLike") else None
        if pattern is None:
            continue
        if kind == "Like":
            if not re.search(_like_pattern(str(node.escapeChar())), pattern):
                raise PatternError(f"{pattern!r} is not a pattern of LIKE")
            continue
        try:
            frame.sparkSession._jvm.java.util.regex.Pattern.compile(pattern)
        except Exception as error:
            raise PatternError(f"{pattern!r} is not a pattern of RLIKE") from error


def _again(node, known: dict[str, Column]) -> Column:
    """The tree below ``node``, with forms that give NULL for errors."""
    kind, children = _kind(node), _children(node)
    if kind == "AttributeReference":
        return F.col(quote_part(node.name()))
    if kind == "Literal":
        return F.expr(node.sql())
    if kind in ("Alias", "Between"):
        return _again(children[0], known)
    if kind == "With":
        # What is named inside is written out at each place.
        *names, body = sorted(children, key=lambda child: _kind(child) != "CommonExpressionDef")
        for name in names:
            known = known | {str(name.id()): _again(name.child(), known)}
        return _again(body, known)
    if kind == "CommonExpressionRef":
        return known[str(node.id())]
    parts = [_again(child, known) for child in children if _kind(child) != "CommonExpressionDef"]
    if kind == "Cast":
        return parts[0].try_cast(_type(node)) if _gives_null(node) or _may_fail(node) else parts[0].cast(_type(node))
    if kind == "Like":
        escape = str(node.escapeChar())
        like = F.like(parts[0], parts[1], F.lit(escape))
        return F.when(parts[1].rlike(_like_pattern(escape)), like) if _may_fail(node) else like
    if kind == "RLike" and not _may_fail(node):
        return F.rlike(*parts)
    numeric = isinstance(_type(node), T.NumericType)
    form = _TOTAL.get(kind) or _RISKY.get(kind) or (_NUMERIC.get(kind) if numeric else None)
    if form is None:
        raise _Unknown(kind)
    return form(node, parts)


def without_errors(frame: DataFrame, predicate: Column) -> tuple[Column, tuple[str, ...] | None]:
    """A predicate that raises no error on ``frame``, and what it reads if the given one may raise one.

    One that cannot raise any stays as it is, with None; so it is pushed into scans as before.
    """
    try:
        tree = frame.select(predicate.alias("rule"))._jdf.queryExecution().analyzed().expressions().head()
    except AnalysisException:
        return predicate, None  # what is wrong with it is found out when all rules are checked
    _check_patterns(frame, tree)
    if not isinstance(_type(tree), T.BooleanType) or not any(map(_may_fail, _walk(tree))):
        return predicate, None
    reads = tuple(dict.fromkeys(_reads(tree)))
    try:
        again = _again(tree, {})
        if isinstance(frame.select(again.alias("rule")).schema["rule"].dataType, T.BooleanType):
            return again, reads
    except (_Unknown, AnalysisException):
        pass
    return tried(predicate), reads
