"""Text standardisation: the native form, and the Python UDFs it is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The prefix, the six blanks that Java's \s matches, and the line terminators
# outside \s before which Java's $ also matches.
PREFIX = "EMP_"
BLANKS = " \t\n\x0b\f\r"
LINE_ENDS = ("\u0085", "\u2028", "\u2029")
EDGE_BLANKS = r"^\s+|\s+$"


def clean_name(column: Column | str, prefix: str = PREFIX) -> Column:
    """Upper-case, strip blanks at both ends, put ``prefix`` in front; NULL stays NULL.

    The meaning is that of the pattern ``^\\s+|\\s+$``. Trimming the same six blanks gives the
    same text without running a regex on every row; the pattern itself is only used for values
    that end in one of the rare line terminators it treats as an end of text.
    """
    upper = F.upper(F.col(column) if isinstance(column, str) else column)
    rare_end = reduce(or_, (F.endswith(upper, F.lit(end)) for end in LINE_ENDS))
    stripped = F.when(rare_end, F.regexp_replace(upper, EDGE_BLANKS, "")).otherwise(
        F.btrim(upper, F.lit(BLANKS))
    )
    return F.concat(F.lit(prefix), stripped)


def clean_name_udf(prefix: str = PREFIX, *, arrow: bool = False) -> Callable[..., Column]:
    """The row-at-a-time Python form, kept to compare with :func:`clean_name`.

    Python's ``strip`` also removes Unicode blanks, so the two agree on ASCII blanks only.
    """

    def clean(text):
        return None if text is None else prefix + text.strip().upper()

    return F.udf(clean, T.StringType(), useArrow=arrow)
