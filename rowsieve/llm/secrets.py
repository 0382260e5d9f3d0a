"""Secrets in texts: key patterns, and windows of high Shannon entropy in runs of one character class.

Three kinds are patterns, leftmost and non-overlapping, of which short matches are dropped:
``assign`` (a name such as ``password``, a sign, a value), ``access`` and ``hex``. The others come
from entropy. For each character class (``CLASSES``) every maximal run of its characters that is as
long as the class's window is a candidate. The window slides over the candidate; each step adds one
character's count and takes one away, so it costs the same whatever the window's length. Windows
that reach the class's bits a character are joined where they touch, and what they cover is a span,
unless an allow rule (``ALLOWED``) knows its text or what stands before it as harmless. Allow rules never
suppress the three patterns. The sums are integers (``c * log2(c)`` in units of 2^-32), so that a
step back undoes a step forward exactly.

A text is read once, in time linear in its length, and nothing is shuffled. Places are code points,
from 0, the end exclusive; a place that several kinds find has a span of each.

Defined results: a null, empty or clean text has no spans; a text of any length is one text; a
repeated row is scanned again; a null id stays null; other columns are not read; without documents
there are no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, texts
from rowsieve.llm.memory import tidy_batch

_UNIT = 1 << 32


class Pattern(NamedTuple):
    kind: str
    pattern: str
    #: The group whose length counts, and the least length.
    group: int
    least: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


#: Fixed by the contract of the scan. The letters of names stand in either case, in ASCII only.
NAMES = ["password", "passwd", "secret", "token", "api_?key"]
PATTERNS = [
    Pattern(
        "assign",
        "(" + "|".join(map(_either_case, NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Pattern("access", "AKIA[A-Z0-9]+", 0, 20),
    Pattern("hex", "[0-9a-f]+", 0, 24),
]


class CharClass(NamedTuple):
    kind: str
    #: The characters, as inside brackets of a pattern.
    chars: str
    window: int
    #: Bits a character from which a window counts.
    bits: float

    @property
    def limit(self) -> int:
        """What the sum of ``c * log2(c)`` over the window's counts may be at most, in units."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * _UNIT)


CLASSES = [
    CharClass("entropy_hex", "0-9A-Fa-f", 24, 3.0),
    CharClass("entropy_base64", "A-Za-z0-9+/", 20, 3.7),
    CharClass("entropy_url", "A-Za-z0-9_-", 20, 3.7),
]
KINDS = [x.kind for x in [*PATTERNS, *CLASSES]]
BASE_KINDS = [x.kind for x in PATTERNS]


class Allowed(NamedTuple):
    name: str
    pattern: str
    #: ``whole``: the span is this; ``within``: it has this; ``before``: this ends where it starts.
    where: str = "whole"


#: What has much entropy and is no secret.
ALLOWED = [
    Allowed("number", r"[0-9]+"),
    Allowed("words", r"[A-Za-z]+(?:[+/_-]+[A-Za-z]+)*[+/_-]*"),
    Allowed("words and numbers", r"[A-Za-z]{3,}[0-9]{0,4}(?:[/_-]+(?:[A-Za-z]{3,}[0-9]{0,4}|[0-9]{1,4}))+"),
    Allowed("uuid", r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"),
    Allowed("placeholder", r"EXAMPLE|[Ee]xample|[Pp]laceholder|[Cc]hange_?[Mm]e|[Dd]ummy|[Yy]our_|[Xx]{6}", "within"),
    Allowed("alphabet", r"abcdefgh|ABCDEFGH|01234567|12345678", "within"),
    Allowed("digest", r"(?:sha1|sha256|sha384|sha512|md5)[-:=]", "before"),
    Allowed("revision", r"(?:commit|revision|checksum)[:=]?\x20", "before"),
]
#: How far back ``before`` looks: no rule of that kind matches more.
BACK = 16


def _rules() -> dict[str, re.Pattern]:
    return {where: re.compile("|".join(f"(?:{a.pattern})" for a in ALLOWED if a.where == where)) for where in ("whole", "within")} | {
        "before": re.compile("(?:" + "|".join(a.pattern for a in ALLOWED if a.where == "before") + r")\Z")
    }


_ALLOW = _rules()


def harmless(text: str, start: int, end: int) -> bool:
    """Whether an allow rule knows the span."""
    span = text[start:end]
    return bool(
        _ALLOW["whole"].fullmatch(span) or _ALLOW["within"].search(span) or _ALLOW["before"].search(text[max(0, start - BACK) : start])
    )


def _steps(window: int) -> list[int]:
    """By how much ``c * log2(c)`` grows when c becomes c + 1."""
    cost = [0, 0, *(round(c * math.log2(c) * _UNIT) for c in range(2, window + 1))]
    return [b - a for a, b in zip(cost, cost[1:])]


_STEPS = {c.kind: _steps(c.window) for c in CLASSES}


def hot_spans(run: str, kind: CharClass) -> Iterator[tuple[int, int, int]]:
    """Start, end and least sum of what windows of the wanted entropy cover in one run."""
    step, window, limit = _STEPS[kind.kind], kind.window, kind.limit
    counts: dict[str, int] = dict.fromkeys(run, 0)
    total, start, end, least = 0, -1, -1, 0
    for i, char in enumerate(run):
        if i >= window:
            gone = run[i - window]
            counts[gone] = c = counts[gone] - 1
            total -= step[c]
        c = counts[char]
        total += step[c]
        counts[char] = c + 1
        if total <= limit and i >= window - 1:
            first = i - window + 1
            if first > end:
                if start >= 0:
                    yield start, end, least
                start, least = first, total
            end, least = i + 1, min(least, total)
    if start >= 0:
        yield start, end, least


#: A run that is too short is no match: in runs of one class, and in runs after AKIA, a later start is shorter still.
_FAST = {
    "assign": re.compile(PATTERNS[0].pattern),
    "access": re.compile("AKIA[A-Z0-9]{16,}"),
    "hex": re.compile("[0-9a-f]{24,}"),
} | {c.kind: re.compile(f"[{c.chars}]{{{c.window},}}") for c in CLASSES}
#: Lower-case parts of which each text with an ``assign`` has one.
_HINTS = ["passw", "secret", "token", "key"]


def find(text: str | None) -> list[tuple[int, int, int, float | None]]:
    """Start, number of the kind, end and, for entropy, the most bits a character, in order."""
    found: list[tuple[int, int, int, float | None]] = []
    if not text:
        return found
    lower = text.lower()
    for number, p in enumerate(PATTERNS):
        if p.kind == "assign" and not any(hint in lower for hint in _HINTS):
            continue
        for m in _FAST[p.kind].finditer(text):
            if m.end(p.group) - m.start(p.group) >= p.least:
                found.append((m.start(), number, m.end(), None))
    for number, c in enumerate(CLASSES, len(PATTERNS)):
        for m in _FAST[c.kind].finditer(text):
            for start, end, least in hot_spans(m.group(), c):
                if not harmless(text, start := m.start() + start, end := m.start() + end):
                    found.append((start, number, end, math.log2(c.window) - least / _UNIT / c.window))
    found.sort()
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))


def _finder():
    def spans(text: pa.Array) -> pa.Array:
        rows = ([{"kind": KINDS[k], "start": s, "end": e, "bits": b} for s, k, e, b in find(value.as_py())] for value in text)
        return pa.array(rows, _SPANS)

    return F.arrow_udf(tidy_batch(spans), "array<struct<kind: string, start: bigint, end: bigint, bits: double>>")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, spans (kind, start, end, bits) by start, then kind in the order of ``KINDS``."""
    return texts(docs, id_col, text_col).select("doc_id", _finder()("text").alias("spans"))


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with each stretch that spans cover replaced by ``mark``."""

    def hide(text: pa.Array) -> pa.Array:
        out = []
        for value in text:
            value = value.as_py()
            parts, at, until = [], 0, 0  # of the stretch that is covered: its end
            for start, _, end, _ in find(value):
                if start >= until:
                    parts += [value[at:start], mark]
                at = until = max(until, end)
            out.append(value if not parts else "".join([*parts, value[at:]]))
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, F.arrow_udf(tidy_batch(hide), "string")(column(docs, text_col).cast("string")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Of what :func:`scan` gives: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(_joined(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(of(*[c.kind for c in CLASSES])).cast("bigint").alias("n_entropy"),
    )
