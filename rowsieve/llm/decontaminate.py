"""Benchmark decontamination with a generalised suffix automaton.

The automaton of the normalised benchmark items accepts every run of words of any item. Streaming
a document through it gives, after each word, the length of the longest run ending there that some
item contains. Where it reaches the window (10 words; a shorter item is one window as a whole), the
words of that window are hit.

The automaton is built of blocks of a fixed number of benchmark words, so what is broadcast has a
bound that does not depend on the tables; a larger benchmark takes more blocks, and every document
meets all of them. Documents are never shuffled.

Defined results: a null or empty text has no words and no hits; an item without words has no
window; items that repeat an id count once, an id that is null counts as the empty string;
repeated documents each get their row; without items nothing is hit, without documents there are no
rows; a text of any length is handled whole, in time proportional to it; other columns are left alone
whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, table, texts, unused
from rowsieve.llm.memory import tidy, tidy_batch
from rowsieve.llm.words import ALNUM_BYTES, text_bytes

WINDOW = 10
#: Benchmark words in one automaton; it has at most twice as many states.
BLOCK_WORDS = 100_000
#: Automata that one job applies; more take further jobs over the written result.
BLOCKS_AT_ONCE = 4

_MATCH = "struct<n_words: bigint, starts: array<int>, ends: array<int>, items: array<string>>"
_MATCH_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
        ("items", pa.list_(pa.string())),
    ]
)


def normalised(text: bytes) -> list[bytes]:
    """A-Z in lower case, cut into runs of letters, digits and characters beyond ASCII."""
    return text.translate(ALNUM_BYTES).split()


class Automaton:
    """A generalised suffix automaton over the words of the items, and which item a window is of."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            state = 0
            for word in words:
                state = self._extend(state, self.ids.setdefault(word, len(self.ids)))
        #: Of the state that owns a window: the items with it. Of that of a whole short item: (words, items).
        self.owners: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        shortest = window
        for item, words in items:
            if words and len(words) < window:
                shortest = min(shortest, len(words))
                state = self._owner([self.ids[w] for w in words])
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
            else:
                for state, matched, _ in self.stream([self.ids[w] for w in words]):
                    if matched >= window:
                        self.owners.setdefault(self._holding(state), set()).add(item)
        self.shortest = shortest

    def _extend(self, last: int, word: int) -> int:
        following, link, length = self.next, self.link, self.length
        known = following[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, known, word)
        state = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        while last >= 0 and word not in following[last]:
            following[last][word] = state
            last = link[last]
        if last >= 0:
            known = following[last][word]
            link[state] = known if length[known] == length[last] + 1 else self._split(last, known, word)
        return state

    def _split(self, last: int, known: int, word: int) -> int:
        state = len(self.next)
        self.next.append(dict(self.next[known]))
        self.link.append(self.link[known])
        self.length.append(self.length[last] + 1)
        self.link[known] = state
        while last >= 0 and self.next[last].get(word) == known:
            self.next[last][word] = state
            last = self.link[last]
        return state

    def _owner(self, run: list[int]) -> int:
        state = 0
        for word in run:
            state = self.next[state][word]
        return state

    def _holding(self, state: int) -> int:
        """The state of the last ``window`` words of what is matched in ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, run: list[int]):
        """After each word the state and length of the longest match that ends there."""
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        for place, word in enumerate(run):
            to = following[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(word)
            if to is None:
                continue
            state = to
            matched += 1
            yield state, matched, place

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit spans of words (start, end), merged and in order, and the items hit."""
        items: set[str] = set()
        spans: list[tuple[int, int]] = []
        if len(words) < self.shortest or not self.ids:
            return spans, items
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(ids >= 0, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        long_enough = ends - starts >= self.shortest
        for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            for state, matched, place in self.stream(ids[start:end].tolist()):
                longest = 0
                if matched >= self.window:
                    longest = self.window
                    items |= self.owners.get(self._holding(state), set())
                if self.short:
                    above = state
                    while above > 0:
                        for n, which in self.short.get(above, {}).items():
                            if n <= matched:
                                longest = max(longest, n)
                                items |= which
                        above = self.link[above]
                if longest:
                    last = start + place + 1
                    first = last - longest
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, last))
        return spans, items


def _segments(window: int, size: int = 4096):
    """Items as rows of at most ``size`` words; each overlaps the next one, so no window is cut."""

    def cut(batches):
        for batch in batches:
            out: list[tuple[str, bytes]] = []
            for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                words = normalised(text)
                step = size - window + 1
                for start in range(0, max(1, len(words) - window + 1), step):
                    if part := words[start : start + size]:
                        out.append((item or "", b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.binary()),
                    pa.array([x[2] for x in out], pa.int64()),
                ],
                ["item", "words", "n"],
            )

    return cut


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int):
    """The automata of the benchmark, one at a time; each is of about ``block_words`` words."""
    rows = benchmark.select(
        column(benchmark, item_col).cast("string").alias("item"), column(benchmark, text_col).cast("string").alias("text")
    )
    rows = table(
        rows.mapInArrow(tidy(_segments(window)), "item string, words binary, n bigint").distinct(), "benchmark-items"
    )
    total = rows.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).orderBy("item", "words").collect()
        yield Automaton([(row.item, bytes(row.words).split()) for row in part], window)


def _matcher(automaton):
    @F.arrow_udf(returnType=_MATCH)
    @tidy_batch
    def match(text: pa.Array, before: pa.Array) -> pa.Array:
        found = []
        for words, known in zip(map(normalised, text_bytes(text)), before, strict=True):
            spans, items = automaton.value.match(words)
            if known.is_valid:
                old = known.as_py()
                spans = _merged([*zip(old["starts"], old["ends"], strict=True), *spans])
                items = items.union(old["items"])
            found.append(
                {
                    "n_words": len(words),
                    "starts": [s for s, _ in spans],
                    "ends": [e for _, e in spans],
                    "items": sorted(items),
                }
            )
        return pa.array(found, _MATCH_ARROW)

    return match


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a column ``into``: n_words, and the starts, ends and items of the hit spans."""
    spark = docs.sparkSession
    before = unused(docs, f"{into}_before")
    out = docs.withColumn(into, F.lit(None).cast(_MATCH))
    for n, automaton in enumerate(_blocks(benchmark, item_col, item_text_col, window, block_words)):
        if n and n % BLOCKS_AT_ONCE == 0:
            out = table(out, "benchmark-matches")
        match = _matcher(spark.sparkContext.broadcast(automaton))
        out = out.withColumnRenamed(into, before)
        out = out.withColumn(into, match(column(out, text_col).cast("string"), F.col(f"`{before}`"))).drop(before)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and coverage (0 to 1)."""
    found = with_matches(texts(docs, id_col, text_col), benchmark, "found", **options)
    hit = F.aggregate(
        F.zip_with("found.ends", "found.starts", lambda e, s: (e - s).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return found.select("doc_id", "found", hit.alias("n_hit")).select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        "n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.when(F.col("found.n_words") > 0, F.col("n_hit") / F.col("found.n_words")).otherwise(0.0).alias("coverage"),
    )


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without these spans of its words; what stands between stays."""
    spaced = np.frombuffer(raw.translate(ALNUM_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(spaced, prepend=False, append=False))
    at = 0
    kept = []
    for s, e in spans:
        kept.append(raw[at : edges[2 * s]])
        at = int(edges[2 * e - 1])
    return b"".join([*kept, raw[at:]]).decode()


def _without_spans(text: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    out = []
    for value, first, last in zip(text, starts.to_pylist(), ends.to_pylist(), strict=True):
        out.append(_cut(value.as_py().encode(), list(zip(first, last, strict=True))) if first else value.as_py())
    return pa.array(out, pa.string())


def _cleaner(automaton, max_coverage: float, min_length: int):
    """Match and cut at once, for a benchmark that is one automaton; too contaminated texts are not kept."""

    @F.arrow_udf(returnType="struct<keep: boolean, text: string>")
    @tidy_batch
    def clean(text: pa.Array) -> pa.Array:
        keep, out = [], []
        for value in text:
            raw = (value.as_py() or "").encode()
            words = normalised(raw)
            spans, _ = automaton.value.match(words)
            keep.append(sum(e - s for s, e in spans) <= max_coverage * len(words))
            spans = [(s, e) for s, e in spans if e - s >= min_length]
            out.append(_cut(raw, spans) if spans and keep[-1] else value.as_py())
        return pa.StructArray.from_arrays([pa.array(keep, pa.bool_()), pa.array(out, pa.string())], ["keep", "text"])

    # Called so that Spark does not compute it once more for the filter.
    return clean.asNondeterministic()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", max_coverage: float = 0.5, min_length: int = 1, **options
) -> DataFrame:
    """The documents without benchmark passages, in all their columns.

    A document of whose words more than ``max_coverage`` are hit goes; of the others every hit
    span of at least ``min_length`` words is cut out of the text, what stands between stays.
    """
    into = unused(docs, "found")
    given = {"item_col": "item_id", "item_text_col": "text", "window": WINDOW, "block_words": BLOCK_WORDS} | options
    automata = _blocks(benchmark, *given.values())
    first, second = next(automata), next(automata, None)
    if second is None:
        clean = _cleaner(docs.sparkSession.sparkContext.broadcast(first), max_coverage, min_length)
        found = docs.withColumn(into, clean(column(docs, text_col).cast("string"))).where(F.col(f"`{into}`.keep"))
        return found.withColumn(text_col, F.col(f"`{into}`.text")).select(*[column_ref(c) for c in docs.columns])
    found = with_matches(docs, benchmark, into, text_col=text_col, **options)
    starts, ends = F.col(f"`{into}`.starts"), F.col(f"`{into}`.ends")
    hit = F.aggregate(F.zip_with(ends, starts, lambda e, s: e - s), F.lit(0), lambda a, x: a + x)
    spans = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda x: x["e"] - x["s"] >= min_length)
    found = found.where(hit <= max_coverage * F.col(f"`{into}`.n_words"))
    cut = unused(found, "cut")
    found = found.withColumn(cut, spans)
    text = column(found, text_col)
    cleaned = F.when(F.size(F.col(f"`{cut}`")) > 0, F.arrow_udf(tidy_batch(_without_spans), "string")(text, F.col(f"`{cut}`.s"), F.col(f"`{cut}`.e"))).otherwise(text)
    return found.withColumn(text_col, cleaned).select(*[column_ref(c) for c in docs.columns])


def column_ref(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def items_digest(items: list[str]) -> str:
    """The digest that :func:`contamination` gives for these items."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
