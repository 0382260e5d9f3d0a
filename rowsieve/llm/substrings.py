"""Removal of passages that occur more than once, by seed and extend.

1. *Seeds.* Winnowing picks anchors: of every window of words the rightmost smallest hash of its
   runs of ``ANCHOR`` words. Two equal windows have the same anchor at the same place, so a
   passage of a window's length that repeats always shares an anchor. Anchors are brought
   together by hash; those that occur once are done with.
2. *Extension.* Around a seed, every window of ``window`` words whose own anchor it is
   reaches as far to both sides as a repeat through this seed can. Each is compared with all
   others by 96 bits of hash. The windows that occur again are, merged, the maximal repeats.
3. The words of all repeats go.

Copies and frequent passages do not pile up in one task: a task keeps one row of each anchor or
window that it sees more than once, marked as known to repeat, and sends the other occurrences
on by document. So the most frequent one counts a row for each batch of texts, not for each place.
Texts that are equal are handled as one text that occurs several times.

Windows are judged on the input, not on what is left. Defined results: a null text has no words;
texts shorter than the window lose nothing; a repeated row is a copy, even of a null id; other
columns are left alone whatever their names; without documents there are no rows. A text of any length
is one row and is handled whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, texts, unused
from rowsieve.llm.memory import tidy, tidy_batch
from rowsieve.llm.words import Words, chunks, lookup, mixed, text_bytes

WINDOW = 35
ANCHOR = 8
#: Text bytes hashed at once, and occurrences that a task brings together before it sends rows on.
CHUNK_BYTES = 1 << 20
GATHER_ROWS = 1 << 20

_OCCURRENCE = "route bigint, check int, known boolean, t1 bigint, t2 int, start int, n int"


def text_key(text: Column) -> list[Column]:
    """96 bits that tell texts apart; never null."""
    return [F.xxhash64(text), F.coalesce(F.octet_length(text), F.lit(0))]


def winnow(words: Words, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """For each place where a window may start, the place of its anchor."""
    value = words.runs(anchor)
    n = window - anchor + 1
    if len(value) < n:
        return np.zeros(0, np.int64)
    place = np.arange(len(value))
    size = 1
    while 2 * size <= n:
        value, place = _smaller(value, place, size)
        size *= 2
    if size < n:
        value, place = _smaller(value, place, n - size)
    return place


def _smaller(value: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = value[:-step], value[step:]
    use = right <= left
    return np.where(use, right, left), np.where(use, place[step:], place[:-step])


class _Gatherer:
    """Occurrences of keys in the texts of a task; sends each key on once and what repeats by text."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0
        self.seen: set[tuple[int, int]] = set()

    def new(self, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
        """Which texts this gatherer has not had yet."""
        fresh = np.zeros(len(t1), bool)
        for i, key in enumerate(zip(t1.tolist(), t2.tolist(), strict=True)):
            if key not in self.seen:
                self.seen.add(key)
                fresh[i] = True
        return fresh

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def rows(self) -> pa.RecordBatch | None:
        if not self.size:
            self.seen.clear()
            return None
        route, check, t1, t2, start = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        self.seen.clear()
        order = np.lexsort((check, route))
        route, check, t1, t2, start = (x[order] for x in (route, check, t1, t2, start))
        same = (route[1:] == route[:-1]) & (check[1:] == check[:-1])
        first = np.concatenate([[True], ~same])
        repeated = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        # The first one stands for its key. The others are known repeats: sent on as runs of places of a text.
        other = np.flatnonzero(~first)
        other = other[np.lexsort((start[other], t2[other], t1[other]))]
        o1, o2, os = t1[other], t2[other], start[other]
        begins = np.ones(len(other), bool)
        begins[1:] = (o1[1:] != o1[:-1]) | (o2[1:] != o2[:-1]) | (os[1:] != os[:-1] + 1)
        at = np.flatnonzero(begins)
        n = np.diff(np.append(at, len(other)))
        away = mixed(o1[at].view(np.uint64) ^ mixed(os[at].astype(np.uint64))).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([route[first].view(np.int64), away])),
                pa.array(np.concatenate([check[first].view(np.int32), np.zeros(len(at), np.int32)])),
                pa.array(np.concatenate([repeated[first], np.ones(len(at), bool)])),
                pa.array(np.concatenate([t1[first], o1[at]])),
                pa.array(np.concatenate([t2[first], o2[at]])),
                pa.array(np.concatenate([start[first], os[at]]).astype(np.int32)),
                pa.array(np.concatenate([np.ones(first.sum(), np.int64), n]).astype(np.int32)),
            ],
            ["route", "check", "known", "t1", "t2", "start", "n"],
        )


def _fresh(batch: pa.RecordBatch, gather: _Gatherer) -> pa.RecordBatch:
    t1, t2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("t1", "t2"))
    return batch.filter(pa.array(gather.new(t1, t2)))


def _anchors(window: int, anchor: int):
    """Occurrences of anchors in the texts."""

    def find(batches):
        gather = _Gatherer()
        for batch in batches:
            for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
                part = _fresh(part, gather)
                words = Words(part.column("text"))
                windows = words.whole(window)
                picked = np.unique(winnow(words, window, anchor)[windows])
                doc = words.doc[picked]
                t1, t2 = (part.column(k).to_numpy(zero_copy_only=False)[doc] for k in ("t1", "t2"))
                value = words.runs(anchor)[picked]
                gather.add(value, np.zeros(len(picked), np.uint32), t1, t2, picked - words.first[doc])
                if gather.size >= GATHER_ROWS and (rows := gather.rows()):
                    yield rows
        if rows := gather.rows():
            yield rows

    return find


def _windows(window: int, anchor: int):
    """Occurrences of windows whose anchor is among the seeds."""

    def find(batches):
        gather = _Gatherer()
        for batch in batches:
            for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
                part = _fresh(part, gather)
                words = Words(part.column("text"))
                runs = part.column("seeds")
                start, n = _unpacked(runs.flatten().to_numpy(zero_copy_only=False))
                start = start + np.repeat(words.first[:-1], pc.list_value_length(runs).to_numpy(zero_copy_only=False))
                before = np.cumsum(n) - n
                seeds = np.unique(np.repeat(start - before, n) + np.arange(n.sum()))
                places = winnow(words, window, anchor)
                picked = np.flatnonzero(words.whole(window) & lookup(places, seeds)) if len(places) else places
                doc = words.doc[picked]
                t1, t2 = (part.column(k).to_numpy(zero_copy_only=False)[doc] for k in ("t1", "t2"))
                check = (words.runs(window, 1)[picked] >> np.uint64(32)).astype(np.uint32)
                gather.add(words.runs(window)[picked], check, t1, t2, picked - words.first[doc])
                if gather.size >= GATHER_ROWS and (rows := gather.rows()):
                    yield rows
        if rows := gather.rows():
            yield rows

    return find


def _repeated(occurrences: DataFrame, into: str) -> DataFrame:
    """For each text the runs of places whose key occurs at another place too."""
    here = F.xxhash64("t1", "t2", "start")
    key = W.partitionBy("route", "check")
    again = occurrences.select(
        "t1", "t2", "start", "n", "known", F.min(here).over(key).alias("least"), F.max(here).over(key).alias("most"),
        F.max("known").over(key).alias("anywhere"),
    ).where(F.col("anywhere") | (F.col("least") != F.col("most")))
    packed = F.shiftleft(F.col("start").cast("bigint"), 32) + F.col("n")
    return again.groupBy("t1", "t2").agg(F.collect_set(packed).alias(into))


def _unpacked(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of the places of each run."""
    return runs >> 32, runs & 0xFFFFFFFF


def repeats(docs: DataFrame, key: list[str], text: str, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Rows t1, t2, spans (runs of first places of repeated windows) for the texts that have some.

    ``key`` names the two columns of :func:`text_key`. The second scan takes the documents as they
    are, with all columns, so that Spark shuffles them once for this join and for the caller's.
    """
    if window < anchor:
        raise ValueError("a window has an anchor's words at least")
    plain = docs.select(F.col(key[0]).alias("t1"), F.col(key[1]).alias("t2"), column(docs, text).cast("string").alias("text"))
    seeds = _repeated(plain.mapInArrow(tidy(_anchors(window, anchor)), _OCCURRENCE), "seeds")
    into = unused(docs, "seeds")
    seeded = docs.join(seeds.select(F.col("t1").alias(key[0]), F.col("t2").alias(key[1]), F.col("seeds").alias(into)), key)
    names = [*key, text, into]
    places = [seeded.columns.index(n) for n in names]
    if any("." in c or "`" in c for c in seeded.columns):  # mapInArrow takes columns by names without quotes
        seeded = seeded.toDF(*[f"c{i}" for i in range(len(seeded.columns))])

    def renamed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places], ["t1", "t2", "text", "seeds"])

    find = _windows(window, anchor)
    return _repeated(seeded.mapInArrow(tidy(lambda batches: find(renamed(batches))), _OCCURRENCE), "spans")


def _kept(n: int, window: int, copies: int, spans: np.ndarray) -> np.ndarray:
    """Which of a text's n words stay; spans: runs of first places of repeated windows."""
    if n >= window and copies > 1:
        return np.zeros(n, bool)
    change = np.zeros(n + 1, np.int64)
    start, places = _unpacked(spans)
    np.add.at(change, start, 1)
    np.add.at(change, np.minimum(n, start + places - 1 + window), -1)
    return np.cumsum(change[:n]) == 0


def _spans(column: pa.Array) -> list[np.ndarray]:
    """Of each row its runs."""
    ends = np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, ends[:-1]) if len(ends) else []


def with_spans(docs: DataFrame, into: str, *, text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with a column ``into``: how many copies the text has, and the runs of repeated windows."""
    key = [unused(docs, x) for x in ("t1", "t2")]
    keyed = docs.withColumns(dict(zip(key, text_key(column(docs, text_col).cast("string")), strict=True)))
    found = repeats(keyed, key, text_col, window=window, anchor=anchor)
    copies = keyed.groupBy(F.col(key[0]).alias("t1"), F.col(key[1]).alias("t2")).agg(F.count("*").alias("copies"))
    found = copies.where((F.col("copies") > 1) & (F.col("t2") >= 2 * window - 1)).join(found, ["t1", "t2"], "full_outer")
    found = found.select(
        F.col("t1").alias(key[0]), F.col("t2").alias(key[1]),
        F.struct(F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("spans", F.array().cast("array<bigint>")).alias("spans")).alias(into),
    )
    return keyed.join(found, key, "left").drop(*key)


def _digests(window: int):
    @F.arrow_udf(returnType="struct<n_words: bigint, n_removed: bigint, kept_sha256: string>")
    @tidy_batch
    def digest(text: pa.Array, copies: pa.Array, spans: pa.Array) -> pa.Array:
        n_words, n_removed, sha = [], [], []
        for raw, c, s in zip(text_bytes(text), copies.to_pylist(), _spans(spans), strict=True):
            words = raw.split()
            n_words.append(len(words))
            if c is not None:
                words = [words[i] for i in np.flatnonzero(_kept(len(words), window, c, s))]
            n_removed.append(n_words[-1] - len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
            ["n_words", "n_removed", "kept_sha256"],
        )

    return digest


def removal_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_removed, and the digest of the kept words joined by one space."""
    found = with_spans(texts(docs, id_col, text_col), "found", window=window)
    out = found.select("doc_id", _digests(window)("text", "found.copies", "found.spans").alias("r"))
    return out.select("doc_id", "r.n_words", "r.n_removed", "r.kept_sha256")


def _cutter(window: int):
    @F.arrow_udf(returnType="string")
    @tidy_batch
    def cut(text: pa.Array, copies: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for raw, c, s in zip(text_bytes(text), copies.to_pylist(), _spans(spans), strict=True):
            if c is None:
                out.append(raw.decode())
                continue
            words = Words(pa.array([raw]))
            keep = _kept(len(words.start), window, c, s)
            edges = np.diff(keep.astype(np.int8), prepend=0, append=0)
            # White space before a removed passage goes with it; what stands before the first word stays.
            pieces = [
                raw[0 if first == 0 else words.end[first - 1] : len(raw) if last == len(keep) else words.end[last - 1]]
                for first, last in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
            ]
            out.append(b"".join(pieces).decode())
        return pa.array(out, pa.string())

    return cut


def remove_repeats(docs: DataFrame, *, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents, in all their columns, without the words of repeated passages.

    White space between kept words stays as it is. A text without any kept word becomes empty.
    """
    into = unused(docs, "found")
    found = with_spans(docs, into, text_col=text_col, window=window)
    text = column(found, text_col)
    left = F.when(F.col(f"`{into}`").isNull(), text).otherwise(
        _cutter(window)(text, F.col(f"`{into}`.copies"), F.col(f"`{into}`.spans"))
    )
    return found.withColumn(text_col, left).select(*["`" + c.replace("`", "``") + "`" for c in docs.columns])
