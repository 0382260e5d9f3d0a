"""Toxicity of texts, scored after a noisy-channel deobfuscation.

*Channel.* What is written may be a disguise: letters as digits or signs (``1d10t``), letters apart
(``i d i o t``, ``i.d.i.o.t``), letters repeated (``idiooot``). Suspicious tokens are found by array
operations over whole texts: those with a letter and a sign, wherever it stands, with a letter three
times, and three or more letters or signs apart. Each becomes a lattice: a sign may stand for its
letters, for itself or for nothing, a letter of a run of three or more may be left out. Three letters
apart, or some with signs, are put together if that is likelier than that they stand for themselves.
Exclamation marks at the end are likely to be just that.

*Language model.* Trigrams of characters, counted over all texts that are not held out.

*Decoding.* Viterbi's best path under both costs; plain tokens stay as they are.

*Score.* The restored text's distinct byte 5-grams, word ends included, go into a logistic
regression. It is fitted on at most ``FIT_ROWS`` labels that are not held out, those whose ids hash
smallest, on the ``FEATURES`` bins that tell the classes apart best.

Defined results: a null or empty text has no features and gets the model's prior; without labels
of both classes every score is the share of toxic labels (0.5 without labels); repeated rows and null
ids each get their row, a null id is learned from; other columns are not read; without documents
there are no rows. Texts are handled whole; a token of any length is decoded in time proportional to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, crc_mod, table, texts
from rowsieve.llm.memory import tidy, tidy_batch
from rowsieve.llm.ordinal import Sparse, fit, labelled_sample, logistic
from rowsieve.llm.words import LOWER_BYTES, chunks, text_bytes

HELD_OUT = 5
FIT_ROWS = 12_000
FEATURES = 8192
BITS = 18
CHUNK_BYTES = 1 << 20

#: Letters that a sign can stand for, fixed values.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
APART = " .-_*"
#: Costs, as natural logarithms of probabilities: a sign for a letter, kept, left out; a repeated letter left out, kept.
AS_LETTER, AS_ITSELF, LEFT_OUT, ONCE_MORE_OUT, ONCE_MORE = -1.0, -6.0, -12.0, -0.5, -2.0
#: That of an exclamation mark at the end, kept.
AT_END = -0.5

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET]] = True
_PART = _LETTER | _SIGN
_PART[48:58] = True
_APART = np.zeros(256, bool)
_APART[[ord(c) for c in APART]] = True
#: Symbols of the language model: 0 for whatever ends a word, then the letters, then bytes beyond ASCII.
SYMBOLS = 64
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128) % 37


def suspicious(text: bytes) -> list[tuple[int, int]]:
    """Spans of a lower-case text that may be disguised words, in order and apart."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) < 2:
        return []
    edges = np.flatnonzero(np.diff(_PART[raw].astype(np.int8), prepend=0, append=0))
    start, end = edges[::2], edges[1::2]

    def has(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[end] > total[start]

    letters, signs = has(_LETTER[raw]), has(_SIGN[raw])
    same = np.zeros(len(raw), bool)
    same[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & _LETTER[raw[2:]] & (raw[2:] < 128)
    found = letters & signs | has(same)
    spans = np.stack([start[found], end[found]], axis=1)
    # Single letters or signs with one byte between: chains of three or more, one of them a letter at least.
    single = (end - start == 1) & (letters | signs)
    single[single] &= raw[start[single]] < 128
    linked = single[:-1] & single[1:] & (start[1:] - end[:-1] == 1) & _APART[raw[np.minimum(end[:-1], len(raw) - 1)]]
    if linked.any():
        edges = np.flatnonzero(np.diff(linked.astype(np.int8), prepend=0, append=0))
        first, last = edges[::2], edges[1::2]
        total = np.concatenate([[0], np.cumsum(letters)])
        kept = (last - first >= 2) & (total[last + 1] > total[first])
        spans = np.concatenate([spans, np.stack([start[first[kept]], end[last[kept]]], axis=1)])
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
    return [(a, b) for a, b in spans.tolist()]


class Decoder:
    """Restores disguised words; ``trigrams`` are log probabilities of a symbol after two others."""

    def __init__(self, trigrams: np.ndarray):
        self.trigrams = trigrams.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        self.known: dict[bytes, bytes] = {}

    def text(self, text: bytes) -> bytes:
        """The text in lower case, its disguised words restored."""
        text = text.translate(LOWER_BYTES)
        at, out = 0, []
        for start, end in suspicious(text):
            token = text[start:end]
            word = self.known.get(token)
            if word is None:
                word = self.decode(token)
                if len(token) <= 64:
                    if len(self.known) >= 100_000:
                        self.known.clear()
                    self.known[token] = word
            out += [text[at:start], word]
            at = end
        return b"".join([*out, text[at:]]) if out else text

    def decode(self, token: bytes) -> bytes:
        """The best path through the token's lattice, as text."""
        runs = [0] * len(token)  # of each place the length of its run of equal letters
        start = 0
        for i in range(1, len(token) + 1):
            if i == len(token) or token[i] != token[start]:
                runs[start:i] = [i - start] * (i - start)
                start = i
        ends = len(token.rstrip(b"!"))
        # Of each pair of last symbols the best cost and the way there: (way before, byte).
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i, byte in enumerate(token):
            follows = runs[i] >= 3 and i and token[i - 1] == byte
            now: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            letters = LEET.get(chr(byte), "")
            for (x, y), (cost, way) in best.items():
                options: list[tuple[float, int | None]] = []
                if letters:
                    options = [(AS_LETTER, ord(c)) for c in letters] + [(AT_END if i >= ends else AS_ITSELF, byte)]
                    if 0 < i < len(token) - 1:
                        options.append((LEFT_OUT, None))
                elif _APART[byte]:
                    options = [(0.0, None)]
                elif follows:
                    options = [(ONCE_MORE, byte), (ONCE_MORE_OUT, None)]
                else:
                    options = [(0.0, byte)]
                for extra, out in options:
                    if out is None:
                        key, total, to = (x, y), cost + extra, way
                    else:
                        z = int(_SYMBOL[out])
                        # Digits behind digits and exclamation marks at the end do not end a word again.
                        again = not (y or z) and i and (i > ends or 48 <= token[i - 1] <= 57 and 48 <= byte <= 57)
                        seen = 0.0 if again else self.trigrams[x, y, z]
                        key, total, to = (y if z else 0, z), cost + extra + seen, (way, out)
                    if key not in now or total > now[key][0]:
                        now[key] = (total, to)
            best = now
        over = ends < len(token)
        most, way = max(((cost + (0.0 if over and not y else self.trigrams[x, y, 0]), way) for (x, y), (cost, way) in best.items()), key=lambda e: e[0])
        if any(_APART[b] for b in token):
            letters = [int(_SYMBOL[b]) for b in token[::2] if _LETTER[b]]
            if len(letters) < 4 or 2 * len(letters) < len(token):
                if sum(self.trigrams[0, 0, z] + self.trigrams[0, z, 0] for z in letters) >= most:
                    return token
        out = bytearray()
        while way is not None:
            way, byte = way
            out.append(byte)
        return bytes(reversed(out))


def _counts(batches):
    """Trigrams of symbols of the texts of a task, as one row of counts."""
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
            raw = b" ".join([b"", *text_bytes(part.column("text")), b""]).translate(LOWER_BYTES)
            s = _SYMBOL[np.frombuffer(raw, np.uint8)]
            s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]  # one end of a word at a time
            if len(s) > 2:
                y, z = s[:-1], s[1:]
                x = np.concatenate([[0], s[:-2]])
                x = np.where(y == 0, 0, x)  # nothing of the word before
                total += np.bincount((x * SYMBOLS + y) * SYMBOLS + z, minlength=SYMBOLS**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of character trigrams over all texts of ``docs`` (a table of fixed size)."""
    counted = docs.select("text").mapInArrow(tidy(_counts), "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most SYMBOLS ** 3 rows
    n = np.zeros(SYMBOLS**3)
    n[rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = n.sum(axis=0)
    single = pair.sum(axis=0) + 1
    by_one = (pair + 5 * (single / single.sum())) / (pair.sum(axis=1, keepdims=True) + 5)
    return np.log((n + 5 * by_one[None]) / (n.sum(axis=2, keepdims=True) + 5)).astype(np.float32).ravel()


_WORDS = bytes(b if _LETTER[b] else 32 for b in range(256))


def _bins(restored: bytes) -> np.ndarray:
    """Bins of the distinct 5-grams of a restored text."""
    raw = np.frombuffer(b" " + b" ".join(restored.translate(_WORDS).split()) + b" ", np.uint8).astype(np.uint64)
    if len(raw) < 5:
        return np.zeros(0, np.uint32)
    code = raw[:-4] | raw[1:-3] << np.uint64(8) | raw[2:-2] << np.uint64(16) | raw[3:-1] << np.uint64(24) | raw[4:] << np.uint64(32)
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.uint32)


def _binned(held):
    def binned(batches):
        decoder = Decoder(held.value)
        for batch in batches:
            for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
                bins = [np.unique(_bins(decoder.text(t))).astype("<u4").tobytes() for t in text_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), part.column("grade")], ["bins", "grade"])

    return binned


def _frequencies(batches):
    """How many texts of either class have each bin: one row for a task."""
    n = np.zeros((2, 1 << BITS), "<u4")
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for raw, grade in zip(batch.column("bins"), batch.column("grade").to_pylist(), strict=True):
            n[grade][np.frombuffer(raw.as_buffer(), "<u4")] += 1
            rows[grade] += 1
    yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary()), pa.array([rows.tolist()], pa.list_(pa.int64()))], ["n", "rows"])


def _chosen(places: np.ndarray):
    def chosen(batches):
        for batch in batches:
            kept = []
            for raw in batch.column("bins"):
                at = places[np.frombuffer(raw.as_buffer(), "<u4")]
                kept.append(at[at >= 0].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), batch.column("grade")], ["bins", "grade"])

    return chosen


class Model:
    def __init__(self, trigrams: np.ndarray, weights: np.ndarray, bias: float):
        self.trigrams, self.weights, self.bias = trigrams, weights, bias

    def scores(self, texts: list[bytes], decoder: Decoder) -> np.ndarray:
        latent = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            bins = _bins(decoder.text(text))
            bins = np.unique(bins[self.weights[bins] != 0])
            latent[i] += self.weights[bins].sum()
        return logistic(latent)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """A model learned from the rows that are not held out (crc32 of the id modulo ``HELD_OUT`` is not 0)."""
    spark = docs.sparkSession
    plain = texts(docs, id_col, text_col)
    trigrams = language_model(plain.where(crc_mod("doc_id", HELD_OUT) != 0))
    known = labels.select(column(labels, id_col).alias("doc_id"), column(labels, label_col).alias("toxic"))
    known = known.where((crc_mod("doc_id", HELD_OUT) != 0) & F.col("toxic").isin(0, 1))
    sample = labelled_sample(plain, known, F.col("toxic"), fit_rows, id_col="doc_id", text_col="text")
    rows = table(sample.mapInArrow(tidy(_binned(spark.sparkContext.broadcast(trigrams))), "bins binary, grade int").coalesce(8), "toxicity-features")
    n = np.zeros((2, 1 << BITS))
    of_class = np.zeros(2)
    for r in rows.mapInArrow(tidy(_frequencies), "n binary, rows array<bigint>").collect():  # a row for each of 8 tasks at most
        n += np.frombuffer(r.n, "<u4").reshape(2, -1)
        of_class += r["rows"]
    rate = (n + 0.5) / (of_class[:, None] + 1)
    telling = np.abs(np.log(rate[1] / rate[0])) * np.sqrt(n[0] + n[1]) * (n[0] + n[1] >= 3)
    picked = np.sort(np.argsort(-telling, kind="stable")[:FEATURES])
    places = np.full(1 << BITS, -1, np.int32)
    places[picked] = np.arange(len(picked))
    found = rows.mapInArrow(tidy(_chosen(places)), "bins binary, grade int").collect()
    found.sort(key=lambda r: (bytes(r.bins), r.grade))
    bins = [np.frombuffer(r.bins, "<u2") for r in found]
    x = Sparse(bins, [np.ones(len(b)) for b in bins], len(picked))
    w, threshold = fit(x, np.array([r.grade for r in found], np.int64), 2, l2=1e-4)
    weights = np.zeros(1 << BITS, np.float32)
    weights[picked] = w
    return Model(trigrams, weights, -float(threshold[0]))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    decoders: list[Decoder] = []

    def scores(text: pa.Array) -> pa.Array:
        model = held.value
        if not decoders:
            decoders.append(Decoder(model.trigrams))
        return pa.array(model.scores(text_bytes(text), decoders[0]))

    plain = texts(docs, id_col, text_col)
    found = plain.select("doc_id", F.arrow_udf(tidy_batch(scores), "double")("text").alias("score"))
    return found.select(
        "doc_id",
        (crc_mod("doc_id", HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
