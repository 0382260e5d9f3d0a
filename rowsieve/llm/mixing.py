"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is scored as its tokens, one after another: words in lower case, then an end. A token is
predicted bit by bit, its bytes first and then a closing space (the end is the space alone).

*Predictors.* For each context (the last 1, 2, 3, 4, 6 bytes of the token, and all of them) zeros and
ones are counted that followed it in the training texts. Contexts of one and two bytes have a place
each in a table of fixed size; longer ones are known by 56 bits of hash and counted in a keyed table
that grows with them, so that no context takes another one's counts and a new one is known as new.
*Mixing.* The predictions, stretched to the logistic domain, are added with weights that a gate
selects: the longest context seen before, how often, and where in the token. Weights are learned
online over the training tokens, each predicted as if it had not been counted itself.
*Refinement.* Half of a token's probability is the mixed one, half its exact share of the training
tokens, a context that needs no hashing. The token before is a context too: how often it was followed
by this token in the training texts is mixed in, with weights by how often the token before was seen
that are learned in text order; a training text is predicted as if the pair had not been counted there
itself. Within each text all adapt: what followed the last time
after the same one or three tokens is predicted with a trust that grows and falls with how often
that held in this text, and tokens of the text so far are expected again.

Every step is a proper distribution, so scores are log probabilities and bits per byte follow.

*Spark.* Tokens are counted once over all texts; the counts are a table that grows with the corpus.
Counts and weights are made from it, of each token once however frequent it is; each distinct token
is scored once. Tokens are dealt to lots of about ``LOT_BYTES``; those of a lot that begin alike share
what predicts their bytes. A lot asks for its distinct (context, byte) pairs, sorted and cut into
shares of hashes; a share adds up what all lots have sent it and answers each in the order it has asked
in. Texts are dealt to chunks of about ``CHUNK_TOKENS``. A chunk asks, as lots do, for the scores of its
distinct tokens, known by 64 bits of hash, and the counts of its distinct pairs of tokens, known by 56.
No table that grows with the input is broadcast or collected.

Defined results: a null or empty text is the end alone; repeated rows and null ids each get their
row; other columns are not read; without training texts every context is empty, which gives each
bit a half. Texts are handled whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm.frames import crc_mod, placed_table, table, texts
from rowsieve.llm.memory import let_go, tidy, tidy_cogroup, tidy_group
from rowsieve.llm.words import Words, chunks, mixed, powers
from rowsieve.session import session_conf
from rowsieve.sources.files import remove

HELD_OUT = (7, 2)
#: Bytes of context (0: all of the token), and the bits of a table's address (0: counted by hash).
ORDERS = ((1, 16), (2, 24), (3, 0), (4, 0), (6, 0), (0, 0))
#: Bytes of tokens, ends included, that are asked for at once, and (context, byte) pairs of a share.
LOT_BYTES, SHARE_PAIRS = 1_000_000, 1_500_000
BLOCK = 1 << 16
#: Tokens of the training texts that one task counts contexts of, and at most so many tasks.
TOKENS_A_TASK, MOST_TASKS = 500_000, 64
#: Distinct tokens that a task counts before it sends counts on, and those handled at once as arrays.
GATHER_TOKENS, BATCH_TOKENS = 400_000, 20_000
#: Bytes of tokens at which counts are sent on, however few tokens they are.
GATHER_BYTES = 1 << 26
CHUNK_TOKENS = 3_000_000
TEXT_BYTES = 1 << 20
#: Texts that Spark holds and sends at once while tokens are counted.
TEXTS_A_BATCH = 200
RATE, STEP_BYTES = 0.05, 16384
#: Shares of the exact count in a token's probability, and of the text so far.
WHOLE, CACHE = 0.5, 0.1
#: For so many last tokens: trust at first, and how many observations that is worth.
TRUST = {1: (0.02, 2.0), 3: (0.7, 2.0)}
#: How often a token must have been seen for its followers to weigh half at first, and observations that this is worth.
HALF, PAIR_WORTH = 1000.0, 20.0
#: What stands before a text's first token.
_OPENS = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15
_ODD = mixed(np.arange(1, 2 * len(ORDERS) + 1, dtype=np.uint64)) | np.uint64(1)
_SIZES = [1 << bits for _, bits in ORDERS if bits]
_STARTS = np.cumsum([0, *_SIZES])


def _count_codes() -> np.ndarray:
    """What a code stands for: itself below 64, then eight steps to a doubling."""
    code = np.arange(256)
    return np.where(code < 64, code, 64 * 2.0 ** ((code - 64) / 8))


COUNTS = _count_codes()


def coded(n: np.ndarray) -> np.ndarray:
    high = 64 + np.floor(8 * np.log2(np.maximum(n, 64) / 64) + 0.5)
    return np.where(n < 64, n, np.minimum(high, 255)).astype(np.uint16)


def coded_pair(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of zeros and ones; of counts beyond the last code both are scaled down, which keeps their ratio."""
    scale = np.minimum(1.0, COUNTS[255] / np.maximum(np.maximum(zeros, ones), 1))
    return tuple(coded(np.where(n > 0, np.maximum(n * scale, 1), 0)) for n in (zeros, ones))


#: For a pair of codes (of zeros, shifted by 8, and ones): the stretched probability of a one, and the count.
_ZEROS, _ONES = COUNTS[np.arange(1 << 16) >> 8], COUNTS[np.arange(1 << 16) & 255]
STRETCHED = np.log((_ONES + 0.4) / (_ZEROS + 0.4)).astype(np.float32)
_SEEN = _ZEROS + _ONES
#: How often a context was seen, in steps.
_STEPS = (1, 2, 3, 5, 9, 17, 33, 129, 1025, 8193)
LEVEL = np.searchsorted(_STEPS, _SEEN, side="right")
#: Of each order the gate that a code asks for; a longer context seen before goes first.
GATE = np.stack([np.where(LEVEL > 0, len(_STEPS) * k + LEVEL, 0) for k in range(len(ORDERS))]).astype(np.int16)
#: The code without one zero, then without one one; counts above 63 are steps, which one less does not change.
_PAIR = np.arange(1 << 16)
WITHOUT = np.concatenate(
    [
        np.where((_PAIR >> 8 > 0) & (_PAIR >> 8 < 64), _PAIR - 256, _PAIR),
        np.where((_PAIR & 255 > 0) & (_PAIR & 255 < 64), _PAIR - 1, _PAIR),
    ]
).astype(np.uint16)
KEYED = len(ORDERS) - len(_SIZES)
GATES = (1 + len(_STEPS) * len(ORDERS)) * 3
INPUTS = len(ORDERS) + 1


class Contexts:
    """The bytes of tokens, and of each byte and order a hash of what stands before it in the token."""

    def __init__(self, tokens: list[bytes]):
        self._bytes_of(tokens)
        self._hash(self.bytes, np.arange(len(self.bytes)), self._whole())

    def _bytes_of(self, tokens: list[bytes]) -> None:
        self.bytes = np.frombuffer(b"".join(t + b" " for t in tokens), np.uint8)
        sizes = np.array([len(t) + 1 for t in tokens], np.int64)
        ends = np.cumsum(sizes)
        self.token = np.repeat(np.arange(len(tokens)), sizes)
        self.at = np.arange(len(self.bytes)) - np.repeat(ends - sizes, sizes)

    def _whole(self) -> np.ndarray:
        """Of each byte a hash of all that stands before it in the token."""
        n = len(self.bytes)
        start = np.arange(n) - self.at
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n + 1)[:n], out=total[1:])
        back_to = powers(pow(_BASE, -1, 1 << 64), n + 1)
        return mixed((total[:n] - total[start]) * back_to[start] + self.at.astype(np.uint64))

    def _hash(self, text: np.ndarray, places: np.ndarray, whole: np.ndarray) -> None:
        """Hashes for the bytes at some places of the text; ``at`` and ``whole`` are theirs."""
        #: At the first byte, at the next two, or later.
        self.where = np.minimum((self.at + 1) // 2, 2)
        self.hashes = []
        code = np.zeros(len(places), np.uint64)
        for back in range(1, 7):
            before = np.where(self.at >= back, text[np.maximum(places - back, 0)], 0).astype(np.uint64)
            code = code | (before << np.uint64(8 * (back - 1)))
            if back in [order for order, _ in ORDERS]:
                self.hashes.append(code)
        self.hashes.append(whole)

    def slots(self, bit: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Of each order with a table the slot of every byte's bit, and the bit; slots need no hash."""
        node = ((1 << bit) | (self.bytes.astype(np.uint64) >> np.uint64(8 - bit))).astype(np.uint64)
        slots = [((hashed << np.uint64(8)) | node).astype(np.int64) for hashed, (_, bits) in zip(self.hashes, ORDERS, strict=False) if bits]
        return slots, (self.bytes >> (7 - bit)) & 1

    def grouped(self, n: np.ndarray) -> tuple[Contexts, np.ndarray]:
        """Bytes that no table tells apart as one, and how often they occur in tokens that occur ``n`` times."""
        tables = len(_SIZES)
        key, places, of = np.unique((self.hashes[tables - 1] << np.uint64(8)) | self.bytes, return_index=True, return_inverse=True)
        out = Contexts([])
        out.bytes, out.hashes = self.bytes[places], [hashed[places] for hashed in self.hashes[:tables]]
        return out, np.bincount(of, n.astype(np.float64)[self.token], len(key))

    def pairs(self) -> np.ndarray:
        """Of each order without a table (a row each) the context's hash before every byte, its last 8 bits replaced by the byte.

        A context that the token's beginning cuts short is the whole token so far.
        """
        whole = mixed(self.hashes[-1])
        out = np.empty((KEYED, len(whole)), np.uint64)
        for row, k in zip(out, range(len(_SIZES), len(ORDERS)), strict=True):
            order = ORDERS[k][0]
            row[:] = np.where(self.at >= order, mixed(self.hashes[k] * _ODD[k] + _ODD[len(ORDERS) + k]), whole) if order else whole
        return (out & ~np.uint64(255)) | self.bytes


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct hash, and of every hash the number of its one."""
    n = len(hashes)
    bits = np.uint64(max(1, n.bit_length()))
    # Sorting places behind the hash's first bits is much faster than sorting places by hash.
    order = (np.sort((hashes >> bits << bits) | np.arange(n, dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    known = hashes[order]
    new = np.ones(n, bool)
    new[1:] = known[1:] != known[:-1]
    if (new[1:] & (known[1:] >> bits == known[:-1] >> bits)).any():  # others with the same first bits may stand between
        order = np.argsort(hashes)
        known = hashes[order]
        new[1:] = known[1:] != known[:-1]
    of = np.empty(n, np.int32)
    of[order] = np.cumsum(new) - 1
    return order[new], of


class Edges(Contexts):
    """Contexts of each byte once that follows the same beginning of a token, known by 56 bits of hash, in any token.

    What predicts a byte lies before it in its token, so tokens that begin alike share predictions.
    ``of``: of every byte of the tokens the edge it takes.
    """

    def __init__(self, tokens: list[bytes]):
        self._bytes_of(tokens)
        whole = self._whole()
        places, self.of = _grouped(mixed((mixed(whole) & ~np.uint64(255)) | self.bytes))
        text = self.bytes
        self.of_token = self.token
        self.bytes, self.token, self.at = text[places], self.token[places], self.at[places]
        self._hash(text, places, whole[places])


def _distinct(values: np.ndarray) -> np.ndarray:
    """The values in order, each once: sorted, which is much faster than ``np.unique``, which hashes them first."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values in order, each once, and how often each is there."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return values[at], np.diff(at, append=len(values))


def _heads(known: np.ndarray) -> np.ndarray:
    """Where in a table of sorted hashes each value of a hash's first bits begins, about one for each hash."""
    bits = min(22, max(1, len(known).bit_length()))
    return np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)


def _places(known: np.ndarray, values: np.ndarray, heads: np.ndarray | None = None) -> np.ndarray:
    """``np.searchsorted``, much faster where ``known`` are hashes, which their first bits place almost."""
    heads = _heads(known) if heads is None else heads
    out = heads[values >> np.uint64(65 - len(heads).bit_length())].astype(np.int64)
    if not len(known):
        return out
    at = np.arange(len(values))
    for _ in range(12):
        here = out[at]
        below = (here < len(known)) & (known[np.minimum(here, len(known) - 1)] < values[at])
        at = at[below]
        if not len(at):
            return out
        out[at] += 1
    out[at] = np.searchsorted(known, values[at])
    return out


def _starts(values: np.ndarray) -> np.ndarray:
    """Of each of some values, alike ones together, where those alike begin."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


def _batches_of(batches, *columns: str):
    """Lists of at most BATCH_TOKENS tokens, with arrays of the other columns."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_TOKENS):
            part = batch.slice(start, BATCH_TOKENS)
            yield part.column("token").to_pylist(), *[part.column(c).to_numpy(zero_copy_only=False) for c in columns]


class _Slots:
    """Exact counts of slots, with memory for those blocks of them that any token has reached."""

    def __init__(self, slots: int):
        self.place = np.full(-(-slots // BLOCK), -1, np.int64)
        self.counts = np.zeros((0, BLOCK))
        self.used = 0

    def add(self, slots: np.ndarray, weight: np.ndarray) -> None:
        blocks = slots // BLOCK
        new = np.flatnonzero(np.bincount(blocks[self.place[blocks] < 0], minlength=1))
        if len(new):
            self.place[new] = self.used + np.arange(len(new))
            self.used += len(new)
            if self.used > len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros((self.used + 16 - len(self.counts), BLOCK))])
        np.add.at(self.counts.reshape(-1), self.place[blocks] * BLOCK + slots % BLOCK, weight)

    def block(self, number: int) -> np.ndarray | None:
        return None if self.place[number] < 0 else self.counts[self.place[number]]


def _table_blocks(batches):
    """Zeros and ones of every slot that a task's tokens reach, in blocks of slots."""
    size = int(_STARTS[-1])
    zeros_and_ones = _Slots(2 * size)
    for tokens, n in _batches_of(batches, "n"):
        contexts, weight = Contexts(tokens).grouped(n)
        for bit in range(8):
            slots, ones = contexts.slots(bit)
            of_bit = ones.astype(np.int64) * size
            for start, slot in zip(_STARTS, slots, strict=False):
                zeros_and_ones.add(slot + (of_bit + start), weight)
    none = np.zeros(BLOCK)
    for block in range(size // BLOCK):
        parts = [zeros_and_ones.block(block), zeros_and_ones.block(size // BLOCK + block)]
        if any(part is not None for part in parts):
            part = np.stack([none if part is None else part for part in parts])
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["block", "counts"])


def _summed(rows: pa.Table) -> pa.Table:
    total = np.zeros((2, BLOCK))
    for raw in rows.column("counts"):
        total += np.frombuffer(zlib.decompress(raw.as_py()), np.float64).reshape(2, -1)
    zeros, ones = coded_pair(*total)
    codes = (zeros << 8) | ones
    return pa.table({"block": rows.column("block")[:1], "codes": pa.array([codes.astype("<u2").tobytes()], pa.binary())})


def _packed(values: np.ndarray) -> bytes:
    """First bytes of all values first, as most are alike; each of these rows compressed, unless its beginning hardly can be."""
    rows = [row.tobytes() for row in np.ascontiguousarray(values.ravel().view(np.uint8).reshape(values.size, values.itemsize).T)]
    keep = [len(rows) > 1 and len(row) > 0 and len(zlib.compress(row[:4096], 1)) > 0.95 * len(row[:4096]) for row in rows]
    parts = [row if kept else zlib.compress(row, 1) for row, kept in zip(rows, keep, strict=True)]
    sizes = [-len(part) if kept else len(part) for part, kept in zip(parts, keep, strict=True)]
    return b"".join([np.array(sizes, "<i8").tobytes(), *parts])


def _unpacked(raw, kind: str) -> np.ndarray:
    raw = raw.as_py()
    rows, at = [], 8 * np.dtype(kind).itemsize
    for size in np.frombuffer(raw, "<i8", np.dtype(kind).itemsize).tolist():
        part = raw[at : at + abs(size)]
        rows.append(np.frombuffer(part if size < 0 else zlib.decompress(part), np.uint8))
        at += abs(size)
    return np.stack(rows, axis=1).view(kind).ravel()


def _lot(rows: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Tokens of a lot and their numbers, those of training texts first, in an order of their own."""
    tokens, n = rows.column("token").to_pylist(), rows.column("n").to_numpy()
    order = np.lexsort((_hashes(tokens), n == 0))
    return [tokens[i] for i in order], n[order]


def _edges(shares: int) -> np.ndarray:
    """The first hash of each share but the first."""
    return np.array([(i << 64) // shares >> 8 << 8 for i in range(1, shares)], np.uint64)


def _asked(shares: int):
    """The distinct pairs of a lot with their numbers in training texts, a row for each share."""

    def asked(rows: pa.Table) -> pa.Table:
        tokens, n = _lot(rows)
        edges = Edges(tokens)
        taken = np.bincount(edges.of, n[edges.of_token], len(edges.bytes))
        pairs, inverse = np.unique(edges.pairs().ravel(), return_inverse=True)
        # An order with too short a context stands for the whole one, which is counted once.
        counted = np.stack([np.where(edges.at >= order, taken, 0) if order else taken for order, bits in ORDERS if not bits])
        weight = np.bincount(inverse.ravel(), counted.ravel(), len(pairs)).astype(np.int64)
        cuts = [0, *np.searchsorted(pairs, _edges(shares)).tolist(), len(pairs)]
        out = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.table(
            {
                "share": pa.array([i for i, _, _ in out], pa.int64()),
                "lot": pa.repeat(rows.column("lot")[0], len(out)),
                "pairs": pa.array([_packed(np.diff(pairs[a:b], prepend=np.uint64(0))) for _, a, b in out], pa.binary()),
                "n": pa.array([_packed(weight[a:b]) for _, a, b in out], pa.binary()),
            }
        )

    return asked


def path_codes(pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of sorted pairs the codes of how often each of the eight bits to a pair's byte was taken, and was not (a row each)."""
    codes = np.empty((16, len(pairs)), np.uint8)
    total = None
    for level in range(9):
        node = pairs >> np.uint64(8 - level)
        group = np.cumsum(np.concatenate([[False], node[1:] != node[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        below = np.bincount(group, n)[group] if len(pairs) else np.zeros(0)
        if total is not None:
            codes[level - 1], codes[level + 7] = coded_pair(below, total - below)
        total = below
    return codes


def _answered(rows: pa.Table) -> pa.Table:
    """For each lot the codes of the pairs it has asked for, in its order."""
    pairs = [np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64) for raw in rows.column("pairs")]
    known, place = np.unique(np.concatenate(pairs), return_inverse=True)
    n = np.bincount(place, np.concatenate([_unpacked(raw, "<i8") for raw in rows.column("n")]), len(known))
    codes = path_codes(known, n)
    ends = np.cumsum([len(p) for p in pairs])
    # Of most contexts one byte is known, so that one bit's codes are those of the bit before.
    codes[1:8] -= codes[:7].copy()
    found = [_packed(codes[:, place[end - len(p) : end]]) for p, end in zip(pairs, ends, strict=True)]
    return pa.table({"lot": rows.column("lot"), "share": rows.column("share"), "codes": pa.array(found, pa.binary())})


class Found:
    """Codes of the pairs of some tokens: ``codes`` a row for each bit, ``places`` of every byte a row for each order."""

    def __init__(self, codes: np.ndarray, of_edge: np.ndarray, edges: Edges):
        self.codes, self.of_edge, self.edges = codes, of_edge, edges

    @property
    def places(self) -> np.ndarray:
        return self.of_edge[:, self.edges.of]

    @staticmethod
    def of(tokens: list[bytes], answers: pa.Table) -> Found:
        shares = np.argsort(answers.column("share").to_numpy())
        raw = answers.column("codes")
        codes = np.concatenate([_unpacked(raw[int(i)], "u1").reshape(16, -1) for i in shares], axis=1)
        edges = Edges(tokens)
        pairs = edges.pairs()
        known, places = np.unique(pairs.ravel(), return_inverse=True)
        if len(known) != codes.shape[1]:
            raise ValueError("a lot has other pairs than it asked for")
        # A bit at a time, as arrays of all bits would be as large as the rest together.
        low, taken = known.astype(np.uint8), np.zeros(len(known), np.uint8)
        ordered = np.empty((8, len(known)), np.uint16)
        for bit in range(8):
            taken = taken + codes[bit]
            one, yes, no = (low >> np.uint8(7 - bit)) & 1 == 1, taken.astype(np.uint16), codes[8 + bit].astype(np.uint16)
            ordered[bit] = np.where(one, (no << 8) | yes, (yes << 8) | no)
        return Found(ordered, places.reshape(pairs.shape).astype(np.int32), edges)


class Mixer:
    """Tables of codes, and mixing weights by gate. Contexts without a table are unseen unless codes are given."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.weights = np.full((GATES, INPUTS), 0.1)
        self.weights[:, -1] = 0.0
        longest = (np.arange(3, GATES) // 3 - 1) // len(_STEPS)
        self.weights[np.arange(3, GATES), longest] = 0.5
        self.squares = np.full((GATES, INPUTS), 1e-6)

    def edge_codes(self, edges: Edges, bit: int, without_self: bool, found: Found | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Of each order the code of every edge's bit, and the bit."""
        slots, ones = edges.slots(bit)
        codes = [self.codes[slot + start] for start, slot in zip(_STARTS, slots, strict=False)]
        codes += [np.zeros(len(ones), np.uint16)] * KEYED if found is None else [found.codes[bit][places] for places in found.of_edge]
        if without_self:
            own = ones.astype(np.int64) << 16
            codes = [WITHOUT[own + code] for code in codes]
        return codes, ones

    def gates(self, edges: Edges, codes: list[np.ndarray] | np.ndarray) -> np.ndarray:
        gate = np.zeros(len(edges.bytes), np.int16)
        for k, code in enumerate(codes):
            np.maximum(gate, GATE[k][code], out=gate)
        return gate * np.int16(3) + edges.where.astype(np.int16)

    def probability(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Of a one."""
        w = self.weights.T.astype(np.float32)
        out = w[0][gate] * x[0]
        for k in range(1, INPUTS):
            out += w[k][gate] * x[k]
        return 1 / (1 + np.exp(-np.clip(out, -12, 12).astype(np.float64)))

    def learn(self, tokens: list[bytes], n: np.ndarray, found: Found | None = None) -> None:
        """Go through tokens in order, in steps of some bytes; a token counts as often as it occurs."""
        size = max(1, int(len(tokens) * STEP_BYTES / max(1, sum(map(len, tokens)) + len(tokens))))
        edges = found.edges if found else Edges(tokens)
        # Of each bit and edge the codes, and the gate.
        known = np.empty((8, len(ORDERS) + 1, len(edges.bytes)), np.uint16)
        for bit in range(8):
            known[bit, :-1] = self.edge_codes(edges, bit, True, found)[0]
            known[bit, -1] = self.gates(edges, known[bit, :-1])
        done = 0
        for at in range(0, len(tokens), size):
            count = sum(map(len, tokens[at : at + size])) + len(tokens[at : at + size])
            here = edges.of[done : done + count].astype(np.int64)
            byte = edges.bytes[here]
            mass = n[edges.of_token[done : done + count]].astype(np.float64)
            done += count
            x = np.empty((INPUTS, count), np.float32)
            x[-1] = 0.3
            for bit in range(8):
                for k in range(len(ORDERS)):
                    x[k] = STRETCHED[known[bit, k][here]]
                gate = known[bit, -1][here].astype(np.int64)
                error = mass * ((byte >> (7 - bit) & 1) - self.probability(x, gate))
                total = np.maximum(np.bincount(gate, mass, GATES), 1e-9)
                for k in range(INPUTS):
                    slope = np.bincount(gate, error * x[k], GATES) / total
                    self.squares[:, k] += slope * slope
                    self.weights[:, k] += RATE * slope / np.sqrt(self.squares[:, k])

    def log10(self, tokens: list[bytes], found: Found | None = None) -> np.ndarray:
        """The log10 probability of each token."""
        edges = found.edges if found else Edges(tokens)
        total = np.zeros(len(edges.bytes))
        x = np.empty((INPUTS, len(total)), np.float32)
        x[-1] = 0.3
        for bit in range(8):
            codes, ones = self.edge_codes(edges, bit, False, found)
            for k, code in enumerate(codes):
                x[k] = STRETCHED[code]
            p = self.probability(x, self.gates(edges, codes))
            total += np.log10(np.where(ones == 1, p, 1 - p))
        return np.bincount(edges.of_token, total[edges.of], len(tokens))


def _slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from each start to its end."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])


class _Tally:
    """Tokens by hash, each with its numbers in training texts and in all."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray, n_all: np.ndarray, tokens):
        """``tokens`` gives those at some places, of which one is asked for each hash."""
        order = np.argsort(hashes)
        known = hashes[order]
        new = np.ones(len(known), bool)
        new[1:] = known[1:] != known[:-1]
        at = np.flatnonzero(new)
        self.hashes, self.n, self.n_all = known[at], np.add.reduceat(n[order], at), np.add.reduceat(n_all[order], at)
        self.tokens = tokens(order[at])

    @staticmethod
    def of_texts(batch: pa.RecordBatch) -> _Tally:
        words = Words(batch.column("text"), lower=True)
        learned = (~batch.column("held_out").to_numpy(zero_copy_only=False)).astype(np.int64)
        # After the words the ends, of no bytes.
        start, end = [np.concatenate([side, np.zeros(len(learned), np.int64)]) for side in (words.start, words.end)]
        hashes = np.concatenate([words.hash, np.zeros(len(learned), np.uint64)])
        n = np.concatenate([learned[words.doc], learned])
        return _Tally(hashes, n, np.ones(len(n), np.int64), lambda at: _slices(words.bytes, start[at], end[at]))

    @staticmethod
    def merged(tallies: list[_Tally]) -> _Tally:
        tokens = pa.concat_arrays([t.tokens for t in tallies])
        return _Tally(*[np.concatenate([getattr(t, c) for t in tallies]) for c in ("hashes", "n", "n_all")], lambda at: tokens.take(pa.array(at)))

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.tokens, pa.array(self.n), pa.array(self.n_all)], ["token", "n", "n_all"])


def _token_counts(batches):
    """Token, its number in training texts, and in all, of the texts of a task; the end is the empty token."""
    tallies: list[_Tally] = []
    # A tally of many tokens, then those of some texts each, until they have twice as many tokens or many bytes.
    for part in (part for batch in batches for part in chunks(batch, batch.column("text"), TEXT_BYTES)):
        tallies.append(_Tally.of_texts(part))
        if sum(len(t.n) for t in tallies) > 2 * GATHER_TOKENS or sum(t.tokens.nbytes for t in tallies) > GATHER_BYTES:
            whole = _Tally.merged(tallies)
            tallies = [whole]
            if len(whole.n) > GATHER_TOKENS or whole.tokens.nbytes > GATHER_BYTES // 2:
                yield whole.rows()
                tallies = []
    if tallies:
        yield _Tally.merged(tallies).rows()


def _known_slots(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots that any token has reached and their codes, a small part of the table, so that no copy of it is sent or lies on disk."""
    slots = np.flatnonzero(codes).astype(np.int32)
    return slots, codes[slots]


def _table(slots: np.ndarray, known: np.ndarray) -> np.ndarray:
    codes = np.zeros(_STARTS[-1], np.uint16)
    codes[slots] = known
    return codes


def _learned(held):
    def learned(rows: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, n = _lot(rows)
        mixer = Mixer(_table(*held.value))
        mass = int((n > 0).sum())
        if mass:
            mixer.learn(tokens[:mass], n[:mass], Found.of(tokens, answers))
        return pa.table({"weights": pa.array([mixer.weights.tobytes()] * (mass > 0), pa.binary()), "mass": pa.array([float(mass)] * (mass > 0), pa.float64())})

    return learned


def answers(dealt: DataFrame, pairs: int) -> tuple[DataFrame, str]:
    """For each lot of ``dealt`` (token, n, lot) rows (lot, share, codes) with the codes of its pairs, and their place."""
    shares = max(1, -(-pairs // SHARE_PAIRS))
    asked = dealt.groupBy("lot").applyInArrow(tidy_group(_asked(shares)), "share bigint, lot bigint, pairs binary, n binary")
    return placed_table(asked.groupBy("share").applyInArrow(tidy_group(_answered), "lot bigint, share bigint, codes binary"), "context-codes")


def train(counts: DataFrame, dealt: DataFrame, answered: DataFrame) -> Mixer:
    """A mixer from rows (token, n) of the training texts, n > 0; its size does not depend on their number."""
    spark = counts.sparkSession
    distinct = counts.count()
    tasks = min(MOST_TASKS, max(1, -(-distinct // TOKENS_A_TASK)))
    # A task's tables have a fixed size, so there are no more tasks than the tokens need.
    blocks = counts.select("token", "n").coalesce(tasks).mapInArrow(tidy(_table_blocks), "block bigint, counts binary").groupBy("block")
    codes = np.zeros(_STARTS[-1], np.uint16)
    for row in blocks.applyInArrow(tidy_group(_summed), "block bigint, codes binary").toLocalIterator():  # one slot each, a fixed number
        part = np.frombuffer(row.codes, "<u2")
        start = row.block * BLOCK
        codes[start : start + len(part)] = part[: len(codes) - start]
    mixer = Mixer(codes)
    lots = dealt.groupBy("lot").cogroup(answered.groupBy("lot"))
    found = lots.applyInArrow(tidy_cogroup(_learned(spark.sparkContext.broadcast(_known_slots(codes)))), "weights binary, mass double")
    # Written, as each Python step in a task has workers of its own, which Spark keeps. A fixed number of rows, however many lots there are.
    found, weights_at = placed_table(found, "lot-weights")
    found = found.coalesce(MOST_TASKS).mapInArrow(tidy(_averaged), "weights binary, mass double").collect()
    remove(spark, weights_at)
    if found:
        found.sort(key=lambda r: bytes(r.weights))
        share = np.array([r.mass for r in found]) / sum(r.mass for r in found)
        mixer.weights = sum(s * np.frombuffer(r.weights).reshape(GATES, INPUTS) for s, r in zip(share, found, strict=True))
    return mixer


def _averaged(batches):
    """The mean of a task's weights."""
    total, mass = np.zeros(GATES * INPUTS), 0.0
    for batch in batches:
        for raw, part in zip(batch.column("weights"), batch.column("mass").to_pylist(), strict=True):
            total += part * np.frombuffer(raw.as_py())
            mass += part
    if mass:
        yield pa.RecordBatch.from_arrays([pa.array([(total / mass).tobytes()], pa.binary()), pa.array([mass])], ["weights", "mass"])


def _hashes(tokens: list[bytes]) -> np.ndarray:
    """Of each token what :class:`Words` gives for it; 0 for the end."""
    out = np.zeros(len(tokens), np.uint64)
    words = Words(pa.array(tokens, pa.binary()))
    out[words.doc] = words.hash
    return out


def _scored(held, weights: np.ndarray, total: int, shares: int):
    """Hash, number and score of a lot's tokens, and the share of hashes that each is of."""

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        mixer = Mixer(_table(*held.value))
        mixer.weights = weights
        tokens, n = _lot(rows)
        found = Found.of(tokens, answers)
        p = 10.0 ** mixer.log10(tokens, found)
        if total:
            p = (1 - WHOLE) * p + WHOLE * n / total
        hashes = _hashes(tokens)
        share = np.searchsorted(_edges(shares), hashes, side="right")
        return pa.table({"share": pa.array(share), "token": pa.array(hashes.view(np.int64)), "n": pa.array(n), "score": pa.array(np.log10(np.maximum(p, 1e-300)))})

    return scored


def _texts_of(rows: pa.Table):
    """The texts' words, some texts at a time, with the rows they are of."""
    at = 0
    for batch in rows.select(["text"]).to_batches():
        for part in chunks(batch, batch.column(0), TEXT_BYTES):
            yield slice(at, at + part.num_rows), Words(part.column(0), lower=True)
            at += part.num_rows


def _doc_of(sizes: np.ndarray) -> np.ndarray:
    """Of each token of texts of these sizes its text."""
    return np.repeat(np.arange(len(sizes)), sizes)


def _sequence(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each token of some texts, ends included: its text, and its hash (0 for the end)."""
    sizes = words.count + 1
    doc = _doc_of(sizes)
    inside = np.ones(len(doc), bool)
    inside[np.cumsum(sizes) - 1] = False
    token = np.zeros(len(doc), np.uint64)
    token[inside] = words.hash
    return doc, token


def _pairs(doc: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Of each token 56 bits of hash of it with the one before; the other 8 are 0, which costs nothing to send."""
    before = np.full(len(doc), _OPENS)
    before[1:] = np.where(doc[1:] == doc[:-1], token[:-1], _OPENS)
    return mixed(mixed(before) * _ODD[0] + token) & ~np.uint64(255)


def _share_slices(known: np.ndarray, shares: int) -> list[slice]:
    """Where each share's hashes are in sorted ones."""
    cuts = [0, *np.searchsorted(known, _edges(shares)).tolist(), len(known)]
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _requests(shares: int):
    """The distinct tokens of a chunk, and its distinct pairs of tokens with their numbers in training texts, a row for each share of hashes."""

    def requests(rows: pa.Table) -> pa.Table:
        learned = ~rows.column("held_out").to_numpy()
        known, all_pairs, trained = [], [], []
        for which, words in _texts_of(rows):
            doc, token = _sequence(words)
            pair = _pairs(doc, token)
            known.append(_distinct(token))
            all_pairs.append(pair)
            trained.append(pair[learned[which][doc]])
        tokens, pairs = _distinct(np.concatenate(known)), _distinct(np.concatenate(all_pairs))
        del known, all_pairs
        in_training, times = _counted(np.concatenate(trained))
        n = np.zeros(len(pairs), np.int64)
        n[np.searchsorted(pairs, in_training)] = times
        of_tokens, of_pairs = _share_slices(tokens, shares), _share_slices(pairs, shares)
        return pa.table(
            {
                "chunk": pa.repeat(rows.column("chunk")[0], shares),
                "share": pa.array(range(shares), pa.int64()),
                "tokens": pa.array([_packed(np.diff(tokens[part], prepend=np.uint64(0))) for part in of_tokens], pa.binary()),
                "pairs": pa.array([_packed(np.diff(pairs[part], prepend=np.uint64(0))) for part in of_pairs], pa.binary()),
                "n": pa.array([_packed(n[part]) for part in of_pairs], pa.binary()),
            }
        )

    return requests


def _met(rows: pa.Table, scored: pa.Table) -> pa.Table:
    """For each chunk the numbers and scores of the tokens it has asked for, and how often its pairs are in training texts, in its order."""
    pairs = [np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64) for raw in rows.column("pairs")]
    known, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *pairs]), return_inverse=True)
    followed = np.bincount(place, np.concatenate([np.zeros(0, np.int64), *[_unpacked(raw, "<i8") for raw in rows.column("n")]]), len(known)).astype(np.int64)
    ends = np.cumsum([len(p) for p in pairs])
    tokens = scored.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    tokens, n, score = tokens[order], scored.column("n").to_numpy()[order], scored.column("score").to_numpy()[order]
    asked = [np.searchsorted(tokens, np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64)) for raw in rows.column("tokens")]
    return pa.table(
        {
            "chunk": rows.column("chunk"),
            "share": rows.column("share"),
            "n": pa.array([_packed(n[at]) for at in asked], pa.binary()),
            "score": pa.array([_packed(score[at]) for at in asked], pa.binary()),
            "followed": pa.array([_packed(followed[place[end - len(p) : end]]) for p, end in zip(pairs, ends, strict=True)], pa.binary()),
        }
    )


def after_token(doc: np.ndarray, score: np.ndarray, seen: np.ndarray, followed: np.ndarray) -> np.ndarray:
    """log10 probabilities of tokens, given how often the token before was ``seen`` and ``followed`` by this one.

    Each text learns on its own which weight followers deserve, by how often the token before was seen.
    """
    p = 10.0**score
    share = np.minimum(followed / np.maximum(seen, 1), 1.0)
    weight = seen / (seen + HALF)
    gate = np.searchsorted(_STEPS, seen, side="right")
    # How likely it was the followers that gave each token, and the mean of that over earlier ones of the text and gate.
    told = weight * share / np.maximum(weight * share + (1 - weight) * p, 1e-300)
    key = doc * (len(_STEPS) + 1) + gate
    # Of 16 bits keys are sorted by counting.
    order = np.argsort(key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key, kind="stable")
    key = key[order]
    first = _starts(key)
    total = np.concatenate([[0.0], np.cumsum(told[order])])
    learned = np.empty(len(doc))
    learned[order] = (total[:-1] - total[first] + PAIR_WORTH * weight[order]) / (PAIR_WORTH + np.arange(len(doc)) - first)
    learned = np.where(seen > 0, np.clip(learned, 0.0, 1.0), 0.0)
    return np.log10(np.maximum((1 - learned) * p + learned * share, 1e-300))


def _occurred(doc: np.ndarray, tokens: list[np.ndarray]) -> np.ndarray:
    """For places in order, the last earlier place of the same text with the same tokens, or -1."""
    key = mixed(doc.astype(np.uint64))
    for token in tokens:
        key = mixed(key ^ (token + 1).astype(np.uint64))
    n = len(doc)
    bits = np.uint64(max(1, n.bit_length()))
    # Sorting places behind the hash's first bits is much faster than a stable sort of hashes.
    order = (np.sort((key >> bits << bits) | np.arange(n, dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    again = np.flatnonzero(key[order][1:] == key[order][:-1])
    place = np.full(n, -1)
    place[order[again + 1]] = order[again]
    return place


def adapted(doc: np.ndarray, token: np.ndarray, score: np.ndarray) -> np.ndarray:
    """log10 probabilities of tokens, given what each text has shown before; each text adapts on its own.

    ``doc`` ascends; ``token`` has the number of each token, ``score`` its log10 probability elsewhere.
    """
    n = len(doc)
    first = _starts(doc)
    at = np.arange(n)

    def earlier(flags: np.ndarray) -> np.ndarray:
        total = np.cumsum(flags) - flags
        return total - total[first]

    before = []
    for back in range(1, max(TRUST) + 1):
        moved = np.full(n, -1)
        moved[back:] = token[:-back]
        before.append(np.where(at - first >= back, moved, -1 - back))
    longest = np.full(n, -1)
    pointer = np.full(n, -1)
    for order in TRUST:
        place = _occurred(doc, before[:order])
        longest[place >= 0] = order
        pointer = np.where(place >= 0, place, pointer)
    # How many of the text's tokens before are this one.
    bits = np.int64(max(1, n.bit_length()))
    same = np.sort(((doc * (token.max(initial=0) + 1) + token) << bits) | at) & ((np.int64(1) << bits) - 1)
    opens = np.ones(n, bool)
    opens[1:] = (token[same][1:] != token[same][:-1]) | (doc[same][1:] != doc[same][:-1])
    seen = np.empty(n)
    seen[same] = at - np.maximum.accumulate(np.where(opens, at, 0))
    so_far = at - first
    p = np.where(so_far > 0, (1 - CACHE) * 10.0**score + CACHE * seen / np.maximum(1, so_far), 10.0**score)
    hit = (pointer >= 0) & (token == token[pointer])
    for order, (prior, worth) in TRUST.items():
        here = longest == order
        trust = (earlier(here & hit) + prior * worth) / (earlier(here) + worth)
        p = np.where(here, np.where(hit, trust + (1 - trust) * p, (1 - trust) * p), p)
    return np.log10(np.maximum(p, 1e-300))


def _document_scores(total: int, distinct: int):
    def scores(docs: pa.Table, met: pa.Table) -> pa.Table:
        learned = ~docs.column("held_out").to_numpy()
        parts = [(which, words.count + 1, _sequence(words)[1]) for which, words in _texts_of(docs)]
        known = _distinct(np.concatenate([_distinct(token) for _, _, token in parts]))
        pairs = _distinct(np.concatenate([_distinct(_pairs(_doc_of(sizes), token)) for _, sizes, token in parts]))
        met = met.sort_by("share")
        n, of_token, followed = [np.concatenate([_unpacked(raw, kind) for raw in met.column(c)]) for c, kind in (("n", "<i8"), ("score", "<f8"), ("followed", "<i8"))]
        if len(pairs) != len(followed) or len(known) != len(n):
            raise ValueError("a chunk has other tokens or pairs than it asked for")
        of_count = np.log10((n + 1) / (total + distinct + 1))
        of_tokens, of_pairs = _heads(known), _heads(pairs)
        rows = docs.num_rows
        n_tokens, n_known = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        base, score = np.zeros(rows), np.zeros(rows)
        end = np.searchsorted(known, 0)
        while parts:
            which, sizes, hashed = parts.pop()
            doc, texts = _doc_of(sizes), len(sizes)
            token = _places(known, hashed, of_tokens)
            # Every token is followed by one, and every text's end stands for a beginning.
            seen = n[np.where(np.concatenate([[True], doc[1:] != doc[:-1]]), end, np.concatenate([[end], token[:-1]]))]
            own = learned[which][doc].astype(np.int64)
            after = after_token(doc, of_token[token], seen - own, followed[_places(pairs, _pairs(doc, hashed), of_pairs)] - own)
            n_tokens[which] = sizes
            n_known[which] = np.bincount(doc, n[token] > 0, texts)
            base[which] = np.bincount(doc, of_count[token], texts)
            score[which] = np.bincount(doc, adapted(doc, token, after), texts)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(n_tokens),
                "n_known": pa.array(n_known),
                "n_bytes": pc.binary_length(docs.column("text")).cast(pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    return scores


def _let_go(spark: SparkSession) -> None:
    """:func:`let_go`, also of the last step's shuffles: Spark's scheduler keeps its last event, and so what that is of, until another comes."""
    spark.range(1).collect()
    let_go(spark)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (of the text as it is).

    Held out are rows whose crc32 of the id has this remainder (modulo, remainder); the others are learned from.
    """
    plain = texts(docs, id_col, text_col)
    plain = plain.withColumn("held_out", crc_mod("doc_id", held_out[0]) == held_out[1]).withColumn("text", F.coalesce("text", F.lit("")))
    counted = plain.select("text", "held_out").mapInArrow(tidy(_token_counts), "token binary, n bigint, n_all bigint")
    with session_conf(plain.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": TEXTS_A_BATCH}):
        counts, counts_at = placed_table(counted.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all")), "token-counts")
    _let_go(plain.sparkSession)
    total, distinct, tokens, size = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count(F.when(F.col("n") > 0, 1)),
        F.coalesce(F.sum("n_all"), F.lit(0)),
        F.coalesce(F.sum(F.length("token") + 1), F.lit(0)),
    ).first()
    lots = max(1, -(-size // LOT_BYTES))
    of_lots = counts.select("token", "n", F.pmod(F.xxhash64("token"), F.lit(lots)).alias("lot"))
    answered, codes_at = answers(of_lots, size)
    _let_go(plain.sparkSession)
    mixer = train(counts.where("n > 0"), of_lots, answered)
    _let_go(plain.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(_known_slots(mixer.codes))
    shares = max(1, -(-tokens // SHARE_PAIRS))
    scored = of_lots.groupBy("lot").cogroup(answered.groupBy("lot"))
    scored = scored.applyInArrow(tidy_cogroup(_scored(held, mixer.weights, total, shares)), "share bigint, token bigint, n bigint, score double")
    scored, scores_at = placed_table(scored, "token-scores")
    remove(plain.sparkSession, codes_at)
    remove(plain.sparkSession, counts_at)
    _let_go(plain.sparkSession)
    dealt_to = max(1, -(-tokens // CHUNK_TOKENS))
    dealt = plain.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(dealt_to)))
    asked = dealt.groupBy("chunk").applyInArrow(tidy_group(_requests(shares)), "chunk bigint, share bigint, tokens binary, pairs binary, n binary")
    met = asked.groupBy("share").cogroup(scored.groupBy("share"))
    met = met.applyInArrow(tidy_cogroup(_met), "chunk bigint, share bigint, n binary, score binary, followed binary")
    met = table(met, "chunk-scores")
    remove(plain.sparkSession, scores_at)
    _let_go(plain.sparkSession)
    kind = dict(plain.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, n_bytes bigint, base_score double, score double"
    found = dealt.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(tidy_cogroup(_document_scores(total, distinct)), schema)
    bits = -F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score",
        bits.alias("bits_per_byte"),
    )
