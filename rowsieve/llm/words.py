"""Words of many texts at once, as arrays: places, 64-bit hashes, hashes of runs of words.

Texts are handled as UTF-8 bytes. Two ways to cut words occur:

* ``SPACED``: maximal runs of bytes other than white space (``[^\\x20\\x09-\\x0D]+``);
* ``ALNUM``: maximal runs of ASCII letters, digits and everything beyond ASCII
  (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` once A-Z are lower case).

No byte of a multi-byte character is a separator, so cutting bytes equals cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTE = np.arange(256)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
SPACED = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))
ALNUM = (
    ((_BYTE >= 48) & (_BYTE <= 57))
    | ((_BYTE >= 65) & (_BYTE <= 90))
    | ((_BYTE >= 97) & (_BYTE <= 122))
    | (_BYTE >= 128)
)
#: For ``bytes.translate``: A-Z to lower case, and in the second one separators to a space.
LOWER_BYTES = bytes(LOWER)
ALNUM_BYTES = bytes(int(LOWER[b]) if ALNUM[b] else 32 for b in range(256))

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE_BASE, _RUN_BASES = 0x9E3779B97F4A7C15, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_LENGTH_SALT = np.uint64(0x8EBC6AF09C88C6E3)


def binary(texts: pa.Array) -> pa.Array:
    """The texts as bytes; a null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    out = texts.cast(kind)
    return out.fill_null(b"") if out.null_count else out


def text_bytes(texts: pa.Array) -> list[bytes]:
    return binary(texts).to_pylist()


def chunks(batch: pa.RecordBatch, texts: pa.Array, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts have ``limit`` bytes together, or one longer text each."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose results look random."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i < n."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = (n + (1 << 18) - 1) >> 18 << 18 if n <= 1 << 22 else n
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if size <= 1 << 22:  # for a longer text than usual nothing is kept
            _powers[base] = known
    return known[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Words:
    """The words of an array of texts.

    ``doc``, ``start``, ``end``: of each word the text it is in and its bytes; ``first``: of each
    text its first word (one entry more than texts); ``hash``: 64 bits of each word.
    """

    def __init__(self, texts: pa.Array, *, kind: np.ndarray = SPACED, lower: bool = False):
        texts = binary(texts)
        width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        self.bytes = LOWER[raw] if lower else raw
        inside = kind[raw]
        n = len(raw)
        edge = np.ones(n + 1, bool)
        edge[1:n] = inside[1:] != inside[:-1]
        edge[at] = True
        places = np.flatnonzero(edge)
        word = inside[places[:-1]] if n else np.zeros(0, bool)
        self.start, self.end = places[:-1][word], places[1:][word]
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        weights = powers(_BYTE_BASE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.bytes * weights[:n], out=total[1:])
        back = powers(_inverse(_BYTE_BASE), n + 1)
        value = (total[self.end] - total[self.start]) * back[self.start]
        self.hash = mixed(value + (self.end - self.start).astype(np.uint64) * _LENGTH_SALT)

    def runs(self, n: int, which: int = 0) -> np.ndarray:
        """The hash of the n words from each place on; only where :meth:`whole` is it of one text."""
        base = _RUN_BASES[which]
        m = len(self.hash)
        total = np.zeros(m + 1, np.uint64)
        np.cumsum(self.hash * powers(base, m + 1)[:m], out=total[1:])
        places = max(0, m - n + 1)
        back = powers(_inverse(base), m + 1)
        return mixed((total[n : n + places] - total[:places]) * back[:places])

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each place on are of one text."""
        places = max(0, len(self.doc) - n + 1)
        return self.doc[:places] == self.doc[len(self.doc) - places :]

    def texts_hash(self, n: int) -> np.ndarray:
        """For each text a hash of all its words, of use for those with fewer than n words."""
        base = _RUN_BASES[0]
        m = len(self.hash)
        total = np.zeros(m + 1, np.uint64)
        np.cumsum(self.hash * powers(base, m + 1)[:m], out=total[1:])
        back = powers(_inverse(base), m + 1)
        value = (total[self.first[1:]] - total[self.first[:-1]]) * back[self.first[:-1]]
        return mixed(value + (self.count + 1).astype(np.uint64) * _LENGTH_SALT)


def lookup(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values
