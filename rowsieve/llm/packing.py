"""Packing of documents into token sequences by the sum-of-squares rule.

A document's ids, an end id appended, are cut into pieces of the sequence length; only the last
piece may be shorter. A piece goes where the sum over all residual gaps of the squared number of
open sequences with that gap becomes smallest; that keeps gaps of every size at hand, so later
pieces fill them exactly. Pieces come longest first, and equal sums go to the smaller gap.

Pieces are packed in shards of about ``SHARD_ROWS`` documents, dealt by row number and not by
key, so a shard's task has a bounded number of rows at any input size. A shard leaves a few
sequences unfilled: under one in a thousand at this shard size.

Defined results: a null or empty text is the end id alone; a repeated row is packed again; a null
id stays null; other columns are not read; without documents there are no pieces; a very long text is
as many full pieces as it fills, and a last one. Row numbers are those of the frame's partitions: a frame
that a shuffle makes in another order when a task is repeated is to be written first.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import texts
from rowsieve.llm.memory import tidy_batch

LENGTH = 4096
END = 1
SHARD_ROWS = 100_000
#: Parts whose ids a Python worker keeps.
KNOWN_PARTS = 700_000


#: The tokenizer's own pattern, for lower-case texts of Latin-1 characters.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\s0-9a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: What a text must not hold for that: other characters, letters and digits that look like signs, special tokens.
_OTHER = re.compile("[^\t-\r -~\u00a0-\u00ff]|[\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be]|<\\|")
#: Fixed by byte-level vocabularies: printable bytes stand for themselves, the others for 256, 257 and so on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_LETTERS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}


#: How a tokenizer normalises and cuts texts for which ``_PARTS`` gives its parts.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def cuts_words(tokenizer) -> bool:
    """Whether a tokenizer cuts texts as ``_PARTS`` does and does nothing after that."""
    facts = json.loads(tokenizer.to_str())
    plain = facts["post_processor"] is None and all(t["content"].startswith("<|") for t in facts["added_tokens"])
    return plain and facts["normalizer"] == _NORMALIZER and facts["pre_tokenizer"] == _PRE_TOKENIZER


class WordIds:
    """The ids of texts, as little-endian unsigned 32-bit numbers.

    The tokenizer cuts a text into parts (words, single digits, runs of signs) and merges within
    parts only. Texts of Latin-1 characters are cut here by the same pattern, and the ids of each
    part are computed once; other texts, and all texts of a tokenizer that cuts them otherwise
    (:func:`cuts_words`), go through the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.cut_here = cuts_words(self.tokenizer)
        self.known: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        ids = array("I", [t.id for t in self.merge(part.encode().decode("latin-1").translate(_AS_LETTERS))])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.cut_here or _OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = _PARTS.findall(text.lower())
        ids = list(map(self.known.get, parts))
        if None in ids:
            if len(self.known) > KNOWN_PARTS:
                self.known = {}
            known = self.known
            for i, x in enumerate(ids):
                if x is None:
                    part = parts[i]
                    x = known.get(part)
                    if x is None:
                        known[part] = x = self.part(part)
                    ids[i] = x
        return b"".join(ids)


@functools.cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _crcs(path: str | None, length: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def crcs(text: pa.Array) -> pa.Array:
        ids = _word_ids(path or default_tokenizer()).text
        sizes, sums = [], []
        for value in text:
            raw = ids(value.as_py()) + tail
            sizes.append(len(raw) // 4)
            sums.append([zlib.crc32(raw[i : i + 4 * length]) for i in range(0, len(raw), 4 * length)])
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))], ["size", "crcs"]
        )

    return F.arrow_udf(tidy_batch(crcs), "struct<size: bigint, crcs: array<bigint>>")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def place(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces in the order given: the sequence of each (from 0) and its offset there."""
    count = np.zeros(length + 1, np.int64)
    open_: dict[int, list[int]] = {}
    sequence = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    made = 0
    never = np.int64(1) << 60
    for i, size in enumerate(sizes.tolist()):
        # One sequence less with gap g and one more with g - size change the sum by 2 (after - before) + 2.
        before = count[size:length]
        at, best = -1, 2 * int(count[length - size]) + 1 if size < length else 0  # a new sequence
        if size < length and before.any():
            change = np.where(before > 0, 2 * (count[: length - size] - before) + 2, never)
            if before[0]:
                change[0] = 1 - 2 * before[0]  # a full sequence has no gap that counts
            if change.min() <= best:
                at = int(change.argmin())
        if at >= 0:
            gap = size + at
            where = heapq.heappop(open_[gap])
            count[gap] -= 1
        else:
            gap, where = length, made
            made += 1
        sequence[i], offset[i] = where, length - gap
        if gap > size:
            count[gap - size] += 1
            heapq.heappush(open_.setdefault(gap - size, []), where)
    return sequence, offset


def _packer(length: int):
    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        size = rows.column("length").to_numpy()
        order = np.lexsort((rows.column("row").to_numpy(), -size))
        sequence, offset = (np.empty(len(size), np.int64) for _ in range(2))
        sequence[order], offset[order] = place(size[order], length)
        out = rows.drop_columns(["shard", "row"])
        return out.append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 40))).append_column(
            "offset", pa.array(offset)
        )

    return pack


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    length: int = LENGTH,
    end: int = END,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of the tokenizer's file as the executors see it; the public one by default.
    """
    shards = max(1, -(-docs.count() // shard_rows))
    plain = texts(docs, id_col, text_col)
    found = plain.select("doc_id", _crcs(tokenizer, length, end)("text").alias("ids"))
    pieces = found.withColumn("row", F.monotonically_increasing_id()).select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "doc_id", "ids.size", F.posexplode("ids.crcs").alias("piece", "ids_crc32")
    )
    start = F.col("piece").cast("bigint") * length
    pieces = pieces.select(
        "shard", "row", "doc_id", "piece", start.alias("start"), F.least(F.lit(length), F.col("size") - start).alias("length"), "ids_crc32"
    )
    schema = ", ".join(f"{n} {t}" for n, t in pieces.drop("shard", "row").dtypes) + ", sequence_id bigint, offset bigint"
    return pieces.groupBy("shard").applyInArrow(_packer(length), schema)
