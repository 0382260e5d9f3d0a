"""Quality by ordinal cumulative-link regression on hashed text.

A text's features are the shares of its byte trigrams, hashed to ``1 << BITS`` bins (case and
punctuation count, as much of what makes a text poor shows there), and the shares of words that
repeat the word one, two or three places before. All grades share the
weights; ordered thresholds turn a text's latent value into the probability of each grade, the
expected grade and the tail probability that a grade is reached, by which documents are chosen.

The model is fitted on at most ``FIT_ROWS`` labels (those whose ids hash smallest), each with its
whole text; the scoring of all documents is one pass without a shuffle.

Defined results: a null or empty text has no trigrams and gets the value 0 before thresholds;
without labels every grade but the lowest is equally likely as not; repeated rows and null ids each
get their row; without documents there are no rows; a text of any length is handled whole, in time
proportional to it; other columns are left alone whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, texts, unused
from rowsieve.llm.memory import tidy, tidy_batch
from rowsieve.llm.ordinal import Sparse, fit, labelled_sample, tails
from rowsieve.llm.words import Words, binary, chunks

BITS = 14
#: Distances at which a word may repeat; each has a feature of its own after the bins.
BACK = (1, 2, 3)
WIDTH = (1 << BITS) + len(BACK)
FIT_ROWS = 6000
CHUNK_BYTES = 1 << 20
#: What a share of all trigrams counts; makes usual shares of the size of one.
SCALE = 100.0
REPEAT_SCALE = 5.0


def _bins(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bin of every trigram of the texts, and of each text where its trigrams begin (one entry more)."""
    texts = binary(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(texts.to_pylist()), np.uint8).astype(np.uint32)
    ends = np.cumsum(sizes)
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(len(sizes) + 1, np.int64)
    code = raw[:-2] | (raw[1:-1] << 8) | (raw[2:] << 16)
    bins = ((code * np.uint32(2654435769)) >> np.uint32(32 - BITS)).astype(np.int64)
    inside = np.ones(len(raw), bool)  # trigrams must not reach into the next text
    for back in (1, 2):
        at = ends - back
        inside[at[at >= 0]] = False
    inside = inside[: len(bins)]
    starts = np.concatenate([[0], np.cumsum(inside)])
    places = np.concatenate([[0], np.minimum(ends, len(bins))])
    return bins[inside], starts[places]


def _repeats(texts: pa.Array) -> np.ndarray:
    """Of each text the shares of words that are the same as a word some places before."""
    words = Words(texts)
    out = np.zeros((len(texts), len(BACK)))
    for i, back in enumerate(BACK):
        same = (words.hash[back:] == words.hash[:-back]) & words.whole(back + 1) if len(words.hash) > back else np.zeros(0, bool)
        out[:, i] = np.bincount(words.doc[: len(same)][same], minlength=len(texts))
    return REPEAT_SCALE * out / np.maximum(1, words.count)[:, None]


def _features(batches):
    for batch in batches:
        for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
            bins, at = _bins(part.column("text"))
            places, values = [], []
            last = np.arange(1 << BITS, WIDTH)
            for start, end, repeats in zip(at[:-1], at[1:], _repeats(part.column("text")), strict=True):
                place, n = np.unique(bins[start:end], return_counts=True)
                places.append(np.concatenate([place, last]).astype("<u4").tobytes())
                values.append(np.concatenate([n / max(1, end - start), repeats / SCALE]).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.binary()), pa.array(values, pa.binary()), part.column("grade")], ["places", "values", "grade"]
            )


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def latent(self, texts: pa.Array) -> np.ndarray:
        bins, at = _bins(texts)
        total = np.concatenate([[0.0], np.cumsum(self.weights[bins])])
        shares = SCALE * (total[at[1:]] - total[at[:-1]]) / np.maximum(1, np.diff(at))
        return shares + _repeats(texts) @ self.weights[1 << BITS :]


def train(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    *,
    grades: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """A model of ``grade`` (0 to grades - 1), a column of ``labels``."""
    sample = labelled_sample(docs, labels, grade, fit_rows, id_col=id_col, text_col=text_col)
    rows = sample.mapInArrow(tidy(_features), "places binary, values binary, grade int").collect()
    rows.sort(key=lambda r: (bytes(r.places), bytes(r["values"]), r.grade))
    x = Sparse(
        [np.frombuffer(r.places, "<u4") for r in rows], [np.frombuffer(r["values"], "<f4") * SCALE for r in rows], WIDTH
    )
    return Model(*fit(x, np.array([r.grade for r in rows], np.int64), grades))


def with_grades(docs: DataFrame, model: Model, into: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``into``: expected_grade, and tails, the probabilities that each grade from 1 on is reached."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(text: pa.Array) -> pa.Array:
        model = held.value
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        latent = [model.latent(part.column(0)) for part in chunks(batch, text, CHUNK_BYTES)]
        tail = tails(np.concatenate([*latent, np.zeros(0)]), model.thresholds)
        offsets = np.arange(len(tail) + 1, dtype=np.int32) * tail.shape[1]
        return pa.StructArray.from_arrays(
            [pa.array(tail.sum(axis=1)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(tail.ravel()))],
            ["expected_grade", "tails"],
        )

    score = F.arrow_udf(tidy_batch(score), "struct<expected_grade: double, tails: array<double>>")
    return docs.withColumn(into, score(column(docs, text_col).cast("string")))


def grades(docs: DataFrame, model: Model, *, least: int = 1, probability: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, expected_grade, tail_probability (of grade ``least`` or better), kept."""
    found = with_grades(texts(docs, id_col, text_col), model, "found")
    tail = F.col("found.tails")[least - 1]
    return found.select("doc_id", "found.expected_grade", tail.alias("tail_probability"), (tail >= probability).alias("kept"))


def keep_good(docs: DataFrame, model: Model, *, least: int = 1, probability: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, in all their columns, that reach grade ``least`` with at least this probability."""
    into = unused(docs, "found")
    found = with_grades(docs, model, into, text_col=text_col)
    return found.where(F.col(f"`{into}`.tails")[least - 1] >= probability).drop(into)
