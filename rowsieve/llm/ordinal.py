"""Cumulative-link regression on sparse features, and the bounded sample it is fitted on.

P(grade <= k) = s(t[k] - x w) with s the logistic function, ordered thresholds t and weights w
that all grades share; with two grades this is logistic regression. Fitted by Adam on the whole
sample at once, from fixed starting values, so equal samples give equal models.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import column


def labelled_sample(docs: DataFrame, labels: DataFrame, grade, rows: int, *, id_col: str, text_col: str) -> DataFrame:
    """Columns text and grade of at most ``rows`` labels, those whose ids hash smallest.

    ``grade`` is a column of ``labels``; rows where it or the id is null are not labels. An id that is labelled
    several times counts once, with its largest grade; of the texts of an id the one whose hash is smallest counts.
    """
    graded = labels.select(column(labels, id_col).alias("key"), grade.cast("int").alias("grade")).where(
        "key is not null and grade is not null"
    )
    graded = graded.groupBy("key").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("key"), "key").limit(rows)
    texts = docs.select(column(docs, id_col).alias("key"), column(docs, text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(graded), "key").groupBy("key")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text")))
    return found.agg(one.alias("one"), F.max("grade").alias("grade")).select("one.text", "grade")


class Sparse:
    """Rows of (place, value) pairs."""

    def __init__(self, places: list[np.ndarray], values: list[np.ndarray], width: int):
        self.width = width
        self.place = np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
        self.value = np.concatenate([*values, np.zeros(0)]).astype(np.float64)
        self.row = np.repeat(np.arange(len(places)), [len(p) for p in places])
        self.rows = len(places)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.place], self.rows)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, self.value * g[self.row], self.width)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def tails(latent: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """For each row P(grade > k) for every threshold k; they fall from left to right."""
    return logistic(np.asarray(latent)[:, None] - thresholds[None, :])


def fit(x: Sparse, grade: np.ndarray, grades: int, *, l2: float = 1e-4, steps: int = 150, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds. Without rows, or with rows of one grade only, weights stay 0."""
    w = np.zeros(x.width)
    first, gaps = np.zeros(1), np.zeros(max(0, grades - 2))
    if x.rows:
        share = np.array([(grade > k).mean() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
        start = -np.log(share / (1 - share))
        first = start[:1].copy()
        gaps = np.log(np.maximum(np.diff(start), 1e-2))
    if x.rows and len(np.unique(grade)) > 1:
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, first, gaps)]
        for step in range(1, steps + 1):
            t = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
            latent = x.times(w)
            edges = np.concatenate([[-np.inf], t, [np.inf]])
            upper, lower = (logistic(np.clip(edges[grade + d] - latent, -500, 500)) for d in (1, 0))
            upper = np.where(grade == grades - 1, 1.0, upper)
            lower = np.where(grade == 0, 0.0, lower)
            p = np.maximum(upper - lower, 1e-9)
            du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
            to_latent = (du - dl) / x.rows
            to_edge = np.zeros(grades - 1)
            for k in range(grades - 1):
                to_edge[k] = (dl[grade == k + 1].sum() - du[grade == k].sum()) / x.rows
            grads = (
                x.back(to_latent) + l2 * w,
                np.array([to_edge.sum()]),
                np.exp(gaps) * np.cumsum(to_edge[::-1])[::-1][1:],
            )
            for param, grad, (m, v) in zip((w, first, gaps), grads, state, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, np.concatenate([first, first + np.cumsum(np.exp(gaps))])
