"""Hard negatives of labelled vectors, by exact scores from Four-Russians tables.

A vector's components are integers (``floor(scale * x)``), kept as bit planes in two's complement:
for each plane a byte for every eight dimensions. For an anchor and a group of eight dimensions a
table has the sum of the anchor's components over each of the 256 subsets. So the inner product with a
candidate is, plane by plane from the highest, twice the score so far plus the lookups of that plane's bytes
(the highest plane counts negative): shifts, lookups and sums of integers, and no products.

Anchors meet all rows in blocks: a cell has a block of anchors and a block of rows, both of bounded
size, and gives for each anchor at most k rows, first the positives and in a second pass the
negatives of each positive. Of the cells' results again the first k count. Rows are dealt to blocks by the
hash of the whole row, so no label, id or vector makes a block larger than others; rows that are alike in
all three are one row with a count until the results are spread out again.

Defined results: rows with a null id, a null label, a null vector or a component that is null, NaN or
infinite take no part; of vectors of different lengths the shorter one ends in zeros; rows with the same id
are rows of their own (an other row of the same label may have the anchor's id), so repeated
anchors give repeated results; an anchor without positives, or a positive without negatives, gives
no row; without rows there are none; other columns are not read. Components so large that a score
could leave 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, shuffle_partitions, table
from rowsieve.llm.memory import give_back, tidy

GROUP = 8
#: Anchors and rows of a cell, at most in the mean: its tables and scores take some dozen MB.
ANCHORS, ROWS = 1024, 1 << 17
#: Rows of a block where there are few: more cells then, for more tasks.
FEW_ROWS = 4096
#: Rows whose scores are held at a time.
_AT_ONCE = 2048


def eligible(rows: DataFrame, *, id_col: str, label_col: str, vector_col: str, scale: float) -> DataFrame:
    """id, label, vector (integers) of the rows that take part."""
    plain = rows.select(
        column(rows, id_col).alias("id"),
        column(rows, label_col).cast("bigint").alias("label"),
        column(rows, vector_col).cast("array<double>").alias("vector"),
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    plain = plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    return plain.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint")))


def _sizes(vectors: DataFrame) -> tuple[int, int, int]:
    """The longest vector, the planes that hold every component, and a bound of the scores."""
    low, high, longest = vectors.agg(
        F.min(F.array_min("vector")), F.max(F.array_max("vector")), F.max(F.size("vector"))
    ).first()
    low, high, longest = low or 0, high or 0, longest or 0
    planes = 1 + max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0)
    return longest, planes, longest * max(abs(low), abs(high)) ** 2


def _packer(longest: int, planes: int) -> Callable:
    groups = -(-longest // GROUP)

    def pack(batches):
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            dense = np.zeros((len(vectors), groups * GROUP), np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            dense[np.arange(groups * GROUP) < sizes[:, None]] = flat
            bits = [np.packbits(((dense >> plane) & 1).astype(np.uint8), axis=1, bitorder="little") for plane in range(planes)]
            packed = np.stack(bits, axis=1).reshape(len(vectors), -1) if groups else np.zeros((len(vectors), 0), np.uint8)
            rows = pa.array([x.tobytes() for x in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), rows], ["id", "label", "planes"])

    return tidy(pack)


def _bytes(rows: pa.Table, planes: int, groups: int) -> np.ndarray:
    """The packed planes of a table's rows: (row, plane, group)."""
    raw = b"".join(rows.column("planes").to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(rows.num_rows, planes, groups)


def subset_tables(anchors: np.ndarray, dtype: type) -> np.ndarray:
    """For packed anchors (anchor, plane, group): (group, subset, anchor), the sum over each subset of eight components."""
    n, planes, groups = anchors.shape
    bits = np.unpackbits(anchors, axis=2, bitorder="little").astype(np.int64)  # (anchor, plane, dimension)
    weights = np.int64(1) << np.arange(planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    vectors = np.tensordot(weights, bits, (0, 1)).astype(dtype)
    sums = np.zeros((groups, 1 << GROUP, n), dtype)
    for bit in range(GROUP):
        # Each subset with this highest member is one without it and the member.
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + vectors[:, bit::GROUP].T[:, None, :]
    return sums


def scores(tables: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(row, anchor) inner products, for packed rows (row, plane, group)."""
    groups, _, n = tables.shape
    total = np.zeros((len(rows), n), tables.dtype)
    planes = rows.shape[1]
    for plane in reversed(range(planes)):
        if plane != planes - 1:
            total <<= 1
        for group in range(groups):
            found = tables[group][rows[:, plane, group]]
            if plane == planes - 1:
                total -= found
            else:
                total += found
    return total


def _first(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first; of equal ones those that come first."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.argsort(-score[at], kind="stable")[:k]]


class _Cell:
    """The scores of one cell, a slice of rows at a time; rows come in the order of their ids."""

    def __init__(self, planes: int, groups: int, dtype: type):
        self.planes, self.groups, self.dtype = planes, groups, dtype

    def slices(self, anchors: pa.Table, rows: pa.Table):
        rows = rows.sort_by("id")
        tables = subset_tables(_bytes(anchors, self.planes, self.groups), self.dtype)
        ids, labels, n = (rows.column(c).to_numpy() for c in ("id", "label", "n"))
        packed = _bytes(rows, self.planes, self.groups)
        for start in range(0, rows.num_rows, _AT_ONCE):
            part = slice(start, start + _AT_ONCE)
            yield ids[part], labels[part], n[part], packed[part], scores(tables, packed[part])


def _positives_of(cell: _Cell, k: int) -> Callable:
    """For each anchor the first k rows of its label in this cell; a row that is the anchor's counts once less."""

    def found(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        label = anchors.column("label").to_numpy()
        own_id = anchors.column("id").to_numpy()
        own = _bytes(anchors, cell.planes, cell.groups)
        out: list[tuple] = []
        for ids, labels, n, packed, score in cell.slices(anchors, rows):
            for a in range(len(label)):
                same = np.flatnonzero(labels == label[a])
                alike = same[(ids[same] == own_id[a]) & (packed[same] == own[a]).all(axis=(1, 2))]
                left = n[same] - np.isin(same, alike)
                same, left = same[left > 0], left[left > 0]
                at = _first(score[same, a], k)
                out += [(a, int(ids[i]), int(c), int(score[i, a])) for i, c in zip(same[at], left[at])]
        return _found(anchors, out, k)

    return found


def _negatives_of(cell: _Cell, k: int, low: int, high: int) -> Callable:
    """For each positive the first k rows of other labels in this cell whose score is near enough below."""

    def found(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        label = anchors.column("label").to_numpy()
        limits = [np.array(x, np.int64) for x in anchors.column("positives").to_pylist()]
        out: list[tuple] = []
        for ids, labels, n, _, score in cell.slices(anchors, rows):
            for a, limit in enumerate(limits):
                one = score[:, a].astype(np.int64)
                near = (labels != label[a]) & (100 * one <= high * limit.max()) & (100 * one >= low * limit.min())
                other = np.flatnonzero(near)
                for positive in limit.tolist() if len(other) else ():
                    fits = other[(100 * one[other] <= high * positive) & (100 * one[other] >= low * positive)]
                    out += [(a, int(ids[i]), int(n[i]), int(one[i]), positive) for i in fits[_first(one[fits], k)]]
        return _found(anchors, out, k, "positive")

    return found


def _found(anchors: pa.Table, out: list[tuple], k: int, *of: str) -> pa.Table:
    """The first k of ``out`` (anchor's place, id, count, score, and what else a group is of) for each group."""
    columns = np.array(out, np.int64).reshape(len(out), 4 + len(of)).T
    anchor, ids, _, score, *group = columns
    order = np.lexsort((ids, -score, *group, anchor))
    columns = columns[:, order]
    starts = np.ones(len(out), bool)
    starts[1:] = (np.diff(columns[[0, *range(4, 4 + len(of))]], axis=1) != 0).any(axis=0)
    place = np.arange(len(out))
    columns = columns[:, place - np.maximum.accumulate(np.where(starts, place, 0)) < k]
    kept = anchors.select(["key"]).take(pa.array(columns[0]))
    for name, values in zip(["id_found", "n_found", "score", *of], columns[1:]):
        kept = kept.append_column(name, pa.array(values))
    give_back()
    return kept


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _cells(anchors: DataFrame, rows: DataFrame, work: Callable, of: list[str], across: int, down: int) -> DataFrame:
    """Each block of anchors with each block of rows; ``work`` gets both as tables, if both have rows."""
    numbers = ["id_found", "n_found", "score", *of]
    key = pa.struct([("id", pa.int64()), ("label", pa.int64()), ("planes", pa.binary())])
    nothing = pa.schema([("key", key), *((name, pa.int64()) for name in numbers)]).empty_table()

    def in_cell(some: pa.Table, others: pa.Table) -> pa.Table:
        return work(some, others) if some.num_rows and others.num_rows else nothing

    schema = "key struct<id: bigint, label: bigint, planes: binary>, " + ", ".join(f"{name} bigint" for name in numbers)

    def block(n: int, *of) -> Column:
        # As an int on both sides: numbers of different types are dealt differently.
        return F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")

    places = F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down")
    left = anchors.select("*", block(across, F.lit(1), "key").alias("across"), places)
    places = F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across")
    # Columns of their own on the right, as both sides come from the same table.
    own = [F.col(c).alias(c) for c in rows.columns]
    right = rows.select(*own, block(down, F.lit(2), "id", "label", "planes").alias("down"), places)
    # A cell is much work for few bytes, so tasks are not merged by size.
    tasks = min(across * down, shuffle_partitions(rows.sparkSession))
    left, right = (side.repartition(tasks, "across", "down").groupBy("across", "down") for side in (left, right))
    return left.cogroup(right).applyInArrow(in_cell, schema)


def _leading(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """Of each group the first k rows, counting copies, with ``rank`` from 1."""
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), "id_found")
    some = found.withColumn("n_found", F.least("n_found", F.lit(k)))
    some = some.withColumn("before", F.sum("n_found").over(order.rowsBetween(W.unboundedPreceding, -1)))
    some = some.where(F.coalesce("before", F.lit(0)) < k)
    each = some.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_found"))).alias("copy"))
    each = each.withColumn("rank", (F.coalesce("before", F.lit(0)) + F.col("copy")).cast("int"))
    return each.where(F.col("rank") <= k).drop("before", "copy", "n_found")


def mine(
    rows: DataFrame,
    is_anchor: Column,
    *,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the eligible rows for which ``is_anchor``, a condition on ``id``, holds. A negative of a positive
    has another label than the anchor and a score from ``low`` to ``high`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    vectors = eligible(rows, id_col=id_col, label_col=label_col, vector_col=vector_col, scale=scale)
    longest, planes, bound = _sizes(vectors)
    if bound * max(100, abs(low), abs(high)) >= 1 << 63:
        raise ValueError("components are too large: scores could leave 64 bits")
    groups = -(-longest // GROUP)
    # Sums are right modulo the type's range on the way, so only the score itself has to fit.
    cell = _Cell(planes, groups, np.int32 if bound < 1 << 31 else np.int64)
    id_type = dict(vectors.dtypes)["id"]
    packed = vectors.mapInArrow(_packer(longest, planes), f"id {id_type}, label bigint, planes binary")
    packed = packed.select(F.col("id").cast("bigint").alias("id"), "label", "planes")
    packed = table(packed.groupBy("id", "label", "planes").agg(F.count("*").alias("n")), "negatives-rows")
    anchors = packed.where(is_anchor).withColumn("key", F.struct("id", "label", "planes"))
    n_rows, n_anchors = packed.count(), anchors.count()
    across = _blocks(n_anchors, ANCHORS)
    down = max(_blocks(n_rows, ROWS), min(_blocks(n_rows, FEW_ROWS), shuffle_partitions(spark)))

    first = _cells(anchors, packed, _positives_of(cell, positives), [], across, down)
    first = _leading(first, ["key"], positives).select("key", F.col("id_found").alias("positive_id"), F.col("score").alias("positive"))
    pairs = table(first, "negatives-positives")
    limits = pairs.groupBy("key").agg(F.collect_set("positive").alias("positives"))
    asked = limits.select("key", "key.*", "positives")
    near = _cells(asked, packed, _negatives_of(cell, negatives, low, high), ["positive"], across, down)
    near = _leading(near, ["key", "positive"], negatives)
    copies = anchors.select("key", "n")
    out = pairs.join(near, ["key", "positive"]).join(copies, "key")
    return out.select(
        F.col("key.id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id_found").alias("negative_id"),
        F.col("positive").alias("positive_score"),
        F.col("score").alias("negative_score"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"),
    ).drop("copy")
