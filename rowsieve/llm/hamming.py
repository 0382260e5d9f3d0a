"""Exact top-k search in binary codes by incremental multi-index hashing.

A code has a bit for each dimension of the longest vector, in words of 64 bits, where what a vector
does not have is not positive. It is cut into segments, and the index has a row for each segment's value. Two codes
within distance ``m * (r + 1) - 1`` differ in at most r bits in one of the m segments, so probing
each segment with all values within radius r finds every such code. The radius grows from 0; found
codes are verified by their whole distance, and a query is done as soon as its k-th distance is below
``m * (r + 1)``: nothing unseen can be nearer, or as near. Only the others go on.

Equal codes are one entry of the index with its k smallest ids, which is all that a top k with ties
broken by id can need; so a code that a third of all rows have is one row. Everything is DataFrame
operations: a probe is an equi-join on (segment, value), and the bit patterns of a radius are an array,
at most C(16, 8) values whatever the input.

Defined results: a null vector, or one with a null or NaN, has no code and is neither found nor a
query; of rows with the same id all count, and a query's own row is found as well; fewer than k rows
give fewer results; without rows there are none. Other columns are not read.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, shuffle_partitions, table

BITS = 64
SEGMENT = 16
K = 10


def _words(*vectors: DataFrame) -> int:
    """How many words hold a bit for each dimension of the longest ``vector`` of these frames."""
    sizes = [df.agg(F.max(F.size("vector"))).first()[0] for df in vectors]
    return max(1, *[-(-(size or 0) // BITS) for size in sizes])


def sign_code(vector: Column, words: int = 1) -> Column:
    """A word, or an array of several, with one bit for each dimension: whether it is positive; null if any is missing."""
    known = F.filter(vector, lambda x: x.isNotNull() & ~F.isnan(x))

    def word(i: int) -> Column:
        part = F.slice(vector, BITS * i + 1, BITS)
        code = F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, 1).bitwiseOR((x > 0).cast("bigint")))
        # A shorter part has its bits where those of a longer one are; without any there is nothing to move.
        return F.when(F.size(part) == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftleft", code, F.lit(BITS) - F.size(part)))

    return F.when(F.size(known) == F.size(vector), word(0) if words == 1 else F.array(*[word(i) for i in range(words)]))


def _word(code: Column, i: int, words: int) -> Column:
    return code if words == 1 else code[i]


def _distance(one: Column, other: Column, words: int) -> Column:
    bits = [F.bit_count(_word(one, i, words).bitwiseXOR(_word(other, i, words))) for i in range(words)]
    return functools.reduce(lambda a, b: a + b, bits).cast("int")


def _segments(code: Column, segment: int, words: int) -> Column:
    mask = (1 << segment) - 1
    values = [
        F.shiftrightunsigned(_word(code, word, words), segment * i).bitwiseAND(F.lit(mask)).cast("int")
        for word in range(words)
        for i in range(BITS // segment)
    ]
    return F.posexplode(F.array(*values)).alias("segment", "value")


def _patterns(segment: int, radius: int) -> Column:
    """All values of ``segment`` bits with ``radius`` of them set."""
    return F.filter(F.sequence(F.lit(0), F.lit((1 << segment) - 1)), lambda x: F.bit_count(x) == radius)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_code").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    rows: DataFrame,
    queries: DataFrame,
    *,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    segment: int = SEGMENT,
) -> DataFrame:
    """query_id, rank (from 1), id, distance: for each query the k rows with the nearest codes.

    Ties go to the smaller id. Queries with equal codes are searched once.
    """
    if BITS % segment:
        raise ValueError("segments must cut the code evenly")
    words = _words(rows.select(column(rows, vector_col).alias("vector")), queries.select(column(queries, vector_col).alias("vector")))
    parts = words * (BITS // segment)
    codes = rows.select(column(rows, id_col).alias("id"), sign_code(column(rows, vector_col), words).alias("code")).where(
        "id is not null and code is not null"
    )
    smallest = W.partitionBy("code").orderBy("id")
    members = table(
        codes.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k).groupBy("code").agg(
            F.sort_array(F.collect_list("id")).alias("ids")
        ),
        "hamming-codes",
    )
    index = table(members.select("code", _segments(F.col("code"), segment, words)).repartition("segment", "value"), "hamming-index")
    asked = queries.select(column(queries, id_col).alias("query_id"), sign_code(column(queries, vector_col), words).alias("query_code"))
    asked = table(asked.where("query_id is not null and query_code is not null"), "hamming-queries")
    open_ = asked.select("query_code").distinct()
    best = None
    done: list[DataFrame] = []
    for radius in range(segment + 1):
        # One small file, of which many tasks make the probes.
        spread = open_.repartition(shuffle_partitions(rows.sparkSession), "query_code")
        probes = spread.select("query_code", _segments(F.col("query_code"), segment, words))
        probes = probes.select("query_code", "segment", "value", F.explode(_patterns(segment, radius)).alias("pattern"))
        probes = probes.select("query_code", "segment", F.col("value").bitwiseXOR(F.col("pattern")).alias("value"))
        # Probes are too large to be sent everywhere, which their estimated size does not show.
        hits = probes.join(index.hint("merge"), ["segment", "value"])
        distance = _distance(F.col("query_code"), F.col("code"), words)
        near = hits.select("query_code", "code", distance.alias("distance"))
        if best is not None:
            near = near.unionByName(best)
        # Of codes only the k nearest can matter: each has a row at least.
        ranked = W.partitionBy("query_code").orderBy("distance", "code")
        near = near.distinct().withColumn("place", F.dense_rank().over(W.partitionBy("query_code").orderBy("distance")))
        near = near.withColumn("row", F.row_number().over(ranked))
        limit = F.max(F.when(F.col("row") <= k, F.col("place"))).over(W.partitionBy("query_code"))
        near = near.withColumn("limit", limit).where(F.col("place") <= F.col("limit")).select("query_code", "code", "distance")
        near = table(near, "hamming-near")
        found = near.join(members, "code").select("query_code", "distance", F.explode("ids").alias("id"))
        found = _nearest(found, k)
        covered = found.groupBy("query_code").agg(F.max("distance").alias("farthest"), F.count("*").alias("n"))
        last = radius == segment
        is_done = F.lit(last) | ((F.col("n") >= k) & (F.col("farthest") < parts * (radius + 1)))
        ready = table(found.join(covered.where(is_done).select("query_code"), "query_code", "left_semi"), "hamming-found")
        done.append(ready)
        open_ = table(open_.join(ready.select("query_code").distinct(), "query_code", "left_anti"), "hamming-open")
        if last or open_.isEmpty():
            break
        best = near.join(open_, "query_code", "left_semi")
    result = done[0]
    for other in done[1:]:
        result = result.unionByName(other)
    return asked.join(result, "query_code").select("query_id", "rank", "id", "distance")
