"""Connected components of a table of links, by alternating large and small stars.

Every round replaces links by links to smaller neighbours, with one aggregation and one join each;
no neighbourhood is gathered in a task. The number of rounds grows with the logarithm of the
longest chain. What a round leaves is a written table, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.frames import table


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _stars(links: DataFrame) -> DataFrame:
    """Large star, then small star, on links (a, b) with a > b."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """For links (a, b): rows (node, label), label being the smallest node reachable from node.

    The smallest nodes themselves have no row. Links of a node with itself are left out.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = table(ordered.distinct(), "links")
    state = _state(now)
    while state[0]:
        now = table(_stars(now), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
