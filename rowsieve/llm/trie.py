"""The prefix trie of conversations, from weighted whole sequences.

A node is a distinct sequence of first turns (role and text), from the root, which has none. Identical
conversations are one sequence with a weight, its smallest conversation and the list of those that end there.
Sequences that are proper prefixes of others are dropped by an anti-join; what remains are the leaves.
The prefixes of all sequences, with their weights, add up to the nodes.

A turn is known by two 64-bit hashes of its position, its role and the SHA-256 of its text, and a prefix by
the exclusive or of its turns' hashes, so a parent is its child's digest without the last turn's hashes. What a subtree
saves is the sum of (members - 1) x words over its nodes. The members' part is a sum of weighted words to
the end of each sequence; the nodes' own part counts each node once, on the sequence that has the node's smallest
conversation. Such a sequence has its nodes from some depth on, so one number per sequence is enough,
and no node is compared with those below it.

No conversation is put together in one task: positions come from ranges of the sorted rows, with a sum
for each (conversation, range), and prefixes from blocks of ``BLOCK`` positions, with a sum for each (conversation,
block). Equal rows are one row with a count until they get their positions. Only the SHA-256 of a list of
members, which has no parallel form, is computed in order: from strings of up to ``PIECE`` members, as a stream.

Defined results: rows without a conversation take no part; turns come by turn number (null first), ties
by role and by the SHA-256 of the text, and repeated rows are turns of their own; a null role or text is empty; texts
of any length count whole; a conversation without turns ends at the root; without conversations there are no
nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.frames import column, table
from rowsieve.llm.memory import tidy

#: Positions of a conversation that are handled together, as a power of two.
BLOCK = 12
#: Members in one string, as a power of two.
PIECE = 9
_WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "d1", "d2"]
_BEFORE = W.unboundedPreceding, -1


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _range_of(at: str) -> Column:
    """The partition in which ``monotonically_increasing_id`` was given."""
    return F.shiftright(at, 33)


def numbered(
    conversations: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Runs of equal turns with their first position (from 1), and each conversation's ranges.

    Runs: conv, part, inside (turns before, in this part), n, role, hash, words. Ranges: conv, part, before, length.
    """
    said = F.coalesce(column(conversations, text).cast("string"), F.lit(""))
    rows = conversations.select(
        column(conversations, conv).cast("bigint").alias("conv"),
        column(conversations, turn).alias("turn"),
        F.coalesce(column(conversations, role).cast("string"), F.lit("")).alias("role"),
        F.sha2(said.cast("binary"), 256).alias("hash"),
        F.regexp_count(said, F.lit(_WORD)).cast("bigint").alias("words"),
    ).where("conv is not null")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "hash"]
    runs = rows.groupBy("conv", "turn", "role", "hash", "words").agg(F.count("*").alias("n"))
    runs = runs.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = table(runs.withColumn("at", F.monotonically_increasing_id()), "trie-runs").withColumn("part", _range_of("at"))
    inside = F.coalesce(F.sum("n").over(W.partitionBy("conv", "part").orderBy("at").rowsBetween(*_BEFORE)), _zero())
    ranges = runs.groupBy("conv", "part").agg(F.sum("n").alias("n"))
    of_conv = W.partitionBy("conv")
    ranges = ranges.select(
        "conv",
        "part",
        F.coalesce(F.sum("n").over(of_conv.orderBy("part").rowsBetween(*_BEFORE)), _zero()).alias("before"),
        F.sum("n").over(of_conv).alias("length"),
    )
    return runs.select("conv", "part", inside.alias("inside"), "n", "role", "hash", "words"), table(ranges, "trie-ranges")


def _placed(runs: DataFrame, ranges: DataFrame, until: int | None = None) -> DataFrame:
    """A row for each turn, up to a position; ``ranges`` has what else to keep of its conversation."""
    found = runs.join(ranges, ["conv", "part"]).withColumn("from", F.col("before") + F.col("inside") + 1)
    found = found.withColumn("to", F.col("from") + F.col("n") - 1)
    if until is not None:
        found = found.where(F.col("from") <= until).withColumn("to", F.least("to", F.lit(until)))
    # Block by block, so that no array is as long as a run.
    found = found.withColumn("block", F.explode(F.sequence(F.shiftright("from", BLOCK), F.shiftright("to", BLOCK))))
    start = F.shiftleft("block", BLOCK)
    inside = F.sequence(F.greatest("from", start), F.least(F.col("to"), start + ((1 << BLOCK) - 1)))
    return found.withColumn("pos", F.explode(inside)).drop("before", "inside", "n", "part", "from", "to", "block")


def _hashed(turns: DataFrame) -> DataFrame:
    marks = [F.xxhash64(F.lit(seed), "pos", "role", "hash").alias(f"e{seed}") for seed in (1, 2)]
    return turns.select("conv", "pos", *marks, "words")


def rebuilt(
    runs: DataFrame, ranges: DataFrame, *, base: Column | None = None, head: Column | None = None, longest: int = 3
) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, e1, e2, words) and conversations (conv), in written tables.

    With ``base`` and ``head``, expressions of ``conv``, the first ``head`` turns (at most ``longest``) are those of
    the conversation ``base``, all if it has fewer and none if there is none; a conversation's own follow from there on.
    """
    convs = ranges.select("conv", "length").distinct()
    if base is None or head is None:
        return table(_hashed(_placed(runs, ranges.drop("length"))), "trie-turns"), convs.select("conv")
    convs = convs.select("conv", base.alias("base"), F.least(head, F.lit(longest)).alias("head"))
    lengths = ranges.select(F.col("conv").alias("base"), F.col("length").alias("there")).distinct()
    convs = convs.join(lengths, "base", "left")
    convs = table(convs.withColumn("taken", F.least("head", F.coalesce("there", _zero()))), "trie-conversations")
    own = _placed(runs, ranges.join(convs, "conv").select("conv", "part", "before", "head", "taken"))
    own = own.where("pos > head").withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    heads = _placed(runs, ranges.where(F.col("before") < longest).drop("length"), longest)
    heads = heads.withColumnRenamed("conv", "base").join(convs, "base").where("pos <= taken")
    turns = own.select("conv", "pos", "role", "hash", "words").unionByName(heads.select("conv", "pos", "role", "hash", "words"))
    return table(_hashed(turns), "trie-turns"), convs.select("conv")


def sequences(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation's end (conv, depth, d1, d2), and the distinct sequences with weight, first and words."""
    ends = turns.groupBy("conv").agg(
        F.max("pos").alias("depth"), F.bit_xor("e1").alias("d1"), F.bit_xor("e2").alias("d2"), F.sum("words").alias("total")
    )
    columns = [*_KEY, "total"]
    ends = convs.join(ends, "conv", "left").select("conv", *[F.coalesce(c, _zero()).alias(c) for c in columns])
    ends = table(ends, "trie-ends")
    whole = ends.groupBy(*_KEY).agg(F.count("*").alias("weight"), F.min("conv").alias("first"), F.max("total").alias("total"))
    return ends, table(whole, "trie-sequences")


def _paths(turns: DataFrame, whole: DataFrame) -> DataFrame:
    """For each sequence and position, from its first conversation: the node there, its parent, and the words before."""
    turns = turns.withColumn("block", F.shiftright("pos", BLOCK))
    blocks = turns.groupBy("conv", "block").agg(
        F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"), F.sum("words").alias("words_there")
    )
    before = W.partitionBy("conv").orderBy("block").rowsBetween(*_BEFORE)
    blocks = blocks.select(
        "conv",
        "block",
        F.coalesce(F.bit_xor("b1").over(before), _zero()).alias("b1"),
        F.coalesce(F.bit_xor("b2").over(before), _zero()).alias("b2"),
        F.coalesce(F.sum("words_there").over(before), _zero()).alias("words_there"),
    )
    blocks = blocks.join(whole.select(F.col("first").alias("conv"), F.col("depth").alias("length"), "weight", "total"), "conv")
    found = turns.join(blocks, ["conv", "block"])
    so_far = W.partitionBy("conv", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    found = found.withColumns(
        {
            "d1": F.col("b1").bitwiseXOR(F.bit_xor("e1").over(so_far)),
            "d2": F.col("b2").bitwiseXOR(F.bit_xor("e2").over(so_far)),
            "before": F.col("words_there") + F.sum("words").over(so_far) - F.col("words"),
        }
    )
    return table(
        found.select(
            F.col("conv").alias("first"),
            "block",
            F.col("pos").alias("depth"),
            "d1",
            "d2",
            F.col("d1").bitwiseXOR(F.col("e1")).alias("p1"),
            F.col("d2").bitwiseXOR(F.col("e2")).alias("p2"),
            "before",
            "length",
            "weight",
            "total",
        ),
        "trie-paths",
    )


def _with_roots(paths: DataFrame, whole: DataFrame) -> DataFrame:
    roots = whole.select("first", F.col("depth").alias("length"), "weight", "total")
    for name in ("block", *_KEY, "p1", "p2", "before"):
        roots = roots.withColumn(name, _zero())
    return paths.unionByName(roots.select(*paths.columns))


def leaves(whole: DataFrame, paths: DataFrame) -> DataFrame:
    """The sequences that are no proper prefix of another."""
    inner = _with_roots(paths, whole).where("depth < length").select(*_KEY).distinct()
    return whole.join(inner, _KEY, "left_anti")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's strings, joined by commas, where those of a key come in order and together."""
    now, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for *key, members in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "members"])):
            if key != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(members.encode())
        yield _lists(done)
    if now is not None:
        yield _lists([(*now, digest.hexdigest())])


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_KEY, "ends_sha256"])


def end_lists(ends: DataFrame) -> DataFrame:
    """For each sequence the SHA-256 of its conversations, in ascending order."""
    order = [*_KEY, "conv"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = table(ordered.withColumn("at", F.monotonically_increasing_id()), "trie-members")
    pieces = ordered.groupBy(*_KEY, F.shiftright("at", PIECE).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("members")
    )
    pieces = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece")
    return pieces.mapInArrow(tidy(_hash_lists), "depth bigint, d1 bigint, d2 bigint, ends_sha256 string")


def nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each node, of what :func:`rebuilt` gives.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ends, whole = sequences(turns, convs)
    paths = _paths(turns, whole)
    spread = _with_roots(paths, whole)
    # Where a sequence is the smallest of a node it is so from there on: the words before the first such node.
    smallest = spread.groupBy(*_KEY).agg(F.min("first").alias("first"), F.max("before").alias("owned_from"))
    owned = smallest.groupBy("first").agg(F.min("owned_from").alias("owned_from"))
    last = leaves(whole, paths).select("first", F.lit(1).cast("bigint").alias("leaf"))
    facts = whole.select("first").join(owned, "first", "left").join(last, "first", "left")
    facts = table(facts.select("first", "owned_from", F.coalesce("leaf", _zero()).alias("leaf")), "trie-facts")
    by_block = spread.select("first", "block").distinct().join(facts, "first")
    members = F.col("weight") * (F.col("total") - F.col("before"))
    own = F.coalesce(F.col("total") - F.greatest("before", F.col("owned_from")), _zero())
    own = F.when(F.col("owned_from").isNull(), _zero()).otherwise(own)
    found = spread.join(by_block, ["first", "block"]).groupBy(*_KEY).agg(
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.min("first").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(members - own).alias("saved_tokens"),
    )
    found = table(found, "trie-nodes")
    mine = [c for c in found.columns if c not in _KEY]
    children = found.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"), F.lit(1).cast("bigint").alias("n_children")
    )
    parts = found.unionByName(children, allowMissingColumns=True).unionByName(end_lists(ends), allowMissingColumns=True)
    full = parts.groupBy(*_KEY).agg(
        *[F.max(c).alias(c) for c in mine], F.sum("n_children").alias("n_children"), F.max("ends_sha256").alias("ends_sha256")
    )
    parents = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    # A parent of very many children makes a large partition on the left, which Spark splits.
    return full.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", _zero()).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def trie(conversations: DataFrame, *, base: Column | None = None, head: Column | None = None, **columns: str) -> DataFrame:
    """The nodes of a table of turns; see :func:`numbered` for the columns, :func:`rebuilt` for ``base`` and ``head``."""
    runs, ranges = numbered(conversations, **columns)
    return nodes(*rebuilt(runs, ranges, base=base, head=head))
