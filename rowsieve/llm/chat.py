"""Conversations rebuilt from event logs and rendered for training, in DataFrame operations alone.

Events have a conversation, a sequence number, a turn, a kind, a role and a text:

* ``message`` starts the turn's message with this text, ``delta`` adds to it;
* ``edit`` replaces what the turn's message holds so far; deltas after it add to it;
* ``regenerate`` starts the turn's message anew and removes what later turns held until then.

The log is partitioned by conversation and folded with windows: of each turn only events from its
last restart on count, and none that an earlier turn's later regeneration removes.

The template marks each turn ``<|im_start|>role``, line feed, text, ``<|im_end|>``, line feed. A
control string inside a text (``CONTROL``) gets a backslash after its first character, one that
already has backslashes there gets one more; so no text contains a raw control string, and taking
one backslash away restores it. In roles, backslash and line feed are escaped.

Defined results: a null text adds nothing, a null role is empty, a null kind is a message; rows whose
conversation is null are one conversation; ties of sequence number go by role, kind and text; rows
without a turn come first, and no regeneration removes them; an empty log has no conversations; other
columns are not read. A conversation is one row of the result
and is put together in one task, as its rendering is one string; its parts stay spread until then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.frames import column

START, STOP = "<|im_start|>", "<|im_end|>\n"
#: What follows ``<`` or ``[`` in a control string.
_REST = r"(?:\|im_start\|>|\|im_end\|>|/?s>|<SYS>>|</SYS>>|/?INST\])"
#: A control string, or one that was escaped any number of times; the second one was escaped.
RAW, ESCAPED = rf"([<\[])(\\*{_REST})", rf"([<\[])\\(\\*{_REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(RAW), F.lit(r"$1\\$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2"))


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def fold(
    events: DataFrame,
    *,
    conv: str = "conv_id",
    seq: str = "seq",
    turn: str = "turn",
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The final messages: conv_id, turn, part (messages of a turn, from their start on), role, text."""
    rows = events.select(
        column(events, conv).alias("conv_id"),
        column(events, seq).alias("seq"),
        column(events, turn).alias("turn"),
        F.coalesce(column(events, kind), F.lit("message")).alias("kind"),
        F.coalesce(column(events, role), F.lit("")).alias("role"),
        F.coalesce(column(events, text), F.lit("")).alias("text"),
    )
    until = W.unboundedPreceding
    earlier = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first()).rangeBetween(until, -1)
    removed = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    removed = F.when(F.col("turn").isNotNull(), removed)  # a window's range takes rows without a turn as before each other
    rows = rows.withColumn("removed", removed).where(F.coalesce(F.col("seq") >= F.col("removed"), F.lit(True)))
    order = [F.col("seq").asc_nulls_first(), "role", "kind", "text"]
    of_turn = W.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(until, 0)
    rows = rows.withColumn("part", F.sum((F.col("kind") == "message").cast("bigint")).over(of_turn))
    of_part = W.partitionBy("conv_id", "turn", "part").orderBy(*order)
    restart = F.col("kind").isin("edit", "regenerate").cast("bigint")
    rows = rows.withColumn("version", F.sum(restart).over(of_part.rowsBetween(until, 0)))
    rows = rows.withColumns(
        {
            "last": F.max("version").over(of_part.rowsBetween(until, W.unboundedFollowing)),
            "at": F.row_number().over(of_part),
            "speaker": F.first("role").over(of_part.rowsBetween(until, W.unboundedFollowing)),
        }
    )
    texts = F.sort_array(F.collect_list(F.struct("at", "text")))
    return (
        rows.where("version = last")
        .groupBy("conv_id", "turn", "part")
        .agg(F.max("speaker").alias("role"), F.array_join(F.transform(texts, lambda x: x["text"]), "").alias("text"))
    )


def render(messages: DataFrame, *, learn: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss: the spans (start, length in code points) that ``learn`` has said."""
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    rows = messages.select("conv_id", "turn", "part", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    before = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "part").rowsBetween(W.unboundedPreceding, -1)
    block = F.concat("head", "body", F.lit(STOP))
    rows = rows.withColumn("offset", F.coalesce(F.sum(F.length(block).cast("bigint")).over(before), F.lit(0).cast("bigint")))
    span = F.struct((F.col("offset") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length"))
    turns = F.sort_array(
        F.collect_list(F.struct("offset", block.alias("block"), F.when(F.col("role") == learn, span).alias("loss")))
    )
    return rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x["block"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what rendered conversations hold: turns, and the text that is learned from."""
    rows = formatted.withColumn("pieces", F.split("formatted", r"<\|im_end\|>\n", -1))
    rows = rows.withColumn("pieces", F.slice("pieces", 1, F.size("pieces") - 1))

    def turn(piece: Column) -> Column:
        piece = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(piece, "\n", 1)
        return F.concat(_unescape_role(role), F.lit("\n"), unescape(F.substr(piece, F.length(role) + 2)), F.lit("\n"))

    learned = F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"].cast("int") + 1, s["length"].cast("int"))))
    rows = rows.withColumn("learned", F.array_join(learned, ""))
    return rows.select(
        "conv_id",
        F.size("pieces").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("pieces", turn), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def events_of_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A log in which each row of a table of turns is a message; ties of a turn go by role and text."""
    return turns.select(
        column(turns, conv).alias("conv_id"),
        F.lit(0).cast("bigint").alias("seq"),
        column(turns, turn).alias("turn"),
        F.lit("message").alias("kind"),
        column(turns, role).alias("role"),
        column(turns, text).alias("text"),
    )


#: What a streamed turn says before it is edited or regenerated.
DRAFT = "</s> draft"
#: Events that a row of a table of turns becomes, one after another: kind and text; ``ahead`` is a draft of the turn after.
STREAMED = {
    # Edited, its next turn begun too early, then regenerated, which takes all that away.
    0: (("message", "draft"), ("edit", "draft"), ("message", "ahead"), ("regenerate", "first"), ("delta", "second")),
    # Regenerated, then edited, and the edit goes on.
    1: (("message", "draft"), ("delta", "draft"), ("regenerate", "draft"), ("edit", "first"), ("delta", "second")),
}


def streamed(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A log of a service that streams the turns of a table, with drafts that edits and regenerations replace.

    A conversation's rows are numbered by turn (null first), role and text, and each becomes five events in that
    order, by turns as in ``STREAMED``; folded, the log gives the table again. A null text or role is empty.
    """
    rows = turns.select(
        column(turns, conv).alias("conv_id"),
        column(turns, turn).cast("bigint").alias("turn"),
        F.coalesce(column(turns, role), F.lit("")).alias("role"),
        F.coalesce(column(turns, text), F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order).cast("bigint"))
    half = F.floor(F.length("text") / 2).cast("int")
    said = {
        "draft": F.lit(DRAFT),
        "ahead": F.lit(DRAFT),
        "first": F.substr("text", F.lit(1), half),
        "second": F.substr("text", half + 1),
    }
    after = F.try_add(F.col("turn"), F.lit(1))

    def log(events) -> Column:
        return F.array(
            *[
                F.struct(
                    (F.col("at") * 8 + i).alias("seq"),
                    (after if what == "ahead" else F.col("turn")).alias("turn"),
                    F.lit(kind).alias("kind"),
                    said[what].alias("text"),
                    F.lit(what == "ahead").alias("ahead"),
                )
                for i, (kind, what) in enumerate(events)
            ]
        )

    events = F.when(F.col("at") % 2 == 0, log(STREAMED[0])).otherwise(log(STREAMED[1]))
    rows = rows.select("conv_id", "role", F.inline(events))
    # There is no turn after one that has no number or the largest one.
    return rows.where("turn is not null or not ahead").select("conv_id", "seq", "turn", "kind", "role", "text")
