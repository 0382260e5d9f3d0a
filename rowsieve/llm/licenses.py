"""Licence scan: ordered signature rules behind a keyword prefilter, in DataFrame operations alone.

A text's words are intersected with the rules' keywords; only the rules of the keywords it has are
tried, through a broadcast join on the keyword (the rules are fixed, some hundreds of rows). Every
find is an interval of the text. A find inside another one of at least its priority is suppressed;
of equal intervals the earlier rule stands. The finds of a text are sorted once for this, so a
text with very many costs no more than their sort.

Beside the rules there are base phrases, by words alone: their places are counted in any case.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows each get
their row, a null id stays null; other columns are not read; without documents there are no rows.
Texts are handled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.frames import texts
from rowsieve.llm.license_rules import KINDS, rules

#: Base phrases and their labels, fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_SCORE = 0.8
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _rules(spark) -> DataFrame:
    rows = [(r.number, r.label, r.keyword, r.pattern, KINDS[r.kind][0], KINDS[r.kind][1]) for r in rules()]
    return spark.createDataFrame(rows, "number int, label string, keyword string, pattern string, priority int, confidence double")


def _spaced(phrase: str) -> str:
    return " " + "  ".join(phrase.split()) + " "


def _count(spaced: Column, phrase: str) -> Column:
    """Places of a phrase in words that have a space of their own on either side."""
    wanted = _spaced(phrase)
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(wanted), F.lit("")))) / len(wanted)).cast("bigint")


def _before(spaced: Column, phrase: str) -> Column:
    """Words before the first place of a phrase; null without one."""
    wanted = _spaced(phrase)
    head = F.substring_index(spaced, wanted, 1)
    return F.when(F.length(head) < F.length(spaced), _words_in(head))


def _last(spaced: Column, phrase: str, n_words: Column) -> Column:
    wanted = _spaced(phrase)
    tail = F.substring_index(spaced, wanted, -1)
    return F.when(F.length(tail) < F.length(spaced), n_words - _words_in(tail) - len(phrase.split()))


def _words_in(spaced: Column) -> Column:
    spaces = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return (spaces / 2).cast("bigint")


def _base(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base columns, the keywords, and the text as rules see it where it has any."""
    keywords = sorted({r.keyword for r in rules()} | {w for phrase in PHRASES for w in phrase.split()})
    joined = F.trim(F.regexp_replace(F.lower("text"), _NOT_WORD, " "))
    rows = docs.select("doc_id", "text", F.when(F.length(joined) > 0, F.split(joined, " ", -1)).alias("words"))
    rows = rows.select(
        "doc_id",
        "text",
        "words",
        F.coalesce(F.size("words"), F.lit(0)).cast("bigint").alias("n_words"),
        F.coalesce(F.array_intersect("words", F.array(*map(F.lit, keywords))), F.array().cast("array<string>")).alias("has"),
    )
    possible = F.array_contains("has", "license")
    spaced = F.when(possible, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" ")))
    seen = F.when(F.size("has") > 0, F.regexp_replace(F.lower("text"), r"\s+", " "))
    rows = rows.select("doc_id", "n_words", "has", spaced.alias("spaced"), seen.alias("seen"))
    line = F.col("spaced")
    counts = {label: F.coalesce(_count(line, phrase), F.lit(0)) for phrase, label in PHRASES.items()}
    first = F.least(*[_before(line, phrase) for phrase in PHRASES])
    last = F.greatest(*[_last(line, phrase, F.col("n_words")) for phrase in PHRASES])
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_words",
        sum(counts.values(), F.lit(0).cast("bigint")).alias("n_base"),
        first.alias("first_word"),
        last.alias("last_word"),
        F.array_sort(F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for label, n in counts.items()]))).alias("base"),
        "has",
        "seen",
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score, n_finds (those that stand)."""
    rows = _base(texts(docs, id_col, text_col))
    own = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    # Each text goes on once without a keyword, so that it has a row whatever is found.
    tried = rows.select(*own, "seen", F.explode(F.concat(F.array(F.lit(None).cast("string")), "has")).alias("keyword"))
    tried = tried.join(F.broadcast(_rules(docs.sparkSession)), "keyword", "left")
    found = F.when(F.col("pattern").isNotNull(), F.regexp_extract_all("seen", F.col("pattern"), F.lit(0)))
    tried = tried.withColumn("found", found).where("keyword is null or size(found) > 0")
    gaps = F.split("seen", F.col("pattern"), -1)
    parts = F.arrays_zip(
        F.transform(gaps, lambda x: F.length(x)).alias("gap"), F.transform("found", lambda x: F.length(x)).alias("size")
    )
    parts = F.when(F.size("found") > 0, F.slice(parts, 1, F.size("found")))
    finds = tried.select(*own, "number", "label", "priority", "confidence", F.posexplode_outer(parts).alias("place", "part"))
    finds = finds.select(*own, "number", "label", "priority", "confidence", "place", "part.gap", "part.size").repartition("row")
    through = W.partitionBy("row", "number").orderBy("place")
    finds = finds.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(through)).withColumn("start", F.col("end") - F.col("size"))
    before = (
        W.partitionBy("row")
        .orderBy("start", F.col("end").desc(), F.col("priority").desc(), "number", "place")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    levels = sorted({priority for priority, _ in KINDS.values()})
    reach = F.coalesce(
        *[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before)) for p in levels]
    )
    finds = finds.withColumn("reach", reach)
    stands = F.col("end").isNotNull() & (F.col("reach").isNull() | (F.col("reach") < F.col("end")))
    out = finds.groupBy(*own).agg(
        F.collect_set(F.when(stands, F.col("label"))).alias("ruled"),
        F.max(F.when(stands, F.col("confidence"))).alias("best"),
        F.count(F.when(stands, 1)).alias("n_finds"),
    )
    base_score = F.when(F.size("base") > 0, BASE_SCORE).otherwise(0.0)
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "ruled")), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), base_score).alias("score"),
        "n_finds",
    )
