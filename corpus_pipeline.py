"""The training-data pipeline: quality, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on every document that the one before left; all but
the last return the columns of the documents. A text that a stage empties stays as an empty
document, so that only decisions about whole documents remove rows: the quality classifier drops
what it rejects, near-duplicate removal all but one document of a group, decontamination documents
that are mostly benchmark.

Defined results: a null text is an empty document; rows whose id is null are never duplicates of
others; rows of one id stay or go together as near duplicates; texts of any length are handled whole;
without labels the classifier keeps all, without benchmark items nothing is contaminated, without
documents each stage has no rows; other columns, whatever their names, go through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm import decontaminate, neardup, packing, quality, queries, substrings
from rowsieve.llm.frames import table


def _counted(docs: DataFrame) -> DataFrame:
    """With n_chars as the text is now, where the documents have such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.quality_model(docs, queries.read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(substrings.remove_repeats(docs))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.decontaminate(docs, queries.read(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeats),
    ("decontaminate", remove_benchmark),
    ("pack", pack),
]

#: The classifier, the tokenizer and the packing are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents; each but the last is written and read again."""
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
