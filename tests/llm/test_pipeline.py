"""The pipeline against plain versions of its stages, and every query with SQL against DuckDB."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rowsieve.llm import packing, quality, queries
from tests.llm import brute
from tests.llm.conftest import odd_items, odd_texts
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path):
    texts = odd_texts() + [(200 + i, " ".join(f"p{i}x{j}" for j in range(50))) for i in range(20)]
    texts += [(300 + i, " ".join(f"Q{i}X{j}!!" for j in range(50)).upper()) for i in range(20)]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(odd_items(), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(200 + i, 1, 0) for i in range(20)] + [(300 + i, 0, 0) for i in range(20)] + [(None, 1, None), (7, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), texts


def test_pipeline_equals_its_plain_version(spark, tables):
    tokenizers = pytest.importorskip("tokenizers")
    sf_dir, texts = tables
    model = queries.quality_model(queries.read(spark, sf_dir, "documents"), queries.read(spark, sf_dir, "labels"))
    good = {r.doc_id for r in quality.grades(queries.read(spark, sf_dir, "documents"), model).where("kept").collect()}
    docs = [(i, t) for i, t in texts if i in good]
    assert {i for i, _ in texts if i and 200 <= i < 220} <= good and not good & set(range(300, 320))
    kept = {id(row) for row, found in zip(docs, brute.clusters(docs), strict=True) if found[3]}
    docs = [row for row in docs if id(row) in kept]
    words, keep = brute.repeated([t for _, t in docs])
    left = Counter()
    for (i, _), w, k in zip(docs, words, keep, strict=True):
        left[(i, " ".join(x for x, y in zip(w, k, strict=True) if y))] += 1
    frame = queries.read(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = corpus_pipeline.table(stage(spark, frame, sf_dir), name)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = frame.collect()
    assert Counter((r.doc_id, " ".join(brute.spaced(r.text))) for r in rows) == left
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    clean = brute.decontaminate([(r.doc_id, r.text) for r in rows], odd_items())
    tokenizer = tokenizers.Tokenizer.from_file(packing.default_tokenizer())
    expected = brute.pieces(clean, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected


def test_stages_of_nothing(spark, tables):
    sf_dir, _ = tables
    docs = queries.read(spark, sf_dir, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.table(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0


def test_stages_keep_columns_of_any_name(spark, tables):
    sf_dir, _ = tables
    plain = queries.read(spark, sf_dir, "documents")
    names = ["found", "class", "digest", "component_id", "kept", "words", "n", "TAILS", "hit", "item_id", "a.b"]
    wide = plain.withColumns({f"`{name}`" if "." in name else name: F.xxhash64("doc_id", F.lit(name)) for name in names})
    assert len(wide.columns) == 5 + len(names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, wide = (corpus_pipeline.table(stage(spark, docs, sf_dir), name) for docs in (plain, wide))
        assert wide.columns[:5] == plain.columns and len(wide.columns) == 5 + len(names)
        assert Counter(tuple(r)[:5] for r in wide.collect()) == Counter(tuple(r) for r in plain.collect())
        assert wide.where(F.col("found") != F.xxhash64("doc_id", F.lit("found"))).count() == 0
    packed = [Counter(tuple(r)[:5] for r in corpus_pipeline.pack(spark, docs, sf_dir).collect()) for docs in (plain, wide)]
    assert packed[0] == packed[1]


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test data is not here")
@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(entry.LLM_QUERIES) == {*queries.QUERIES, "pipeline"} and set(entry.LLM_ORACLE) < set(entry.queries())
