"""Decontamination, substring dedup and near duplicates against plain versions, on odd and random input."""

import random
from collections import Counter

import numpy as np
import pytest

from rowsieve.llm import components, decontaminate, neardup, substrings
from tests.llm import brute
from tests.llm.conftest import odd_items, odd_texts

CONTRACT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def random_docs(spark, seed, n=120):
    """Texts of few words, so that windows, shingles and copies abound."""
    r = random.Random(seed)
    passages = [" ".join(r.choices("abcdefgh", k=r.randint(36, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [r.choice(passages) if r.random() < 0.4 else " ".join(r.choices("abcdefghijklmnop", k=r.randint(0, 45))) for _ in range(r.randint(0, 4))]
        out.append((i, " ".join(parts)))
    return out, spark.createDataFrame(out, "doc_id bigint, text string").repartition(7)


def test_contamination_of_odd_rows(odd_docs, benchmark):
    assert rows(decontaminate.contamination(odd_docs, benchmark), *CONTRACT) == brute.contamination(odd_texts(), odd_items())


def test_contamination_does_not_depend_on_blocks(spark):
    docs, df = random_docs(spark, 1)
    items = [(i, t) for i, (_, t) in enumerate(random_docs(spark, 1, 9)[0])] + [(50, "a b c"), (51, "h g")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute.contamination(docs, items)
    assert rows(decontaminate.contamination(df, bench), *CONTRACT) == expected
    assert rows(decontaminate.contamination(df, bench, block_words=60), *CONTRACT) == expected


def test_decontaminated_texts(odd_docs, benchmark):
    left = decontaminate.decontaminate(odd_docs, benchmark)
    assert left.columns == odd_docs.columns
    expected = Counter((i, t) for i, t in brute.decontaminate(odd_texts(), odd_items()))
    assert rows(left, "doc_id", "text") == expected
    assert rows(decontaminate.decontaminate(odd_docs, benchmark, block_words=60), "doc_id", "text") == expected


def test_nothing_to_compare_with(odd_docs, no_docs, benchmark, no_benchmark):
    assert decontaminate.contamination(no_docs, benchmark).count() == 0
    found = decontaminate.contamination(odd_docs, no_benchmark)
    assert found.where("contaminated or n_items > 0").count() == 0 and found.count() == len(odd_texts())


def expected_removal(docs):
    words, keep = brute.repeated([t for _, t in docs])
    return Counter(
        (i, len(w), k.count(False), brute.sha(" ".join(x for x, y in zip(w, k, strict=True) if y)))
        for (i, _), w, k in zip(docs, words, keep, strict=True)
    )


def test_repeats_of_odd_rows(odd_docs):
    assert rows(substrings.removal_report(odd_docs), "doc_id", "n_words", "n_removed", "kept_sha256") == expected_removal(odd_texts())


def test_repeats_of_random_texts(spark):
    docs, df = random_docs(spark, 2)
    found = substrings.removal_report(df)
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected_removal(docs)
    assert found.agg({"n_removed": "sum"}).first()[0] > 0


def test_texts_without_repeats(odd_docs, no_docs):
    left = substrings.remove_repeats(odd_docs)
    assert left.columns == odd_docs.columns
    words, keep = brute.repeated([t for _, t in odd_texts()])
    found = Counter((r.doc_id, " ".join(brute.spaced(r.text))) for r in left.collect())
    assert found == Counter(
        (i, " ".join(x for x, y in zip(w, k, strict=True) if y)) for (i, _), w, k in zip(odd_texts(), words, keep, strict=True)
    )
    untouched = {i: t for (i, t), k in zip(odd_texts(), keep, strict=True) if all(k) and i is not None}
    assert all(r.text == untouched[r.doc_id] for r in left.collect() if r.doc_id in untouched)
    assert substrings.removal_report(no_docs).count() == 0


NEAR = ["doc_id", "n_shingles", "component_id", "kept"]


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = neardup.clusters(odd_docs)
    assert rows(found, *NEAR) == Counter(brute.clusters(odd_texts()))
    assert found.where("doc_id <> component_id").count() >= 12
    assert neardup.clusters(no_docs).count() == 0


def test_near_duplicates_of_every_size(spark):
    """Sets around the threshold of small ones, and chains that only some members of a group link."""
    r = random.Random(3)
    docs = []
    for group in range(40):
        size = r.choice([1, 2, 4, 6, 9, 20, 60, 66, 68, 70, 75, 85, 90, 95, 150, 400])
        base = [f"g{group}x{i}" for i in range(size)]
        for _ in range(r.randint(1, 7)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, max(1, size // 40)])):
                copy[r.randrange(size)] = f"y{r.randrange(10**6)}"
            docs.append((len(docs), " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert rows(neardup.clusters(df), *NEAR) == Counter(brute.clusters(docs))


def test_one_of_each_group_stays(odd_docs):
    left = neardup.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    kept = [r[0] for r in brute.clusters(odd_texts()) if r[3]]
    assert Counter(r.doc_id for r in left.select("doc_id").collect()) == Counter(kept)


def test_components_of_chains_and_stars(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (7, 100)]
    r.shuffle(links)
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {(n, b) for n, b in found.collect()} == {(i, 0) for i in [*range(1, 61), *range(100, 130)]}


@pytest.mark.parametrize("n_a, n_b, whole", [(70, 90, False), (1000, 800, False), (3000, 9000, False), (20, 30, True), (64, 50, True)])
def test_estimates_are_close(n_a, n_b, whole):
    """Registers agree by chance as often as is computed, and estimates have no bias and the spread of their method."""
    r = np.random.default_rng(5)
    registers = neardup.whole_registers if whole else neardup.registers

    def some(n):
        return r.integers(0, 2**64, n, dtype=np.uint64)

    for share in (0.0, 0.5, 0.75, 0.9):
        errors = []
        for _ in range(40):
            common = some(int(share * min(n_a, n_b)))
            a, b = (np.unique(np.concatenate([common, some(n - len(common))])) for n in (n_a, n_b))
            by_chance = neardup.chance(np.array([len(a)]), np.array([len(b)]), whole)
            x = registers([a, b])
            equal = (x[0] == x[1]).mean()
            errors.append((equal - by_chance[0]) / (1 - by_chance[0]) - len(common) / (len(a) + len(b) - len(common)))
            assert abs(neardup.estimate(x[:1], x[1:], by_chance)[0] - max(0, equal - by_chance[0]) / (1 - by_chance[0])) < 1e-9
        true = len(common) / (n_a + n_b - len(common))
        spread = np.sqrt(max(true * (1 - true), 0.012) / neardup.REGISTERS)
        assert abs(np.mean(errors)) < 4 * spread / np.sqrt(len(errors)) and np.max(np.abs(errors)) < 6 * spread


@pytest.mark.parametrize("whole", [False, True])
def test_codes_have_the_shares_computed(whole):
    for n in (1, 5, 65, 1000, 10**6, 10**9):
        shares = neardup.code_shares(np.array([n]), whole)[0]
        assert abs(shares.sum() - 1) < 1e-6 and shares.min() >= 0
    # More hashes than leading zeros can tell apart leave the mantissa, whose sixteen values are nearly as likely as each other.
    assert 1 / 16 <= neardup.chance(np.array([10**9]), np.array([10**9]), whole)[0] < 0.07


def test_parity_bounds_the_difference():
    r = np.random.default_rng(6)
    for n in (5, 60, 400, 3000):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[n // 7 :], r.integers(0, 2**63, n // 9).astype(np.uint64)]))
        bits = sum(int(x).bit_count() for x in (neardup.parity(a) ^ neardup.parity(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))
