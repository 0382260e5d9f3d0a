"""Language-model, toxicity and quality scores: exact parts against plain versions, the rest by held-out results."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from rowsieve.llm import mixing, ordinal, quality, toxicity
from tests.llm import brute
from tests.llm.conftest import odd_texts


def remainder(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def base_scores(docs):
    tokens = [[*brute.spaced(brute.lower(t)), None] for _, t in docs]
    train = Counter(x for (i, _), w in zip(docs, tokens, strict=True) if remainder(i, 7) != 2 for x in w)
    n, v = sum(train.values()), len(train)
    return Counter(
        (i, remainder(i, 7) == 2, len(w), sum(train[x] > 0 for x in w), n, round(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w), 4))
        for (i, _), w in zip(docs, tokens, strict=True)
    )


def test_base_score(odd_docs, no_docs):
    found = mixing.score(odd_docs).collect()
    exact = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    assert exact == base_scores(odd_texts())
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert mixing.score(no_docs).count() == 0


def test_predictions_are_a_distribution():
    """All tokens of up to two letters of a small alphabet, and what is left for longer ones."""
    tokens = [b"ab", b"abc", b"b", b"", b"abab"]
    counts = np.array([5, 3, 20, 9, 1])
    codes = np.zeros(mixing._STARTS[-1], np.uint16)
    for block in mixing._table_blocks([pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array(counts)], ["token", "n"])]):
        part = np.frombuffer(zlib.decompress(block.column(1)[0].as_py()), np.float64).reshape(2, -1)
        start = block.column(0)[0].as_py() * mixing.BLOCK
        codes[start : start + part.shape[1]] = (mixing.coded(part[0]) << 8) | mixing.coded(part[1])
    mixer = mixing.Mixer(codes)
    mixer.learn(tokens, counts)
    every = [bytes([x]) for x in range(256) if x != 32]
    one = 10 ** mixer.log10(every)
    two = 10 ** mixer.log10([x + bytes([y]) for x in every for y in range(256) if y != 32])
    end = 10 ** mixer.log10([b""])
    # What begins with a byte and is closed at once or goes on: closed ones and those of two bytes are below the whole.
    assert end.sum() + one.sum() + two.sum() < 1
    assert mixer.log10([b"b"])[0] > mixer.log10([b"q"])[0]


def test_adapting_is_causal_and_proper():
    r = random.Random(1)
    doc = np.repeat([0, 1, 2], [40, 1, 60])
    token = np.array([r.randrange(6) for _ in doc])
    score = np.full(len(doc), math.log10(1 / 6))
    whole = mixing.adapted(doc, token, score)
    for at in (3, 20, 39, 45, 100):
        total = 0.0
        for other in range(6):
            changed = token.copy()
            changed[at] = other
            again = mixing.adapted(doc, changed, score)
            assert np.allclose(again[:at], whole[:at])
            total += 10 ** again[at]
        assert total == pytest.approx(1.0, abs=1e-9)


def test_model_beats_counts_on_held_out_texts(spark):
    r = random.Random(2)
    syllables = ["ba", "ne", "tor", "si", "lu", "ven", "kra", "mo"]
    lines = [" ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(12)) for _ in range(4)]

    def text():
        out = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(30, 90))]
        return " ".join(out + [r.choice(lines)] * r.randint(0, 4))

    docs = spark.createDataFrame([(i, text()) for i in range(600)], "doc_id bigint, text string")
    row = mixing.score(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.count("*").alias("n")).first()
    assert row.n > 50 and row.s > row.b


INSULTS = ("idiot", "moron", "loser", "scum")


def labelled(spark, n=900):
    r = random.Random(3)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(20, 60))]
        toxic = r.random() < 0.25
        poor = not toxic and r.random() < 0.3
        if toxic:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(INSULTS)
        if poor:
            words = [f"{w.upper()}!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if poor else 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def toxic(spark):
    docs, labels = labelled(spark)
    return docs, labels, toxicity.train(docs, labels)


def test_toxic_held_out_texts_are_found(toxic):
    docs, labels, model = toxic
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.93
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)


def test_disguises_are_restored(toxic):
    decoder = toxicity.Decoder(toxic[2].trigrams)
    for written, meant in ((b"m0r0n", b"moron"), (b"i d i o t", b"idiot"), (b"l.o.s.e.r", b"loser"), (b"an IDIOOOT!!", b"an idiot!!"), (b"$cum", b"scum")):
        assert decoder.text(written) == meant
    for plain in (b"on the 3 and 25 hand.", b"ha!!! ***", b"a b", "hé 中".encode()):
        assert decoder.text(plain) == plain
    long = b"1d10t" * 20_000
    assert len(decoder.text(long)) <= len(long)


def test_scores_of_odd_rows(odd_docs, no_docs, no_labels, toxic):
    model = toxic[2]
    found = toxicity.score(odd_docs, model).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in odd_texts())
    prior = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(prior) == 1 and 0 < prior.pop() < 0.5
    assert toxicity.score(no_docs, model).count() == 0
    untrained = toxicity.train(odd_docs, no_labels)
    assert {r.score for r in toxicity.score(odd_docs, untrained).select("score").distinct().collect()} == {0.5}


def grade():
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)


def test_poor_texts_are_rejected_and_clean_ones_kept(spark, odd_docs, no_docs, no_labels):
    docs, labels = labelled(spark)
    even = labels.where("doc_id % 2 = 0")
    model = quality.train(docs, even, grade(), grades=3)
    rows = quality.grades(docs.where("doc_id % 2 = 1"), model).join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.97
    assert all(0 <= r.expected_grade <= 2 for r in rows)
    found = quality.grades(odd_docs, model)
    assert Counter(r.doc_id for r in found.collect()) == Counter(i for i, _ in odd_texts())
    assert quality.keep_good(odd_docs, model).columns == odd_docs.columns
    assert quality.grades(no_docs, model).count() == 0
    untrained = quality.train(odd_docs, no_labels, F.col("grade"), grades=3)
    assert quality.keep_good(odd_docs, untrained).count() == len(odd_texts())


def test_ordinal_fit_recovers_thresholds():
    r = np.random.default_rng(6)
    rows, width = 4000, 5
    dense = r.normal(size=(rows, width))
    w = np.array([1.5, -1.0, 0.5, 0.0, 0.2])
    latent = dense @ w + r.logistic(size=rows)
    observed = np.digitize(latent, [-1.0, 0.5, 2.0])
    x = ordinal.Sparse([np.arange(width)] * rows, list(dense), width)
    found, thresholds = ordinal.fit(x, observed, 4, steps=400)
    assert np.allclose(found, w, atol=0.15) and np.allclose(thresholds, [-1.0, 0.5, 2.0], atol=0.15)
    tails = ordinal.tails(x.times(found), thresholds)
    assert (np.diff(tails, axis=1) <= 0).all()


def test_labels_of_one_id_and_null_labels(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (99999, 1)], "doc_id bigint, toxic int")
    sample = ordinal.labelled_sample(odd_docs, labels, F.col("toxic"), 10, id_col="doc_id", text_col="text")
    assert [tuple(x) for x in sample.collect()] == [("one two three", 1)]


def test_contexts_keep_their_own_counts():
    """As many contexts as a table of fixed size cannot hold: none takes over another one's counts, and a new one is unseen."""
    r = random.Random(7)
    tokens = sorted({bytes(r.choices(range(97, 123), k=10)) for _ in range(60_000)})
    n = np.array([1 + i % 5 for i in range(len(tokens))])
    known, other = tokens[::2], tokens[1::2]
    lot = pa.table({"token": pa.array(known + other, pa.binary()), "n": np.concatenate([n[::2], np.zeros(len(other), np.int64)]), "lot": pa.repeat(0, len(tokens))})
    asked = mixing._asked(3)(lot)
    parts = [mixing._answered(asked.filter(pc.equal(asked["share"], i))) for i in range(3)]
    ordered, _ = mixing._lot(lot)
    found = mixing.Found.of(ordered, pa.concat_tables(parts))
    contexts = mixing.Contexts(ordered)
    follows: Counter = Counter()
    for token, times in zip(known, n[::2].tolist(), strict=True):
        for at, byte in enumerate(token + b" "):
            follows[token[:at], byte] += times
    for at in range(0, len(contexts.bytes), 97):
        token, place = ordered[contexts.token[at]], int(contexts.at[at])
        code = int(found.codes[7][found.places[-1][at]])
        byte = int(contexts.bytes[at])
        expected = [follows[token[:place], byte & ~1 | bit] for bit in (0, 1)]
        assert code == (int(mixing.coded(np.array(expected))[0]) << 8 | int(mixing.coded(np.array(expected))[1]))


def test_order_of_words_is_learned_from_training_texts(spark):
    """The same words in the order of training texts and in another one: no pair of words repeats within a text."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    follows = {w: words[(i + 1) % 60] for i, w in enumerate(words)}

    def ordered(start, n=30):
        out = [start]
        while len(out) < n:
            out.append(follows[out[-1]])
        return out

    docs, pairs = [(i, " ".join(ordered(r.choice(words)))) for i in range(4000) if remainder(i, 7) != 2], {}
    for i in (i for i in range(4000, 4200) if remainder(i, 7) == 2):
        text = ordered(r.choice(words))
        docs.append((i, " ".join(text)))
        other = next(j for j in range(10_000 + 50 * i, 10**7) if remainder(j, 7) == 2)
        docs.append((other, " ".join(r.sample(text, len(text)))))
        pairs[i] = other
    scores = {x.doc_id: x.score for x in mixing.score(spark.createDataFrame(docs, "doc_id bigint, text string")).where("held_out").collect()}
    assert len(pairs) > 10 and all(scores[i] > scores[other] + 5 for i, other in pairs.items())


def test_followers_are_causal_and_proper():
    r = np.random.default_rng(9)
    doc = np.repeat([0, 1, 2], [40, 1, 60])
    score = np.full(len(doc), math.log10(1 / 6))
    seen = r.integers(0, 5000, len(doc))
    share = r.dirichlet(np.ones(6), len(doc))
    token = r.integers(0, 6, len(doc))

    def of(token):
        return mixing.after_token(doc, score, seen, seen * share[np.arange(len(doc)), token])

    whole = of(token)
    for at in (0, 3, 39, 40, 41, 100):
        total = 0.0
        for other in range(6):
            changed = token.copy()
            changed[at] = other
            again = of(changed)
            assert np.allclose(again[:at], whole[:at])
            total += 10 ** again[at]
        assert total == pytest.approx(1.0, abs=1e-9)


def test_disguises_at_ends_and_short_ones_are_restored():
    """Signs at a word's end, several in front, and three letters or signs apart; what is no disguise stays."""
    plain = "i have a dog and the shit that an asshole and an ass of an idiot told you is on the hand of a man. so what was that to him"
    n = np.zeros(toxicity.SYMBOLS**3)
    for block in toxicity._counts([pa.RecordBatch.from_arrays([pa.array([plain] * 50)], ["text"])]):
        n[block.column(0).to_numpy()] = block.column(1).to_numpy()
    n = n.reshape([toxicity.SYMBOLS] * 3)
    decoder = toxicity.Decoder(np.log((n + 0.01) / (n.sum(axis=2, keepdims=True) + 0.64)).astype(np.float32).ravel())
    for written, meant in (
        (b"idio7", b"idiot"), (b"a55", b"ass"), (b"a$$", b"ass"), (b"an a$$!", b"an ass!"), (b"a$$!!", b"ass!!"), (b"455hole", b"asshole"), (b"$h1+", b"shit"),
        (b"a s s", b"ass"), (b"i d 1 0 t", b"idiot"), (b"1 d i o t", b"idiot"), (b"the idio7!!", b"the idiot!!"),
    ):
        assert decoder.text(written) == meant
    for kept in (b"on the 3 and 25 hand.", b"ha!!! ***", b"a dog!", b"25 of 100 and 3", b"a b"):
        assert decoder.text(kept) == kept


def test_sample_has_a_row_for_each_label(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(1, None), (2, "other"), (2, "other"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id bigint, toxic int")
    sample = [tuple(x) for x in ordinal.labelled_sample(docs.repartition(7), labels, F.col("toxic"), 3, id_col="doc_id", text_col="text").collect()]
    assert Counter(g for _, g in sample) == {0: 1, 1: 2} and {t for t, g in sample if g} == {"other", None}
    again = [tuple(x) for x in ordinal.labelled_sample(docs.coalesce(1), labels, F.col("toxic"), 3, id_col="doc_id", text_col="text").collect()]
    assert Counter(again) == Counter(sample)


@pytest.mark.parametrize(("zeros", "ones"), [(4e9, 2e8), (4e10, 4e9), (1e14, 1e14), (3e9, 7e12)])
def test_counts_beyond_the_last_code_keep_their_ratio(zeros, ones):
    a, b = (mixing.COUNTS[int(c[0])] for c in mixing.coded_pair(np.array([zeros]), np.array([ones])))
    assert b / (a + b) == pytest.approx(ones / (zeros + ones), rel=0.07)


def test_slot_counts_lose_nothing_beside_large_ones():
    rows = pa.RecordBatch.from_arrays([pa.array([b"a"] * 3, pa.binary()), pa.array([2**24, 1, 1])], ["token", "n"])
    blocks = [np.frombuffer(zlib.decompress(b.column("counts")[0].as_py())) for b in mixing._table_blocks([rows])]
    assert {x for block in blocks for x in block[block > 0]} == {2**24 + 2}


def test_ordinal_fit_is_a_minimum_of_the_plain_loss():
    """The cumulative-link loss written out in plain Python: flat at the fit by differences, and higher around it."""
    pick = random.Random(8)
    rows, grades = [], []
    for _ in range(60):
        row = [pick.uniform(-1, 1) for _ in range(3)]
        rows.append(row)
        grades.append(sum(2 * row[0] - row[1] + pick.gauss(0, 0.7) > t for t in (-0.8, 0.9)))
    l2 = 0.05

    def loss(w, thresholds):
        total = 0.0
        for row, grade in zip(rows, grades):
            latent = sum(a * b for a, b in zip(w, row))
            tail = [1.0, *(1 / (1 + math.exp(t - latent)) for t in thresholds), 0.0]
            total -= math.log(tail[grade] - tail[grade + 1])
        return total / len(rows) + l2 / 2 * sum(a * a for a in w)

    places = [np.arange(3)] * len(rows)
    x = ordinal.Sparse(places, [np.array(r) for r in rows], 3)
    w, thresholds = ordinal.fit(x, np.array(grades), 3, l2=l2, steps=4000, rate=0.01)
    at, best = [*w, *thresholds], loss(w, thresholds)
    for i in range(5):
        near = [[a + step * (i == j) for j, a in enumerate(at)] for step in (1e-4, -1e-4)]
        up, down = (loss(n[:3], n[3:]) for n in near)
        assert abs(up - down) / 2e-4 < 2e-3
    for _ in range(50):
        other = [a + pick.gauss(0, 0.2) for a in at]
        if other[3] < other[4]:
            assert loss(other[:3], other[3:]) >= best - 1e-6


def best_path(token, trigrams):
    """The best of all paths through a token's lattice, each costed from its beginning."""
    ends = len(token.rstrip(b"!"))

    def choices(i):
        char = chr(token[i])
        if char in toxicity.LEET:
            kept = toxicity.AT_END if i >= ends else toxicity.AS_ITSELF
            inner = [(toxicity.LEFT_OUT, "")] if 0 < i < len(token) - 1 else []
            return [*((toxicity.AS_LETTER, c) for c in toxicity.LEET[char]), (kept, char), *inner]
        run = len(re.match(re.escape(char) + "+", token.decode()[i:])[0]) + len(re.search(f"(?:{re.escape(char)})*$", token.decode()[:i])[0])
        if run >= 3 and i and token[i - 1] == token[i]:
            return [(toxicity.ONCE_MORE, char), (toxicity.ONCE_MORE_OUT, "")]
        return [(0.0, char)]

    def symbol(char):
        return ord(char) - 96 if char.isalpha() else 0

    def cost(path):
        x = y = total = 0
        for i, (extra, char) in enumerate(path):
            total += extra
            if not char:
                continue
            z = symbol(char)
            digits = i and chr(token[i - 1]).isdigit() and chr(token[i]).isdigit()
            if y or z or not i or not (i > ends or digits):
                total += trigrams[x, y, z]
            x, y = (y if z else 0), z
        return total + (0.0 if ends < len(token) and not y else trigrams[x, y, 0])

    return "".join(char for _, char in max(itertools.product(*map(choices, range(len(token)))), key=cost)).encode()


@pytest.mark.parametrize("seed", range(4))
def test_restored_words_are_the_best_of_all_paths(seed):
    pick = np.random.default_rng(seed)
    trigrams = np.log(pick.dirichlet(np.full(toxicity.SYMBOLS, 0.3), (toxicity.SYMBOLS, toxicity.SYMBOLS)) + 1e-6)
    decoder = toxicity.Decoder(trigrams)
    words = [b"1d10t", b"a55", b"$h1+", b"l00ser", b"iddiiot", b"heeeey", b"ha!!!", b"3rd", b"100x0", b"|00l!"]
    words += [bytes(pick.choice(list(b"abc014!$|2"), int(pick.integers(2, 7))).tolist()) for _ in range(25)]
    for word in words:
        assert decoder.decode(word) == best_path(word, trigrams), word
