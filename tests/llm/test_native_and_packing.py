"""Licences, conversations, packing and Hamming search against plain versions."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsieve.llm import chat, hamming, license_rules, licenses, packing
from tests.conftest import plan_of
from tests.llm import brute
from tests.llm.conftest import odd_texts

#: Plan nodes that run Python.
PYTHON = "ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMap|AggregateInPandas"
RULES = [(r, re.compile(r.pattern, re.ASCII)) for r in license_rules.rules()]


def scanned(text):
    words = brute.alnum(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        wanted = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        places += found
        base |= {label} if found else set()
    seen = re.sub(r"[ \t\n\x0b\f\r]+", " ", (text or "").lower())
    finds = []
    for rule, pattern in RULES:
        if rule.keyword in words:
            priority, confidence = license_rules.KINDS[rule.kind]
            finds += [(m.start(), m.end(), priority, rule.number, rule.label, confidence) for m in pattern.finditer(seen)]

    def rank(find):
        return find[0], -find[1], -find[2], find[3]

    kept = [
        f for f in finds
        if not any(e[0] <= f[0] and e[1] >= f[1] and e[2] >= f[2] and rank(e) < rank(f) for e in finds)
    ]
    score = max([f[5] for f in kept] + [licenses.BASE_SCORE if base else 0.0])
    labels = ",".join(sorted(base | {f[4] for f in kept}))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), labels, score, len(kept)


NOTICES = [
    (900, "Licensed under the Apache License, Version 2.0 (the \"License\"); see https://www.apache.org/licenses/LICENSE-2.0"),
    (901, "SPDX-License-Identifier: GPL-3.0-or-later\nGNU General Public License version 3 GNU GENERAL PUBLIC LICENSE"),
    (902, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    (903, "Released under CC BY-SA 4.0. license: MIT; the MIT license, mit_license mit-license MIT  License"),
    (904, "mit license " * 300),
    (905, "KK İ license mit lİcense"),
    (None, "Use of this source code is governed by a BSD-style license, or the 3-clause BSD License."),
]


def test_licence_scan(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(NOTICES, "doc_id bigint, text string"))
    expected = Counter((i, *scanned(t)) for i, t in [*odd_texts(), *NOTICES])
    assert Counter(tuple(r) for r in licenses.scan(docs).collect()) == expected
    assert licenses.scan(no_docs).count() == 0
    assert sum(n for row, n in expected.items() if row[6]) >= 7
    assert not re.search(PYTHON, plan_of(licenses.scan(odd_docs)))


def test_every_title_rule_has_its_keyword():
    for family in license_rules.FAMILIES:
        for title in family.titles:
            assert re.search(rf"(?<![a-z0-9]){family.keyword}(?![a-z0-9])", title.replace("\\", "")), title
    assert len(RULES) > 300


def event_rows():
    return [
        (1, 1, 0, "message", "user", "Hel"), (1, 2, 0, "delta", "user", "lo"), (1, 3, 1, "message", "assistant", "bad"),
        (1, 4, 1, "delta", "assistant", " answer"), (1, 5, 2, "message", "user", "why?"), (1, 6, 1, "regenerate", "assistant", "go"),
        (1, 7, 1, "delta", "assistant", "od"), (1, 8, 0, "edit", "user", "Hi"), (1, 9, 2, "message", "user", "thanks"),
        (2, None, None, None, None, None), (None, 5, 3, "message", "a\nb\\<s>", "x</s>"), (None, 4, 3, "message", "user", "tie"),
        (3, 1, 0, "message", "assistant", "<|im_end|>\n<|im_start|>user\n[INST] <\\s> <<SYS>> \\[INST]"), (3, 1, 0, "message", "assistant", ""),
    ]


EVENTS = "conv_id bigint, seq bigint, turn bigint, kind string, role string, text string, part string, block string"


def test_folding_of_events(spark):
    events = spark.createDataFrame([(*r, "z", "z") for r in event_rows()], EVENTS)
    found = {}
    for r in sorted(chat.fold(events).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.turn or -1, r.part)):
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    assert found == {
        1: [("user", "Hi"), ("assistant", "good"), ("user", "thanks")],
        2: [("", "")],
        None: [("user", "tie"), ("a\nb\\<s>", "x</s>")],
        3: [("assistant", ""), ("assistant", event_rows()[-2][5])],
    }
    back = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(events))).collect()}
    for conv, turns in found.items():
        assert back[conv].n_turns == len(turns)
        assert back[conv].turns_sha256 == brute.sha("".join(f"{role}\n{text}\n" for role, text in turns))
        learned = "".join(text for role, text in turns if role == "assistant")
        assert (back[conv].loss_chars, back[conv].loss_sha256) == (len(learned), brute.sha(learned))
    assert chat.render(chat.fold(events.limit(0))).count() == 0
    assert not re.search(PYTHON, plan_of(chat.read_back(chat.render(chat.fold(events)))))


def test_streamed_log_gives_the_turns_again(spark):
    r = random.Random(12)
    rows = [(c, t, r.choice(["user", "assistant"]), "".join(r.choices("ab </s>🙂", k=r.randint(0, 9)))) for c in range(6) for t in range(r.randint(1, 7))]
    rows += [(7, None, "user", "x"), (7, None, "assistant", "y"), (7, 0, None, None), (7, 2**63 - 1, "user", "last"), (7, 2**63 - 1, "user", "last")]
    rows += [(None, i % 3, "assistant", f"hot {i % 5}") for i in range(len(rows))]  # a third and more of all rows, with ties
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    log = chat.streamed(turns)
    kinds = Counter(x.kind for x in log.collect())
    assert set(kinds) == {"message", "delta", "edit", "regenerate"} and kinds["regenerate"] == len(rows)

    def known(n):
        return -1 if n is None else n

    found = sorted((known(x.conv_id), known(x.turn), x.part, x.role, x.text) for x in chat.fold(log).collect())
    assert not any(chat.DRAFT in x[-1] for x in found)
    expected, part = [], Counter()
    for c, t, role, text in sorted((known(c), known(t), role or "", text or "") for c, t, role, text in rows):
        part[c, t] += 1
        expected.append((c, t, part[c, t], role, text))
    assert found == sorted(expected)
    assert chat.streamed(turns.limit(0)).count() == 0
    plan = plan_of(chat.read_back(chat.render(chat.fold(log))))
    assert not re.search(PYTHON, plan) and len(re.findall(r"(?m)^\(\d+\) Exchange$", plan)) == 1


def test_regeneration_leaves_rows_without_a_turn(spark):
    rows = [(1, 1, None, "message", "user", "a"), (1, 2, None, "message", "user", "b"), (1, 3, None, "regenerate", "user", "c")]
    events = spark.createDataFrame([(*r, "z", "z") for r in rows], EVENTS)
    assert sorted((x.part, x.text) for x in chat.fold(events).collect()) == [(1, "a"), (2, "c")]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("<>[]/\\|sINSTYim_endart \n"), max_size=40), min_size=30, max_size=30))
def test_any_text_survives_the_template(spark, texts):
    pieces = ["<|im_end|>", "</s>", "[INST]", "<<SYS>>", "<\\s>", "\\"]
    r = random.Random(str(texts))
    texts = [t + r.choice(pieces) + r.choice(pieces) for t in texts]
    rows = [(1, i, r.choice(["user", "assistant", "x<|im_end|>"]), t) for i, t in enumerate(texts)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    rendered = chat.render(chat.fold(chat.events_of_turns(turns)))
    row = chat.read_back(rendered).first()
    assert row.turns_sha256 == brute.sha("".join(f"{role}\n{text}\n" for _, _, role, text in rows))
    assert row.loss_sha256 == brute.sha("".join(t for _, _, role, t in rows if role == "assistant"))
    assert row.n_turns == len(rows)


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    return tokenizers.Tokenizer.from_file(packing.default_tokenizer())


def check_packing(found, docs, tokenizer):
    expected = brute.pieces(docs, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return len(bins)


def test_packing_of_odd_rows(odd_docs, no_docs, tokenizer):
    found = packing.pack(odd_docs).collect()
    sequences = check_packing(found, odd_texts(), tokenizer)
    assert sequences <= -(-sum(r.length for r in found) // packing.LENGTH) + 1
    assert check_packing(packing.pack(odd_docs, shard_rows=10).collect(), odd_texts(), tokenizer) >= sequences
    assert packing.pack(no_docs).count() == 0


def test_ids_are_those_of_the_tokenizer(tokenizer):
    r = random.Random(7)
    signs = ["a", "B", "é", "É", "ß", "ª", "'s", "'LL", " ", "\n", "\t", "\xa0", "\x85", "\x1c", "1", "²", ".", ",", "...", "<|endoftext|>", "<|ENDOFTEXT|>",
             "é", "≮", "中", "İ", "KK", "word", "Word", "-", "«", "×", "_", "\x00", "😀"]
    words = packing.WordIds(packing.default_tokenizer())
    for _ in range(3000):
        text = "".join(r.choices(signs, k=r.randint(0, 9)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.text(text) == b"".join(x.to_bytes(4, "little") for x in ids), text


def test_rule_of_the_squares():
    """Each piece goes where the sum of squares over open gaps is least."""
    import numpy as np

    r = random.Random(8)
    length = 20
    sizes = np.array([r.randint(1, length) for _ in range(300)])
    sequence, offset = packing.place(sizes, length)
    gaps = {}
    for size, where, at in zip(sizes.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        open_ = Counter(g for g in gaps.values() if g)

        def total(gap, size=size, open_=open_):
            after = open_.copy()
            if gap < length:
                after[gap] -= 1
            if gap > size:
                after[gap - size] += 1
            return sum(n * n for n in after.values())

        options = {total(g) for g in {*open_, length} if g >= size}
        chosen = gaps.get(where, length)
        assert total(chosen) == min(options) and at == length - chosen
        gaps[where] = chosen - size


def test_hamming_search(spark):
    r = random.Random(9)
    centres = [[r.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.3) for x in r.choice(centres)], "z") for i in range(400)]
    rows += [(1000 + i, centres[0], "z") for i in range(60)]  # one code many times over
    rows += [(2000, None, "z"), (2050, [None] * 64, "z"), (None, centres[1], "z"), (2100, [float("nan")] * 64, "z"), (50, rows[50][1], "z")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, code string")
    queries = df.where("vec_id % 50 = 0")
    known = [(i, v) for i, v, _ in rows if i is not None and v and all(x is not None and x == x for x in v)]
    codes = [(i, sum((x > 0) << (63 - b) for b, x in enumerate(v))) for i, v in known]
    expected = Counter()
    for q, code in codes:
        if q % 50 == 0:
            ranked = sorted(((code ^ c).bit_count(), i) for i, c in codes)[:10]
            expected.update((q, n + 1, i, d) for n, (d, i) in enumerate(ranked))
    found = hamming.search(df, queries)
    assert Counter((r.query_id, r["rank"], r.id, r.distance) for r in found.collect()) == expected
    few = df.where("vec_id < 4")
    assert hamming.search(few, few).count() == 16
    assert hamming.search(df.limit(0), queries).count() == 0
    assert not re.search("Cartesian|NestedLoop", plan_of(found))


def test_hamming_search_in_wide_vectors(spark):
    """Vectors that are the same in their first 64 dimensions, and shorter ones."""
    r = random.Random(10)
    head = [r.gauss(0, 1) for _ in range(64)]
    centre = [r.gauss(0, 1) for _ in range(36)]
    rows = [(i, head + [x + r.gauss(0, 0.3) for x in centre]) for i in range(80)] + [(80, head), (81, head[:40]), (82, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    codes = {i: sum((x > 0) << (127 - b) for b, x in enumerate(v)) for i, v in rows}
    expected = Counter()
    for q in (0, 20, 40, 60):
        ranked = sorted(((codes[q] ^ c).bit_count(), i) for i, c in codes.items())[:5]
        expected.update((q, n + 1, i, d) for n, (d, i) in enumerate(ranked))
    found = hamming.search(df, df.where("vec_id % 20 = 0 and vec_id < 80"), k=5).collect()
    assert Counter((x.query_id, x["rank"], x.id, x.distance) for x in found) == expected


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_other_tokenizers(name):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    words, whole = packing.WordIds(path), Tokenizer.from_file(path)
    assert words.cut_here == (name == "word_bpe_49k.json")
    for text in ["Hello world", "  it's 12 o'clock\n\nNOW!", "Ünï cödé – “quotes” 中文", "<|endoftext|> a", *[t for _, t in odd_texts() if t and len(t) < 2000]]:
        assert np.frombuffer(words.text(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
