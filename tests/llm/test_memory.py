import random
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowsieve.llm import memory, mixing


def test_memory_is_given_back_after_a_group_is_let_go(monkeypatch):
    """What a group's work has made is free by then, else nothing of it would be given back."""
    made, alive = [], []

    def work(rows, *others):
        large = np.zeros(1000)
        made.append(weakref.ref(large))
        return rows

    monkeypatch.setattr(memory, "give_back", lambda: alive.append(made[-1]() is not None))
    rows = pa.table({"a": [1]})
    assert memory.tidy_group(lambda rows: work(rows))(rows) is rows
    assert memory.tidy_cogroup(lambda rows, others: work(rows, others))(rows, rows) is rows
    assert alive == [False, False]


def test_sorted_values_and_their_places_are_those_of_numpy():
    numbers = np.random.default_rng(3)
    for n in (0, 1, 1000):
        values = numbers.integers(0, 300, n).astype(np.uint64)
        known = mixing._distinct(values)
        assert known.tolist() == np.unique(values).tolist()
        assert mixing._places(known, values).tolist() == np.searchsorted(known, values).tolist()


def test_tokens_are_counted_alike_however_texts_come(monkeypatch):
    texts = ["A b a", "", None, "b c " * 50, "é b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([False, True, False, False, True])], ["text", "held_out"])

    def counts():
        total = {}
        for rows in mixing._token_counts([batch]):
            for token, n, n_all in zip(*[rows.column(c).to_pylist() for c in ("token", "n", "n_all")], strict=True):
                before = total.get(token, (0, 0))
                total[token] = (before[0] + n, before[1] + n_all)
        return total

    whole = counts()
    assert whole == {b"a": (2, 2), b"b": (51, 52), b"c": (50, 50), "é".encode(): (0, 1), b"": (3, 5)}
    monkeypatch.setattr(mixing, "TEXT_BYTES", 4)
    monkeypatch.setattr(mixing, "GATHER_TOKENS", 1)
    assert counts() == whole


def _peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_lot_needs_memory_for_what_its_tokens_do_not_share():
    """Tokens that begin alike share what predicts them; 270 bytes for each of their bytes were needed without."""
    pick = random.Random(4)
    syllables = ["ba", "ne", "tor", "si", "lu", "ven", "kra", "mo"]
    tokens = sorted({"".join(pick.choices(syllables, k=pick.randint(1, 6))).encode() for _ in range(40_000)})
    lot = pa.table({"token": pa.array(tokens, pa.binary()), "n": pa.array([i % 4 for i in range(len(tokens))]), "lot": pa.array([0] * len(tokens))})
    size = sum(map(len, tokens)) + len(tokens)
    mixing._asked(5)(lot.slice(0, 10))  # what is made once
    assert _peak(lambda: mixing._asked(5)(lot)) < 200 * size


def test_edges_are_taken_by_all_tokens_that_begin_alike():
    tokens = [b"abc", b"abd", b"", b"b", b"abcab", b"abc" * 30]
    every, edges = mixing.Contexts(tokens), mixing.Edges(tokens)
    taken = {}
    for token in tokens:
        for at, byte in enumerate(token + b" "):
            taken[token[:at], byte] = None
    assert len(edges.bytes) == len(taken) < len(every.bytes)
    assert edges.bytes[edges.of].tolist() == every.bytes.tolist() and edges.at[edges.of].tolist() == every.at.tolist()
    assert edges.pairs()[:, edges.of].tolist() == every.pairs().tolist()
    assert [h[edges.of].tolist() for h in edges.hashes] == [h.tolist() for h in every.hashes]


def test_each_chunk_is_answered_in_the_order_it_asks_in():
    """Two chunks ask three shares; numbers and scores of tokens are theirs, pairs are counted in training texts of both."""
    chunks = {0: [("a b a", False), ("b c", True)], 1: [("a b", False), (None, False), ("d", True)]}
    asked = [
        mixing._requests(3)(pa.table({"text": pa.array([t for t, _ in rows]), "held_out": pa.array([h for _, h in rows]), "chunk": pa.array([c] * len(rows))}))
        for c, rows in chunks.items()
    ]
    asked = pa.concat_tables(asked)
    tokens = [b"a", b"b", b"c", b"d", b""]
    hashes = mixing._hashes(tokens)
    share = np.searchsorted(mixing._edges(3), hashes, side="right")
    scored = pa.table({"share": share, "token": hashes.view(np.int64), "n": [3, 2, 0, 0, 3], "score": [-0.5, -1.0, -2.0, -3.0, -0.25]})
    met = pa.concat_tables([mixing._met(asked.filter(pc.equal(asked["share"], i)), scored.filter(pc.equal(scored["share"], i))) for i in range(3)])
    of = dict(zip(hashes.tolist(), zip([3, 2, 0, 0, 3], [-0.5, -1.0, -2.0, -3.0, -0.25], strict=True), strict=True))
    for chunk, used in ((0, tokens[:3] + [b""]), (1, [b"a", b"b", b"d", b""])):
        rows = met.filter(pc.equal(met["chunk"], chunk)).sort_by("share")
        n, score, followed = [np.concatenate([mixing._unpacked(raw, kind) for raw in rows[c]]).tolist() for c, kind in (("n", "<i8"), ("score", "<f8"), ("followed", "<i8"))]
        assert list(zip(n, score, strict=True)) == [of[h] for h in sorted(mixing._hashes(used).tolist())]
        # Chunk 0: ^a, ab, ba and a$ of a training text, ^b, bc and c$; chunk 1: ^a, ab, b$, ^$, ^d and d$.
        assert sorted(followed) == ([0, 0, 0, 1, 1, 2, 2] if chunk == 0 else [0, 0, 1, 1, 2, 2])


def test_packed_values_are_read_back():
    """None, few, alike and random ones; random bytes are not compressed."""
    numbers = np.random.default_rng(5)
    for values in (np.zeros(0, np.uint64), np.zeros(5, np.uint64), numbers.integers(0, 2**63, 5000).astype(np.uint64), np.arange(5000, dtype=np.int64), np.arange(300) / 7):
        raw = pa.scalar(mixing._packed(values), pa.binary())
        assert mixing._unpacked(raw, values.dtype.str).tolist() == values.tolist()
        assert len(raw.as_py()) <= values.nbytes + 64 + 16 * 8
