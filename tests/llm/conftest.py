import random

import pytest

WORDS = [f"w{i}" for i in range(400)]


def words_of(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def odd_texts():
    """Ids and texts: nulls, empty and very long texts, ties, repeated rows, copies, near copies, passages."""
    passage = words_of("passage", 70)
    item = "What IS the answer to the first of all questions, asked by so many people for so long?"
    base = words_of("base", 120).split()
    near = [*base]
    near[60] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \n\t\x0b "), (4, "one two three"), (5, "One  two\nTHREE"),
        (6, words_of("long", 60_000)), (7, words_of("a", 200)), (8, words_of("a", 200)), (7, words_of("a", 200)),
        (None, words_of("b", 90)), (None, words_of("b", 90)), (None, None),
        (10, " ".join(base)), (11, " ".join(near)), (12, " ".join(near).upper()),
        (13, f"start {passage} end"), (14, f"{words_of('c', 40)}\n{passage}\n{words_of('d', 40)}"),
        (15, f"intro {words_of('e', 30)}. {item} More {words_of('f', 30)}"), (16, item), (17, "a short item, yes"),
        (18, "x" * 300_000), (19, "Ünï cödé – “quotes” 中文 日本語 <|endoftext|> end"), (20, "the the the the " * 50),
        (21, "MIT License mit license; GNU General Public License, version 2.0"), (22, "you 1d10t i d i o t idiooot"),
        (-5, "one two three"), (2**40, "tie"), (2**40, "tie"), (23, "a\x00b \x1c c d e"),
    ]
    for i in range(12):
        copy = words_of("group", 100).split()
        copy[i * 7] = f"v{i}"
        rows.append((100 + i, " ".join(copy)))
    return rows


def odd_items():
    item = "what is the answer to the first of all questions asked by so many people for so long"
    return [(1, item), (2, "Short item, yes!"), (3, None), (None, words_of("a", 200)), (4, ""), (5, item), (5, "tie"), (6, "…")]


#: Columns whose names could clash with those that operators use inside.
CLASHING = "t1 T2 found seeds class label n row key grade chunk bucket registers spans text_ shard size piece a b id".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", "src", None if t is None else len(t), *["z"] * len(CLASHING)) for i, t in odd_texts()]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(*r, "z") for r in odd_items()], "item_id bigint, text string, found string")


@pytest.fixture(scope="session")
def no_benchmark(benchmark):
    return benchmark.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int, grade int")
