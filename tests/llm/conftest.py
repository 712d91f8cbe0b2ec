import random

import pytest

EDGE = [
    (None, "a text without an id, one two three four five six seven"),
    (900001, None),
    (900002, ""),
    (900003, " \t\n "),
    (900004, "x"),
    (900005, "same words here " * 400),
    (900005, "same words here " * 400),
    (900006, "other text under one id"),
    (900006, "and one more of it"),
    (900007, "Ünïcödé — 日本語 テキスト 𝔘 é " * 30),
    (900008, "word " * 60_000),
]


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact copies, near copies, shared passages, periodic ones, and the odd rows."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randint(2, 9))) for _ in range(900)]

    def text(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    shared = [text(80) for _ in range(3)]
    rows = [(i, text(rnd.randint(1, 300))) for i in range(60)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(25)]
    rows += [(200 + i, f"{text(20)} {rnd.choice(shared)} {text(rnd.randint(0, 40))}") for i in range(40)]
    near = text(250).split(" ")
    for i in range(20):
        changed = list(near)
        changed[rnd.randrange(250)] = "changed"
        rows.append((300 + i, " ".join(changed)))
    rows += [(400, "ab " * 500), (401, "ab " * 300), (402, "x" * 700), (403, "xy" * 400), (404, text(9) + "\n" + text(9))]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as a table with columns whose names the operators use themselves."""
    schema = "doc_id long, text string, score double, spans string, component_id long, place int"
    return spark.createDataFrame([(*r, 0.5, "s", 7, 1) for r in corpus + EDGE], schema).repartition(5)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def all_rows(corpus):
    return corpus + EDGE
