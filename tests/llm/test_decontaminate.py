import random
import re
import time

import numpy as np
import pytest

from martloom.llm import decontaminate
from martloom.llm.decontaminate import Tokens

ITEMS = [
    (1, "If Anna buys 12 apples for 3 dollars each and then Anna sells 5 apples, how much money did she pay in total for them?"),
    (2, "The quick brown fox jumps over the lazy dog while seven wizards quietly brew a strange potion near the river."),
    (3, "Name the capital."),
    (4, None),
    (5, ""),
    (6, "1 2 3 4 5 6 7 8 9 10"),
]
SAME = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew a strange potion near the river."
DOCS = [
    (1, f"Some text before. {SAME} And after."),
    (2, "x If Anna buys 12 apples for 3 dollars each and then Anna sells 5 apples, how much money did she pay in total for them?"),
    # other name and numbers, used consistently
    (3, "So: if Maria buys 40 apples for 7 dollars each and then Maria sells 9 apples, how much money did she pay in total for them?"),
    # the name changes halfway
    (4, "if Maria buys 40 apples for 7 dollars each and then Paula sells 9 apples, how much money did she pay in total for them?"),
    # two numbers of the item are one value there, which is consistent
    (5, "if Maria buys 40 apples for 7 dollars each and then Maria sells 7 apples, how much money did she pay in total for them?"),
    (6, "The quick brown fox jumps over something else entirely."),
    (7, "THE### QUICK!! BROWN FOX JUMPS OVER THE LAZY DOG WHILE SEVEN WIZARDS QUIETLY BREW A STRANGE POTION NEAR THE RIVER"),
    (8, "and then name the capital of it"),
    (9, "11 12 13 14 15 16 17 18 19 20 21 22"),
    (10, None),
    (11, ""),
    (12, "filler words here " * 20_000 + SAME),
    (None, SAME),
    (13, "clean text about nothing"),
    (13, "clean text about nothing"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in DOCS], "doc_id long, text string, item_id int, kind string")
    return docs.repartition(4), spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, hash string")


def test_pairs(tables):
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contained(*tables).collect()}
    assert set(got) == {(1, 2), (2, 1), (3, 1), (5, 1), (7, 2), (8, 3), (12, 2), (None, 2)}
    assert got[1, 2].kind == got[2, 1].kind == "verbatim" and got[3, 1].kind == "reparameterised"
    assert got[1, 2].coverage == 1 and got[3, 1].changed >= 3


WORD = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[A-Za-z\x80-\U0010FFFF]+")


def canonical(text):
    """Tokens as (kind, word): n, u and N for numbers, units and names, else the word itself."""
    out, end = [], 0
    for m in WORD.finditer(text or ""):
        word, gap = m.group(), (text or "")[end : m.start()]
        number_before = bool(out) and out[-1][0] == "n" and len(gap) <= 1
        begins = not out or bool(re.search(r'[.!?:\n\r|"]', gap))
        if word[0].isdigit():
            kind = "n"
        elif number_before and word.lower() in decontaminate.UNITS:
            kind = "u"
        else:
            kind = "N" if not begins and re.match(r"[A-Z][^A-Z]", word) else ""
        out.append((kind, word.casefold()))
        end = m.end()
    return out


def brute(docs, items, window=8):
    """Windows compared one by one."""
    out = set()
    for d, text in docs:
        have = canonical(text)
        if len(have) > 5000:
            continue
        for i, item in items:
            want = canonical(item)
            n = min(window, len(want))
            places, along = set(), {}
            for a in range(len(want) - n + 1) if n else ():
                left = want[a : a + n]
                for b in range(len(have) - n + 1):
                    right = have[b : b + n]
                    if [w for _, w in left] == [w for _, w in right]:
                        places.add(a)
                    if n >= 4 and sum(not k for k, _ in left) >= 2 and all(k == l and (k or v == w) for (k, v), (l, w) in zip(left, right)):
                        along.setdefault(b - a, []).append((a, [(v, w) for (k, v), (_, w) in zip(left, right) if k]))
            for met in along.values():
                pairs = {p for _, held in met for p in held}
                torn = {v for v, w in pairs if any(x == v and y != w for x, y in pairs)}
                places |= {a for a, held in met if all(v == w for v, w in held) or not any(v in torn for v, _ in held)}
            if places and len(places) / (len(want) - n + 1) >= 0.5:
                out.add((d, i))
    return out


def test_against_brute_force(tables):
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(*tables).collect()}
    assert got - {(12, 2)} == brute(DOCS, ITEMS)


def test_random_templates_against_brute_force(spark):
    """Short texts of few words, names, units and numbers, so that windows repeat on both sides."""
    rnd = random.Random(6)
    bits = ["cost", "and", "of", "Anna", "Bob", "12 kg", "7", "7 km", "3", "plus"]
    items = [(i, " ".join(rnd.choice(bits) for _ in range(rnd.randint(2, 14)))) for i in range(40)]
    items += [(90, "row 1 value 2 " * 8), (91, "is 4 plus 5 a 9")]
    docs = [(i, "so " + " ".join(rnd.choice(bits) for _ in range(rnd.randint(5, 60)))) for i in range(30)]
    docs += [(100 + i, f"x {t.replace('7', '8').replace('Bob', 'Eve')} y") for i, t in items] + [(200, "row 3 value 4 row 5 value 6 " * 9)]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(*tables).collect()}
    assert got == brute(docs, items) and len(got) > 60


def test_long_tables_of_one_number_take_seconds(spark):
    docs = spark.createDataFrame([(1, "0 " * 20_000), (2, "row 1 of 2 " * 4000), (3, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "0 " * 2000), (2, "row 3 of 4 " * 300)], "item_id long, text string")
    start = time.monotonic()
    got = {(r.doc_id, r.item_id): (r.kind, r.coverage) for r in decontaminate.contained(docs, items).collect()}
    assert got == {(1, 1): ("verbatim", 1.0), (2, 2): ("reparameterised", 1.0)}
    assert time.monotonic() - start < 60


def test_blocks_of_shifts_change_nothing():
    rng = np.random.default_rng(3)
    templates = []
    for _ in range(5):
        a, b = np.sort(rng.choice(300, 40, replace=False)), np.sort(rng.choice(60, 12, replace=False))
        templates.append((a, rng.integers(0, 4, (40, 2)), b, rng.integers(0, 4, (12, 2))))
    assert len({(tuple(sorted(p)), s, c) for p, s, c in (decontaminate.consistent(templates, n) for n in (7, 100, 1 << 18))}) == 1


def test_canonical_tokens():
    text = "Ann met Bob at 3.5 km, then Bob ran 1,000 m. Bob won".encode()
    tokens = Tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    kinds = [
        {int(decontaminate._NUMBER): "n", int(decontaminate._UNIT): "u", int(decontaminate._NAME): "N"}.get(int(h), ".")
        for h in tokens.hashes
    ]
    assert "".join(kinds) == "..N.nu.N.nu.."


def test_clean_keeps_the_rest(tables):
    docs, benchmark = tables
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect())) == [4, 6, 9, 10, 11, 13, 13]


def test_empty_tables(tables, empty_docs):
    docs, benchmark = tables
    assert decontaminate.contained(empty_docs, benchmark).collect() == []
    assert decontaminate.contained(docs, benchmark.where("item_id < 0")).collect() == []
    assert decontaminate.clean(docs, benchmark.where("item_id < 0")).count() == len(DOCS)


def test_rows_without_an_id_are_documents_of_their_own(spark, tables):
    docs = spark.createDataFrame([(None, SAME), (None, "clean text about nothing"), (None, None)], "doc_id long, text string")
    kept = decontaminate.clean(docs.repartition(2), tables[1])
    assert sorted((r.text for r in kept.collect()), key=repr) == ["clean text about nothing", None]


def test_items_of_numbers_and_names(spark):
    items = [(1, "What is 12 plus 30?"), (2, "Add 1 kg 2 kg 3 kg 4 kg 5 kg 6 kg 7 kg and 8 kg."), (3, "5 7 11 13")]
    docs = [
        (1, "see: What is 12 plus 30? Think."),
        (2, "x. " + items[1][1]),
        (3, "so 5 7 11 13 go"),
        (4, "see: What is 13 plus 30? Think."),
        (6, "see: What is 45 plus 81? Think."),
        (5, "x. Add 2 kg 3 kg 4 kg 5 kg 6 kg 7 kg 8 kg and 9 kg."),
    ]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contained(*tables).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 1), (6, 1)}
    assert {k for k, r in got.items() if r.kind == "reparameterised"} == {(4, 1), (6, 1)}
    assert {r.coverage for r in got.values()} == {1.0} and got[6, 1].changed == 2


def test_one_altered_value_does_not_hide_the_rest(spark):
    first = "Tom has 12 red marbles in a bag that his aunt gave to him on the first day of the long summer break"
    item = f"{first} and later on, after a walk in the park with all of the other children, he finds 12 blue ones near the old well."
    docs = [
        (1, f"x. {item.replace('12 blue', '13 blue')}"),
        # rows of one document at one place, one as it is and one with another value
        (2, f"x. {item}"),
        (2, f"x. {item.replace('12', '40')}"),
        (3, "x a bag that his aunt gave to somebody else altogether, and nothing more"),
    ]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contained(*tables).collect()}
    assert set(got) == {1, 2}
    assert 0.5 < got[1].coverage < 1 and got[2].coverage == 1


def test_any_case(spark):
    items = [
        (1, "Did Anna tell Boris that Clara and Dmitri saw Elena near Fulda with Greta before Heinz met Irina in Jena?"),
        (2, "Die Straße über den großen Fluß führt für ältere Männer ständig zurück zum Café, süß und schön."),
    ]
    docs = [(10 * i + k, f"x {form} y") for i, t in items for k, form in enumerate((t.lower(), t.upper(), t.title(), t.swapcase(), t))]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.kind, r.coverage) for r in decontaminate.contained(*tables).collect()}
    assert got == {(10 * i + k, i): ("verbatim", 1.0) for i, _ in items for k in range(5)}


def test_folding_keeps_the_words():
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x1FFFF)]):
        for text in (f"1,{c} a.{c}2 {c}", c.casefold()):
            data = np.frombuffer(text.encode(), np.uint8)
            folded = np.frombuffer(text.casefold().encode(), np.uint8)
            counts = {len(decontaminate._runs(d, np.array([0, len(d)]))[1]) for d in (data, folded)}
            assert len(counts) == 1, c
