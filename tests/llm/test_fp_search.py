import math
import re
from collections import Counter

import numpy as np
import pytest

from martloom.llm import fp_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=20):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, t, sum(t.values())) for d, t in held if t]
    n, total, df = len(held), sum(x[2] for x in held), Counter(w for _, t, _ in held for w in t)
    merged = {}
    for i, text in dict.fromkeys(items):
        merged[i] = merged.get(i, Counter()) + terms(text)
    out = []
    for i, query in merged.items():
        scored = []
        for d, t, size in held:
            m = 75 + 25 * size * n // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * t[w] // (1000 * t[w] + 12 * m))
                for w, q in query.items() if w in t
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(corpus):
    rnd = np.random.default_rng(4)
    words = " ".join(t for _, t in corpus).split()
    rows = [(i, " ".join(rnd.choice(words, int(rnd.integers(3, 30))))) for i in range(25)]
    rows += [(100, corpus[3][1]), (101, "nowhere xyzzy"), (102, None), (103, ""), (104, "WORD word Same, here-words! 日本語 é"), (104, "ab ab ab")]
    return rows + [(None, "ab x xy"), (105, "ab"), (105, "ab")]


@pytest.mark.parametrize(("leaf", "group", "block"), [(256, 1 << 13, 1 << 20), (4, 40, 60)])
def test_against_brute_force(spark, docs, all_rows, items, leaf, group, block):
    benchmark = spark.createDataFrame([(*r, 1.0) for r in items], "item_id long, text string, score double").repartition(3)
    found = fp_search.search(docs, benchmark, block=block, group=group, leaf=leaf, shard=leaf * 8)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(all_rows, items)


def test_empty_tables(spark, docs, empty_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "word x"), (2, None)], "item_id long, text string")
    assert fp_search.search(docs, none).collect() == [] == fp_search.search(empty_docs, some).collect()
    assert fp_search.search(docs, some.where("item_id = 2")).collect() == []


def random_tree(rng, docs, vocabulary, leaf):
    vectors = [np.sort(rng.choice(vocabulary, int(rng.integers(1, 12)), replace=False, p=None)) for _ in range(docs)]
    vectors += vectors[: docs // 4] * 2  # copies
    first = np.r_[0, np.cumsum([len(v) for v in vectors])]
    tf, m = rng.integers(1, 5, first[-1]), rng.integers(75, 200, len(vectors))
    return vectors, tf, m, fp_search.Tree(first, np.concatenate(vectors), tf, m, vocabulary, leaf)


def test_nodes_hold_ranges_maxima_and_minima():
    vectors, _, m, tree = random_tree(np.random.default_rng(1), 400, 30, 8)
    assert sorted(tree.order.tolist()) == list(range(len(vectors))) and len(tree.low) > 50
    covered = sorted((tree.low[i], tree.high[i]) for i in range(len(tree.low)) if not tree.children[i])
    assert [a for a, _ in covered] == [0, *(b for _, b in covered[:-1])] and covered[-1][1] == len(vectors)
    for i, below in enumerate(tree.children):
        if below:
            assert sum(tree.high[c] - tree.low[c] for c in below) == tree.high[i] - tree.low[i]
        a, b = tree.first[tree.low[i]], tree.first[tree.high[i]]
        most = np.zeros(30, int)
        np.maximum.at(most, tree.term[a:b], tree.tf[a:b])
        assert (most == tree.most[i]).all() and tree.least[i] == m[tree.order[tree.low[i] : tree.high[i]]].min()


def test_search_leaves_out_subtrees_and_loses_nothing():
    rng = np.random.default_rng(2)
    vectors, tf, m, tree = random_tree(rng, 3000, 200, 16)
    first = np.r_[0, np.cumsum([len(v) for v in vectors])]
    ids, less = np.arange(len(vectors)), 0
    for _ in range(30):
        term = np.sort(rng.choice(200, 6, replace=False))
        weight, dense, best = rng.integers(1, 9000, 6), np.zeros(200, np.int64), fp_search.Best.none(5)
        less += fp_search.descend(tree, ids, np.zeros(len(ids), bool), term, weight, dense, best) < len(ids) // 2
        w = dict(zip(term.tolist(), weight.tolist()))
        score = [sum(w.get(t, 0) * (10**9 * int(f) // (1000 * int(f) + 12 * int(m[i]))) for t, f in zip(v.tolist(), tf[first[i] : first[i + 1]])) for i, v in enumerate(vectors)]
        expected = sorted((-s, i) for i, s in enumerate(score))[:5]
        assert list(zip((-best.score).tolist(), best.doc.tolist())) == expected
        assert not dense.any()
    assert less > 15
