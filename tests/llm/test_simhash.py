import hashlib

import numpy as np
import pytest
import xxhash

from martloom.llm import simhash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute_print(text, n=3, seed=42):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return 0
    h = np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), seed) for i in range(max(1, len(w) - n + 1))], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view(np.uint64)[0])


def brute_components(prints, ids, radius=2):
    f, root = np.array(prints, np.uint64), list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f) <= radius):
            root[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), 1 << 62), 1 << 62 if d is None else d)
    return [None if least[find(i)] == 1 << 62 else least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("tile", [16384, 8])
def test_against_brute_force(docs, all_rows, tile):
    prints = [brute_print(t) for _, t in all_rows]
    expected = zip((d for d, _ in all_rows), prints, brute_components(prints, [d for d, _ in all_rows]), strict=True)
    got = [(r.doc_id, r.f0 & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs, tile=tile).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_wider_fingerprints_use_further_seeds(spark):
    df = spark.createDataFrame([(1, "One two three four five six seven")], "doc_id long, text string")
    row = simhash.fingerprints(df, words=5, lanes=2).first()
    assert [row.f0 & (1 << 64) - 1, row.f1 & (1 << 64) - 1] == [brute_print("one two three four five six seven", 5, s) for s in (42, 43)]


def test_chains_become_one_component(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 140), (140, 120)] + [(200, 200 + i) for i in range(1, 30)]
    got = dict(simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 41)} | {120: 100, 140: 100} | {200 + i: 200 for i in range(1, 30)}


def test_forest_holds_all_sets():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 200, (2, 120))
    forest = simhash.Forest(200)
    forest.link(a[:60], b[:60])
    forest.link(a[60:], b[60:])
    label = np.arange(200)
    for _ in range(200):
        for x, y in zip(a, b, strict=True):
            label[x] = label[y] = min(label[x], label[y])
    assert (forest.root == label).all()


def first_of_each(rows, radius=2):
    """Rows that stay: one per doc_id, then the first of each component."""
    least = {}
    for d, t in rows:
        key = (d is None, d or 0, hashlib.md5((t or "").encode()).hexdigest() if d is None else "")
        digest = hashlib.md5((t or "").encode()).hexdigest()
        least[key] = min(least.get(key, (digest, t)), (digest, t))
    own = [(k[0], k[1], digest, t) for k, (digest, t) in sorted(least.items())]
    group = brute_components([brute_print(t) for *_, t in own], list(range(len(own))), radius)
    return sorted(((None if unknown else d), t or "") for i, (unknown, d, _, t) in enumerate(own) if group[i] == i and not unknown), [
        t or "" for i, (unknown, _, _, t) in enumerate(own) if group[i] == i and unknown
    ]


@pytest.mark.parametrize("tile", [16384, 8])
def test_keep_first(docs, all_rows, tile):
    kept = simhash.keep_first(docs, tile=tile)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text or "") for r in kept.select("doc_id", "text").collect()]
    known, unknown = first_of_each(all_rows)
    assert sorted(x for x in got if x[0] is not None) == known
    assert sorted(t for d, t in got if d is None) == sorted(unknown)
    ids = {d for d, _ in got}
    assert not set(range(100, 125)) & ids and set(range(10, 60)) <= ids  # exact copies go, texts of their own stay


def test_empty_table(empty_docs):
    assert simhash.near_duplicates(empty_docs).collect() == []
    assert simhash.keep_first(empty_docs).collect() == []


def test_rows_without_or_with_one_id_do_not_link(spark):
    rng = np.random.default_rng(2)
    a, b, c, d = (" ".join(f"w{x}" for x in rng.integers(0, 10_000, 60)) for _ in range(4))
    rows = [(5, a), (None, a), (9, b), (None, b), (None, c), (None, d), (3, c + " x"), (3, d + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prints = [brute_print(t) for _, t in rows]
    # the texts of doc_id 3 are near two that have no id
    expected = zip((i for i, _ in rows), prints, brute_components(prints, [i for i, _ in rows], 6), strict=True)
    got = [(r.doc_id, r.f0 & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df, radius=6).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert {(i, k) for i, _, k in got if i in (5, 9)} == {(5, 5), (9, 9)}
    kept = simhash.keep_first(spark.createDataFrame([*rows[:6], (None, c)], df.schema).repartition(3))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(5, a), (9, b), (None, c), (None, d)], key=repr)
