import numpy as np
import pytest

from martloom.llm import minhash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute_set(text, n=3):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, percent=85):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if same and 100 * same >= percent * (len(a) + len(sets[j]) - same):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 62), 1 << 62 if d is None else d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[find(i)] if least[find(i)] < 1 << 62 else None
        out.append((d, len(sets[i]), c, c == d))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def graded():
    """Texts, and copies of them with ever more words replaced: similarities on both sides of 0.85, and chains."""
    rng = np.random.default_rng(11)
    out = []
    for n in (12, 40, 90, 200):
        for _ in range(6):
            words = [f"w{x}" for x in rng.integers(0, 3000, n)]
            out.append(" ".join(words))
            for _ in range(8):
                for i in rng.choice(n, max(1, n // 60), replace=False):
                    words[i] = f"x{rng.integers(0, 3000)}"
                out.append(" ".join(words).upper())
    return [(5000 + i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("tile", [minhash.TILE, 300])
def test_against_brute_force(spark, docs, all_rows, graded, tile):
    more = spark.createDataFrame(graded, "doc_id long, text string").repartition(3)
    both = docs.select("doc_id", "text").unionByName(more)
    found = minhash.near_duplicates(both, tile=tile)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got, expected = sorted((tuple(r) for r in found.collect()), key=repr), brute(all_rows + graded)
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    assert got == expected


def test_extra_columns_and_empty_table(docs, empty_docs):
    assert minhash.near_duplicates(empty_docs).collect() == []
    assert minhash.near_duplicates(docs).count() == docs.count()


def test_a_large_group_of_which_few_pairs_link(spark):
    """One family of texts with a common half: no pair links, but for planted copies."""
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 9000, 200)]
    rows = []
    for i in range(300):
        words = list(base)
        for k in rng.choice(200, 14, replace=False):
            words[k] = f"y{rng.integers(0, 9000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 300, 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in minhash.near_duplicates(df, tile=5000).collect()), key=repr) == brute(rows)


def test_join_within_a_tile_is_exact():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(30):
        base = rng.choice(500, rng.integers(5, 60), replace=False)
        sets += [np.unique(np.r_[rng.permutation(base)[: max(1, len(base) - int(rng.integers(0, 6)))], rng.integers(500, 600, 1)]) for _ in range(4)]
    links = minhash.joined(np.arange(len(sets)), sets, np.zeros(len(sets), int), 85)
    root = {i: i for i in range(len(sets))}
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
    assert all(alike(sets[a], sets[b]) for a, b in links)
    for a, b in links:
        root = {x: min(root[a], root[b]) if r in (root[a], root[b]) else r for x, r in root.items()}
    assert all(root[i] == root[j] for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j]))
    assert len(links) == len(sets) - len(set(root.values()))


def test_tables_meet_as_often_as_stated():
    """Pairs with similarity 0.85: the share that meets in a table of pairs of short keys."""
    rng = np.random.default_rng(9)
    met = 0
    for _ in range(300):
        common, rest = rng.integers(0, 1 << 63, 340, dtype=np.uint64), rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        hashes = np.r_[common, rest[:30], common, rest[30:]]
        k = minhash.short_keys(hashes, np.array([370, 370]), minhash.SIDE, minhash.HASHES)
        same = k[0] == k[1]
        met += same[: minhash.SIDE].any() and same[minhash.SIDE :].any()
    assert met >= 296
