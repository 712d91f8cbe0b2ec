import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from martloom.llm import arrays, bwt_dedup, superkmers
from martloom.llm.arrays import sliding_min, words
from martloom.llm.repeats import union_spans

SIZE, WORDS = 200, 50


def brute_bytes(rows, size):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + size] for i in range(len(b) - size + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_words(rows, size):
    first = {}
    least = -(1 << 63)
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            first[k] = min(first.get(k, 1 << 62), least if d is None else d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = bytearray(len(w))
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (least if d is None else d):
                gone[i : i + size] = b"\1" * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(all_rows):
    return [r for r in all_rows if r[0] != 900008]  # its windows are too many for the brute-force version


@pytest.mark.parametrize("block", [8192, 3])
def test_bytes_against_brute_force(docs, rows, block):
    found = bwt_dedup.remove_repeats(docs.where("NOT doc_id <=> 900008"), block=block)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    got = found.collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_bytes(rows, SIZE)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("block", [8192, 3])
def test_words_against_brute_force(docs, rows, block):
    got = superkmers.remove_seen(docs.where("NOT doc_id <=> 900008"), block=block).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == brute_words(rows, WORDS)


def crowd():
    """One passage in many texts with different surroundings, of which some share one side, or nearly so."""
    rng = np.random.default_rng(5)
    text = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(n))
    passage, left, right = text(20), [text(45) for _ in range(5)], [text(45) for _ in range(5)]
    rows = [(i, f"{text(45)} {passage} {text(45)}") for i in range(40)]
    rows += [(100 + i, f"{left[i % 5]} {passage} {text(45)}") for i in range(20)]
    rows += [(200 + i, f"{text(45)} {passage} {right[i % 5]}") for i in range(20)]
    rows += [(300 + i, f"{text(40 - i)} {left[0][-6 * i:]} {passage} {right[i % 2][: 6 * i]}") for i in range(12)]
    return rows + [(400, rows[3][1]), (401, rows[50][1]), (None, rows[70][1])]


@pytest.mark.parametrize("block", [12, 1])
def test_a_crowded_minimiser(spark, block):
    """Halves of crowded groups, down to single windows, find what brute force finds."""
    rows = crowd()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bwt_dedup.remove_repeats(df, block=block).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_bytes(rows, SIZE)
    got = superkmers.remove_seen(df, block=block).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == brute_words(rows, WORDS)


def test_a_long_periodic_text(spark):
    rows = [(1, "word " * 60_000), (2, "word " * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in superkmers.remove_seen(df).collect()) == [(1, 60_000, 0), (2, 70, 70)]
    assert sorted(tuple(r)[:4] for r in bwt_dedup.remove_repeats(df).collect()) == [(1, 300_000, 300_000, 1), (2, 350, 350, 1)]


def test_long_words_that_polynomial_hashes_confuse(spark):
    """A Thue-Morse word and its complement agree in every polynomial modulo 2 ** 64."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    text = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*text[:25], w, *text[26:]])) for i, w in ((1, a), (2, b), (3, b))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in superkmers.remove_seen(df).collect()) == [(1, 60, 0), (2, 60, 0), (3, 60, 60)]


def test_word_hashes_tell_words_apart():
    rng = np.random.default_rng(4)
    words_ = sorted({bytes(rng.integers(97, 99, rng.integers(1, 40), dtype=np.uint8)) for _ in range(5000)})
    data = np.frombuffer(b"".join(words_), np.uint8)
    end = np.cumsum([len(w) for w in words_])
    h = arrays.word_hashes(data, end - [len(w) for w in words_], end)
    assert len(set(h.tolist())) == len(words_)
    assert (arrays.word_hashes(data[::-1][::-1].copy(), end[:9] - [len(w) for w in words_[:9]], end[:9]) == h[:9]).all()


def test_empty_tables(empty_docs):
    assert bwt_dedup.remove_repeats(empty_docs).collect() == []
    assert superkmers.remove_seen(empty_docs).collect() == []


def test_column_insertion_against_all_pairs():
    rng = np.random.default_rng(3)
    table = rng.integers(0, 3, (60, 40)).astype(np.uint16)
    table[30:] = table[:30]
    table[35:50, :12] = 2
    group = np.sort(rng.integers(0, 6, 60))
    hit = bwt_dedup.insert_columns(table, group, 5)
    for i in range(60):
        for c in range(36):
            piece = table[i, c : c + 5]
            twin = any(
                j != i and group[j] == group[i] and (table[j, c : c + 5] == piece).all() and piece.all() for j in range(60)
            )
            assert hit[i, c] == twin


def test_sorted_numbers():
    ids = np.array([1, 2, 1, 2, 1, 3, 1, 2, 1])
    rank = superkmers.sorted_numbers(ids, 3)
    pieces = [tuple(ids[i : i + 3]) for i in range(len(ids) - 2)]
    assert [[a == b for b in rank] for a in rank] == [[a == b for b in pieces] for a in pieces]


def test_helpers():
    values = np.array([5, 3, 9, 1, 7, 2], np.uint64)
    assert sliding_min(values, 3).tolist() == [3, 1, 1, 1]
    data = np.frombuffer(b"ab c d", np.uint8)
    start, end, first = words(data, np.array([0, 1, 1, 4, 6]))
    assert (start.tolist(), end.tolist(), first.tolist()) == ([0, 1, 3, 5], [1, 2, 4, 6], [0, 1, 1, 3, 4])
    a, b = union_spans(np.array([9, 0, 2, 5]), np.array([12, 3, 5, 6]))
    assert (a.tolist(), b.tolist()) == ([0, 9], [6, 12])
