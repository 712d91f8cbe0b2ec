import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm import packing
from martloom.llm.queries import TOKENIZER
from martloom.llm.tokens import WordCache

ODD = [
    "it's don't we'll", "a <|endoftext|> b", "ÀÉ Ünḯ ǅ", "12ab,'s 'S x'S", "", "\x1c \x85 a", "ß ẞ İ ı ſ K", "a" * 3000, "é́ é́",
    "日本語 テ 1,000kg $5", "a\tb\r\nc  d", "a.b, c. d, e. f,", "x!!. y., z", "...,. ,", "µ ª º ·. ×, ÷.", "A.B. c .", "’ “a, b.”",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_the_tokenizers(tokenizer, all_rows):
    texts = ODD + [t or "" for _, t in all_rows if len(t or "") < 10_000]
    cache = WordCache(TOKENIZER, most=50)  # is emptied again and again
    for _ in range(2):
        got = [ids for t in texts for ids in cache.encode([t])]
        assert got == [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x250), max_size=40), max_size=5))
def test_ids_of_any_text(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)] if texts else []
    assert WordCache(TOKENIZER).encode(texts) == expected


def test_pack_every_token_once(docs, all_rows, tokenizer):
    got = packing.pack(docs, TOKENIZER, room=256, buckets=3).collect()
    expected = Counter()
    for d, t in all_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            expected[(d, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    lengths = Counter(r.length for r in got)
    assert len(sequences) == sum(n for _, n in packing.plan(lengths, 256))


def _first_fit(sizes, room):
    bins = []
    for s in sorted(sizes, reverse=True):
        for i, used in enumerate(bins):
            if used + s <= room:
                bins[i] += s
                break
        else:
            bins.append(s)
    return len(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60), st.integers(30, 40))
def test_plan_is_whole_and_as_good_as_first_fit(sizes, room):
    patterns = packing.plan(Counter(sizes), room)
    held = Counter()
    for pattern, times in patterns:
        assert sum(s * n for s, n in pattern) <= room
        for s, n in pattern:
            held[s] += n * times
    assert held == Counter(sizes)
    total = sum(n for _, n in patterns)
    assert -(-sum(sizes) // room) <= total <= _first_fit(sizes, room)


def _fewest(sizes, room):
    """Exhaustive search."""
    best = len(sizes)

    def put(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + rest[0] <= room:
                put(rest[1:], [*bins[:i], bins[i] + rest[0], *bins[i + 1 :]])
        put(rest[1:], [*bins, rest[0]])

    put(sorted(sizes, reverse=True), [])
    return best


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9), st.integers(20, 24))
def test_reduction_loses_nothing(sizes, room):
    fixed, left = packing.reduce_by_dominance(dict(Counter(sizes)), room)
    rest = [s for s, n in left.items() for _ in range(n)]
    fewest = _fewest(rest, room) if rest else 0
    assert sum(n for _, n in fixed) + fewest == _fewest(sizes, room)


def test_slots_follow_each_other():
    rows = packing.slots([(((3, 2), (1, 1)), 5), (((3, 1),), 2)])
    assert sorted(rows) == [(1, 0, 5, 0, 6), (3, 0, 5, 0, 0), (3, 5, 5, 0, 3), (3, 10, 2, 5, 0)]


def test_many_pieces_of_one_length(spark):
    df = spark.createDataFrame([(i, "a b c") for i in range(random.Random(1).randint(300, 400))], "doc_id long, text string")
    got = packing.pack(df, TOKENIZER, room=10).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got) == df.count()


def test_empty_table(empty_docs):
    assert packing.pack(empty_docs, TOKENIZER).collect() == []


def test_special_tokens_in_mixed_case(tokenizer):
    special = [s for s in WordCache(TOKENIZER).special if s != s.upper()]
    texts = [f"a {form} b" for s in special for form in (s.upper(), s.title(), s.swapcase(), s)] + ["a <|EndOfText|> É", "x<|ENDOFTEXT|>y"]
    assert special
    assert WordCache(TOKENIZER).encode(texts) == [
        np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]


def test_patterns_are_bounded_by_lengths_not_by_pieces():
    for histogram in ({1500: 20_000}, {1500: 20_001, 1200: 7}, {2000: 9000, 1500: 20_000, 500: 30_000}, {1365: 100_000, 1366: 50_001}):
        patterns = packing.plan(histogram, 4096)
        assert len(patterns) <= 4 * len(histogram) + 4
        used = Counter()
        for pattern, times in patterns:
            assert sum(s * c for s, c in pattern) <= 4096
            for s, c in pattern:
                used[s] += c * times
        assert used == histogram
    assert sum(n for _, n in packing.plan({1500: 20_000}, 4096)) == 10_000
