"""Word windows that an earlier document has, removed: super-k-mers, sorted in the bucket of their minimiser.

Consecutive windows of a document that share a minimiser are one string (see ``repeats``). In its bucket the windows
of all strings are sorted by their words: words get numbers, pairs of neighbours get numbers in sorted order, then
pairs of those, until a number stands for the whole window. Equal numbers are equal windows, and the smallest document
of each is known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martloom.llm.repeats import Found, Scheme, compared_rows, groups, union_spans, words_of

#: Distinct strings of one part of a minimiser, and bytes of the strings compared at once.
BLOCK, AT_ONCE = 8192, 1 << 22


def sorted_numbers(ids: np.ndarray, size: int) -> np.ndarray:
    """For each place, the rank of the ``size`` numbers from there on among all such windows; ids are not negative."""
    rank, have = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while have < size:
        step = min(have, size - have)
        if len(rank) <= step:
            return rank[:0]
        pair = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        rank, have = np.unique(pair, return_inverse=True)[1].astype(np.int64), have + step
    return rank


def _compare(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, AT_ONCE):
            held = {n: batch.column(n).to_numpy() for n in ("minimiser", "part", "windows", "first_doc")}
            split = [s.as_py().split(b" ") for s in batch.column("string")]
            number: dict[bytes, int] = {}
            ids = np.array([number.setdefault(w, len(number)) for ws in split for w in ws], np.int64)
            begin = np.cumsum([0, *map(len, split)])
            rank = sorted_numbers(ids, size)
            windows = held["windows"]
            string = np.repeat(np.arange(len(split)), windows)
            window = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
            group = np.cumsum(np.r_[0, (np.diff(held["minimiser"]) != 0) | (np.diff(held["part"]) != 0)])
            same = np.unique(group[string] * (len(rank) + 1) + rank[begin[string] + window], return_inverse=True)[1]
            owner = held["first_doc"][string]
            best = np.full(same.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(best, same, owner)
            later = owner > best[same]
            at = np.searchsorted(string, np.arange(len(split) + 1))
            hits = [window[a:b][later[a:b]] for a, b in zip(at, at[1:], strict=False)]
            yield compared_rows(batch, hits)

    return run


def _cut_out(text: bytes, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    ws = text.split()
    return [b" ".join(ws[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _keep(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    ws = text.split()
    a, b = union_spans(start, end)
    edge = [0, *np.stack([a, b], 1).ravel().tolist(), len(ws)]
    kept = [w for x, y in zip(edge[::2], edge[1::2], strict=True) for w in ws[x:y]]
    joined = b" ".join(kept)
    return len(ws), len(ws) - len(kept), hashlib.sha256(joined).hexdigest(), joined


def remove_seen(docs: DataFrame, size: int = 50, gram: int = 10, block: int = BLOCK) -> DataFrame:
    """Texts without the words that some window of ``size`` words covers which also starts in a smaller doc_id.

    Words are runs of bytes other than space and 9 to 13. Returns doc_id, n_words, n_removed, kept_sha256 and kept, the
    words that stay, joined by one space. A NULL text has no words. Rows that repeat a doc_id are texts of one document:
    they do not remove each other's words. A NULL doc_id stays NULL and counts as the smallest. No rows, no rows.
    """
    found = Found.of(docs, Scheme(size, gram, words_of), across_docs=True)
    ranges = found.ranges(_cut_out, _compare(size), block, "best < first_doc")
    spans = found.spans(ranges, "first_doc < doc_id")
    return found.kept(spans, _keep, "n_words long, n_removed long, kept_sha256 string, kept binary")
