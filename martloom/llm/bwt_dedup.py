"""Byte windows that occur twice, removed everywhere: column-wise construction over many documents.

The strings to compare (see ``repeats``) are aligned at their minimiser, where equal windows must meet. One symbol of
every string is inserted per round, from the right: the strings stand in the order of their suffixes, the symbols in
front of them, read in that order, are the round's column of the collection's Burrows-Wheeler transform, and sorting
stably by it gives the next order. The common prefix of neighbours grows by one where their symbols agree (the
smallest common prefix between their old places, plus one) and is 0 where not. A window that starts in this column
occurs again if its suffix shares ``size`` bytes with a neighbour.

Suffixes of different columns are not merged into one order: since the alignment lets equal windows meet in one
column, they could never match. A part is bounded, so its columns are arrays, written and read in sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martloom.llm import arrays
from martloom.llm.repeats import Found, Scheme, bytes_of, compared_rows, groups, union_spans

#: Distinct strings of one part of a minimiser, and bytes of the strings compared at once.
BLOCK, AT_ONCE = 8192, 1 << 22


def _columns(strings: pa.Array, place: np.ndarray) -> tuple[np.ndarray, int]:
    """One row per string, aligned: symbols 1 to 256, 0 where a string has none. Also the column of the alignment."""
    data, at = arrays.texts(strings)
    length = np.diff(at)
    left = int(place.max())
    table = np.zeros((len(length), left + int((length - place).max())), np.uint16)
    row = np.repeat(np.arange(len(length)), length)
    table[row, np.arange(len(data)) - np.repeat(at[:-1], length) + left - place[row]] = data.astype(np.uint16) + 1
    return table, left


def insert_columns(table: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Where the next ``size`` symbols of a string are also those of another string of its group, column by column.

    Returns a boolean table. ``group`` is ascending.
    """
    n, width = table.shape
    hit = np.zeros((n, width), bool)
    order, lcp = np.arange(n), np.zeros(n + 1, np.int32)
    symbols = np.ascontiguousarray(table.T)
    shift = group.astype(np.int64) * 257
    for column in range(width - 1, -1, -1):
        symbol = symbols[column][order]  # this column of the transform
        key = shift[order] + symbol
        perm = np.argsort(key, kind="stable")
        ordered = key[perm]
        pair = np.flatnonzero((ordered[1:] == ordered[:-1]) & (symbol[perm[1:]] > 0))
        order = order[perm]
        new = np.zeros(n + 1, np.int32)
        if len(pair):
            between = np.empty(2 * len(pair), np.int64)
            between[::2], between[1::2] = perm[pair] + 1, perm[pair + 1] + 1
            new[pair + 1] = np.minimum.reduceat(lcp, between)[::2] + 1
        lcp = new
        again = lcp[:n] >= size
        if again.any():
            hit[order[again], column] = True
            hit[order[np.flatnonzero(again) - 1], column] = True
    return hit


def _compare(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, AT_ONCE):
            held = {n: batch.column(n).to_numpy() for n in ("minimiser", "part", "place", "windows")}
            table, left = _columns(batch.column("string"), held["place"])
            group = np.cumsum(np.r_[0, (np.diff(held["minimiser"]) != 0) | (np.diff(held["part"]) != 0)])
            hit = insert_columns(table, group, size)
            begin = left - held["place"]
            window = np.arange(table.shape[1])
            valid = (window >= begin[:, None]) & (window < (begin + held["windows"])[:, None])
            hit &= valid
            rows, columns = np.nonzero(hit)
            at = np.searchsorted(rows, np.arange(len(begin) + 1))
            hits = [columns[a:b] - s for a, b, s in zip(at, at[1:], begin, strict=False)]
            yield compared_rows(batch, hits)

    return run


def _cut_out(text: bytes, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    return [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _keep(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    a, b = union_spans(start, end)
    edge = [0, *np.stack([a, b], 1).ravel().tolist(), len(text)]
    kept = b"".join(text[x:y] for x, y in zip(edge[::2], edge[1::2], strict=True))
    return len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept


def remove_repeats(docs: DataFrame, size: int = 200, gram: int = 32, block: int = BLOCK) -> DataFrame:
    """Texts without the bytes that some ``size``-byte string covers which also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept, the bytes that stay
    (removal may cut a character). A NULL text is empty; texts shorter than ``size`` stay whole. Rows that repeat a
    doc_id are texts of their own, so exact copies of at least ``size`` bytes go wherever they stand, the first one too.
    A NULL doc_id stays NULL. No rows, no rows.
    """
    found = Found.of(docs, Scheme(size, gram, bytes_of), across_docs=False)
    ranges = found.ranges(_cut_out, _compare(size), block, "n > 1")
    spans = found.spans(ranges, "copies > 1")
    return found.kept(spans, _keep, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
