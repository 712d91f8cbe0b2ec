"""Texts of Arrow batches as numpy arrays: bytes, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are worked on in pieces of about so many bytes, which bounds a task's memory.
PIECE = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts in them (NULL: empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text comes alone and whole."""
    for batch in batches:
        _, at = texts(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than space and 9 to 13, and the first word's number of each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    start = np.flatnonzero(inside & before)
    return start, np.flatnonzero(inside & after) + 1, np.searchsorted(start, at)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[i] = np.cumprod(step, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _prefix(values: np.ndarray) -> np.ndarray:
    up, _ = powers(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=total[1:])
    return total


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit number of the bytes of each span, for features: some long spans share one whatever the base."""
    total = _prefix(_BYTE[data])
    _, down = powers(len(data) + 1)
    return mixed((total[end] - total[start]) * down[start])


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, for telling spans apart: of up to 16 bytes mixed as they are, else XXH3."""
    size = end - start
    if not len(size):
        return np.zeros(0, np.uint64)
    place = start[:, None] + np.arange(16)
    held = np.where(np.arange(16) < size[:, None], data[np.minimum(place, len(data) - 1)], 0).astype(np.uint8).view(np.uint64)
    out = mixed(mixed(held[:, 0] + np.uint64(_BASE)) + held[:, 1] * np.uint64(3) + size.astype(np.uint64))
    long = np.flatnonzero(size > 16)
    if len(long):
        raw = data.tobytes()
        spans = zip(start[long].tolist(), end[long].tolist(), strict=True)
        out[long] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in spans]
    return out


def gram_hashes(values: np.ndarray, m: int) -> np.ndarray:
    """A 64-bit hash of each ``m`` consecutive values (bytes or 64-bit hashes); it says where to look, never what is equal."""
    if len(values) < m:
        return np.zeros(0, np.uint64)
    total = _prefix(_BYTE[values] if values.dtype == np.uint8 else values)
    _, down = powers(len(values) + 1)
    return mixed((total[m:] - total[:-m]) * down[: len(total) - m])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n, have = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    least = values
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:n], least[width - have : width - have + n])


def owner(bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of the text that holds each place; empty texts hold none."""
    return np.searchsorted(bounds, places, "right") - 1
