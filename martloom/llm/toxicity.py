"""Toxic documents by a subsequence string kernel and a support vector machine on Nystroem landmarks.

The kernel compares strings by their subsequences of four characters that lie within ``SPAN`` characters, each
weighted by ``DECAY`` per character skipped (Lodhi et al., 2002), so an insult with inserted characters or gaps
still shares most subsequences with the plain one. Characters are folded: case, digits and signs that stand for
letters.

Landmarks are word beginnings that toxic documents of the sample have and others lack, and as many ordinary ones.
A short passage (``WINDOW`` characters) is mapped to its kernel values with the landmarks, whitened by their own kernel
matrix; a linear machine with squared hinge loss separates passages of toxic documents around a landmark from
passages of other documents, the hardest of which are looked for in two more rounds. As kernel values are sums over
subsequences, the machine is one weight per subsequence: a document is scored by a table look-up at every place.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import id_and_text
from martloom.llm.labelled import held_out, sample

#: Labelled documents that are learned from, and the longest of them in characters.
PER_CLASS, LONGEST = {1: 1500, 0: 3000}, 30_000
SPAN, DECAY, WINDOW, LANDMARKS = 7, 0.8, 18, 96
_GAPS = [(a, b, c, DECAY ** (c - 3)) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]
_CODES = 1 << 20  # four characters of 5 bits; 0 stands for no character


def _folding() -> np.ndarray:
    kind = np.full(256, 27, np.uint8)  # everything between words
    for k in range(26):
        kind[[65 + k, 97 + k]] = k + 1
    for sign, letter in zip(b"0134578@$", b"oieastbas", strict=True):
        kind[sign] = letter - 96
    kind[128:] = 28 + np.arange(128) % 4  # bytes of other letters
    return kind


_FOLD = _folding()


_BETWEEN = 27


def fold(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, and where each starts; signs between letters that stand alone are left out: "a b c" is "abc"."""
    symbols = _FOLD[data]
    if len(symbols) < 3:
        return symbols, at
    between = symbols == _BETWEEN
    alone = ~between
    alone[1:] &= between[:-1]
    alone[:-1] &= between[1:]
    left_out = np.zeros(len(symbols), bool)
    left_out[1:-1] = between[1:-1] & alone[:-2] & alone[2:]
    edges = np.clip(at[1:-1], 1, len(symbols) - 1)
    left_out[edges] = left_out[edges - 1] = False
    return symbols[~left_out], at - np.concatenate([[0], np.cumsum(left_out)])[at]


def _symbols(text: bytes) -> np.ndarray:
    return fold(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]


def _padded(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded texts with ``WINDOW`` places that weigh nothing behind each; where each starts, and its length."""
    folded, at = fold(data, at)
    begin = at[:-1] + WINDOW * np.arange(len(at) - 1)
    out = np.zeros(len(folded) + WINDOW * (len(at) - 1), np.uint8)
    for a, b, to in zip(at[:-1].tolist(), at[1:].tolist(), begin.tolist(), strict=True):
        out[to : to + b - a] = folded[a:b]
    return out, begin, np.diff(at)


def _codes(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each gap pattern, the subsequence that starts at each place (of the last axis); 0 if it meets padding."""
    wide = symbols.astype(np.int32)
    n = wide.shape[-1]
    real = wide > 0
    for a, b, c, weight in _GAPS:
        if n > c:
            at = [(slice(k, n - c + k)) for k in (0, a, b, c)]
            code = wide[..., at[0]] << 15 | wide[..., at[1]] << 10 | wide[..., at[2]] << 5 | wide[..., at[3]]
            yield code * (real[..., at[0]] & real[..., at[1]] & real[..., at[2]] & real[..., at[3]]), weight


def subsequences(text: bytes) -> dict[int, float]:
    """The feature map of one string."""
    out: Counter = Counter()
    for code, weight in _codes(_symbols(text)):
        for c in code.tolist():
            out[c] += weight
    out.pop(0, None)
    return out


def _matrix(texts: list[bytes], landmarks: list[dict[int, float]]) -> np.ndarray:
    """Kernel values of short texts (rows) with landmarks."""
    codes = sorted({c for z in landmarks for c in z})
    table, row = np.zeros((1 + len(codes), len(landmarks)), np.float32), np.zeros(_CODES, np.int32)
    row[codes] = np.arange(1, len(codes) + 1)
    for j, z in enumerate(landmarks):
        table[row[list(z)], j] = list(z.values())
    symbols = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        folded = _symbols(t)[:WINDOW]
        symbols[i, : len(folded)] = folded
    out = np.zeros((len(texts), len(landmarks)), np.float32)
    for low in range(0, len(texts), 1000):
        for code, weight in _codes(symbols[low : low + 1000]):
            rows = row[code]
            text, place = np.nonzero(rows)
            np.add.at(out, text + low, weight * table[rows[text, place]])
    return out


@dataclass(frozen=True)
class Machine:
    weights: np.ndarray  # per subsequence
    bias: float
    document: np.ndarray  # of the document's evidence

    def margins(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: the largest margin of its passages, and the number of separate passages above 0."""
        symbols, begin, size = _padded(data, at)
        total = np.concatenate([[0], np.cumsum(self.worth(symbols), dtype=np.float64)])
        sums = total[WINDOW:] - total[:-WINDOW] + self.bias
        best, hits = np.full(len(size), self.bias), np.zeros(len(size))
        above = np.concatenate([[0], np.cumsum((sums[1:] > 0) & (sums[:-1] <= 0))])
        have = np.flatnonzero(size)
        if len(have):
            edges = np.stack([begin[have], begin[have] + size[have]], 1).ravel()
            best[have] = np.maximum.reduceat(np.r_[sums, np.full(WINDOW, -np.inf)], edges)[::2]
            ends = np.minimum(begin[have] + size[have], len(above) - 1)
            hits[have] = above[ends] - above[np.minimum(begin[have], len(above) - 1)]
        return best, hits

    def worth(self, symbols: np.ndarray) -> np.ndarray:
        """The weights of the subsequences that start at each place; those that meet padding weigh nothing."""
        n, out = len(symbols), np.zeros(len(symbols) + 1, np.float32)
        last = symbols.astype(np.int32)
        parts = [last << 15, last << 10, last << 5, last]
        for c in range(3, min(SPAN, n)):
            some = np.zeros(n - c, np.float32)
            for a, b, end, _ in _GAPS:
                if end == c:
                    some += self.weights[parts[0][: n - c] | parts[1][a : n - c + a] | parts[2][b : n - c + b] | parts[3][c:]]
            out[: n - c] += np.float32(DECAY ** (c - 3)) * some
        return out

    def evidence(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        best, hits = self.margins(data, at)
        size = np.log1p(np.diff(at) / 500)
        return np.c_[np.clip(best, -3, 3), np.log1p(hits), np.minimum(hits, 6), np.log1p(hits) * size, size, np.ones(len(best))]

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        raw = self.evidence(data, at) @ self.document
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


_STARTS = re.compile(rb"[A-Za-z\x80-\xff]{4,}")


def _beginnings(text: bytes) -> set[bytes]:
    """Word beginnings of 4 to 9 bytes, in lower case, and whole words up to 10 bytes."""
    found = set()
    for w in set(_STARTS.findall(text.lower())):
        found.update(w[:k] for k in range(4, min(len(w), 9) + 1))
        if len(w) <= 10:
            found.add(w)
    return found


def landmarks(toxic: list[bytes], clean: list[bytes], most: int = LANDMARKS) -> tuple[list[bytes], list[bytes]]:
    """Beginnings that mark toxic documents, each for documents the ones before do not cover well, and ordinary ones."""
    often = np.zeros(1 << 22, np.uint16)  # documents by hash: most beginnings occur in one only and are not kept
    for t in toxic:
        often[np.unique([zlib.crc32(b) & (1 << 22) - 1 for b in _beginnings(t)] or [0])] += 1
    held = [{b for b in _beginnings(t) if often[zlib.crc32(b) & (1 << 22) - 1] >= 3} for t in toxic]
    in_toxic, in_clean = Counter(b for h in held for b in h), Counter()
    for t in clean:
        in_clean.update(b for b in _beginnings(t) if b in in_toxic)
    scale = max(1, len(clean)) / max(1, len(toxic))
    telling = {b: n for b, n in in_toxic.items() if n >= 3 and 3 * in_clean[b] <= n * scale}
    covered, marks = Counter(), []
    docs_of: dict[bytes, list[int]] = {}
    for i, h in enumerate(held):
        for b in h:
            if b in telling:
                docs_of.setdefault(b, []).append(i)
    while docs_of and len(marks) < most // 2:
        gain, _, best = max(
            ((sum(covered[i] < 2 for i in d) - in_clean[b] / scale, len(b), b) for b, d in docs_of.items()), default=(0, 0, b"")
        )
        if gain < 3:
            break
        for i in docs_of.pop(best):
            covered[i] += 1
        docs_of = {b: d for b, d in docs_of.items() if not (b.startswith(best) or best.startswith(b) and len(best) - len(b) <= 1)}
        marks.append(best)
    ordinary = [b for b, _ in sorted(in_clean.items(), key=lambda x: (-x[1], x[0]))[:4000] if len(b) >= 5][: 8 * most : 8]
    return marks, ordinary[: max(8, most - len(marks))]


def _passage(text: bytes, place: int) -> bytes:
    low = max(0, place - 4)
    return text[low : low + WINDOW]


def _varied(insult: bytes, rng: np.random.Generator) -> bytes:
    """The string with characters put between its own: the same one throughout, or one at a random place."""
    between = rng.choice([b" ", b".", b"-", b"*", b"_"])
    if rng.random() < 0.5:
        return between.join(insult[i : i + 1] for i in range(len(insult)))
    at = int(rng.integers(1, len(insult)))
    return insult[:at] + bytes([int(rng.integers(97, 123))]) + insult[at:]


def _separate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Linear machine, squared hinge loss, by Newton steps on the active rows."""
    x1 = np.c_[x, np.ones(len(x))].astype(np.float64)
    w = np.zeros(x1.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-9
    for _ in range(40):
        slack = 1 - y * (x1 @ w)
        on = slack > 0
        if not on.any():
            break
        active, a = x1[on], weight[on]
        gradient = ridge * w - active.T @ (a * y[on] * slack[on]) / weight.sum()
        curve = (active * a[:, None]).T @ active / weight.sum() + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def fit(toxic: list[bytes], clean: list[bytes], toxic_share: float, seed: int = 11) -> Machine:
    """The machine learned from whole documents; without both classes every document scores the share of toxic ones."""
    even = np.log((toxic_share + 1e-3) / (1 - toxic_share + 1e-3))
    zero = Machine(np.zeros(_CODES, np.float32), 0.0, np.array([0, 0, 0, 0, 0, even]))
    marks, ordinary = landmarks(toxic, clean)
    if not marks or not clean:
        return zero
    rng = np.random.default_rng(seed)
    maps = [subsequences(z) for z in (*marks, *ordinary)]
    norms = [sum(v * v for v in m.values()) ** 0.5 for m in maps]
    maps = [{c: v / n for c, v in m.items()} for m, n in zip(maps, norms, strict=True) if n]
    values, vectors = np.linalg.eigh(_gram(maps))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
    positive = []
    for t in toxic:
        low = t.lower()
        for z in marks:
            for m in list(re.finditer(rb"(?<![a-z\x80-\xff])" + re.escape(z), low))[:2]:
                positive.append(_passage(t, m.start()))
    positive += [_varied(p.split()[0], rng) for p in positive if p.split() and len(p.split()[0]) >= 5][:600]
    marked = [z for z in marks for _ in range(12)]
    positive += [_varied(z, rng) for z in marked if len(z) >= 5]
    xp = _matrix(positive, maps) @ whiten
    machine = zero
    # what holds a landmark in a clean document says nothing about the passage; the document's evidence decides there
    either = re.compile(b"|".join(map(re.escape, marks)), re.IGNORECASE)
    unmarked = [either.sub(b"", t) for t in clean]
    negative = [t[p : p + WINDOW] for t in unmarked for p in rng.integers(0, max(1, len(t) - WINDOW), 4).tolist()]
    xn = _matrix(negative, maps) @ whiten
    for round_ in range(3):
        x = np.r_[xp, xn]
        y = np.r_[np.ones(len(xp)), -np.ones(len(xn))]
        w, bias = _separate(x, y, np.r_[np.full(len(xp), 1 / len(xp)), np.full(len(xn), 1 / len(xn))])
        beta = whiten @ w
        table = np.zeros(_CODES, np.float32)
        for m, b in zip(maps, beta, strict=True):
            for c, v in m.items():
                table[c] += b * v
        machine = Machine(table, bias, zero.document)
        if round_ < 2:  # passages of clean documents that look worst
            hard = [p for p in (_worst(machine, t) for t in unmarked) if p]
            xn = np.r_[xn, _matrix(hard, maps) @ whiten]
    return _calibrated(machine, toxic, clean, toxic_share)


def _gram(maps: list[dict[int, float]]) -> np.ndarray:
    out = np.zeros((len(maps), len(maps)))
    for i, a in enumerate(maps):
        for j, b in enumerate(maps[: i + 1]):
            out[i, j] = out[j, i] = sum(v * b.get(c, 0.0) for c, v in a.items())
    return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _worst(machine: Machine, text: bytes) -> bytes:
    total = np.concatenate([[0], np.cumsum(machine.worth(_symbols(text)), dtype=np.float64)])
    best = int(np.argmax(total[WINDOW:] - total[:-WINDOW])) if len(total) > WINDOW else 0
    return text[best : best + WINDOW]


def _calibrated(machine: Machine, toxic: list[bytes], clean: list[bytes], share: float) -> Machine:
    """Logistic scores of documents from the evidence of their passages, at the true share of toxic ones."""
    x = np.concatenate([machine.evidence(*_joined([t])) for t in (*toxic, *clean)])
    y = np.r_[np.ones(len(toxic)), np.zeros(len(clean))]
    share = min(max(share, 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, share / len(toxic), (1 - share) / len(clean))
    ridge = np.r_[np.full(x.shape[1] - 1, 3e-4), 1e-9]
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, x.T @ (weight * (p - y)) + ridge * w)
        w -= step * min(1.0, 4 / np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return Machine(machine.weights, machine.bias, w)


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    known = id_and_text(docs).where(F.char_length("text") <= LONGEST)
    rows = sample(known, labels, "toxic", PER_CLASS).orderBy("doc_id", "text").select("text", "y").toPandas()
    texts = {y: [t.encode() for t in rows["text"][rows["y"] == y]] for y in (0, 1)}
    share = labels.where(~held_out()).agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return fit(texts[1], texts[0], share or 0.0)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= 0.5) for every row, from its whole text.

    A NULL text scores as an empty one; rows that repeat a doc_id score each; a NULL doc_id stays NULL. No labels of one
    class: every score is the share of toxic labels. No rows, no rows.
    """
    machine = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, limit=1 << 18):
            score = machine.score(*arrays.texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
