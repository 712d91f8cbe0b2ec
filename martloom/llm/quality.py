"""Document quality as a Bradley-Terry model.

A preference pair is a document labelled good and one labelled bad; the good one wins with probability
sigmoid(score(good) - score(bad)), score being linear in the features, so the weights are those of a logistic regression
without intercept on feature differences. The threshold is a quantile of the labelled documents' scores: the share of bad
labels. Scores are shifted so that it becomes 0.3.

Every labelled document that may be learned from takes part. Features are found once per document and written; those of
labelled documents are packed into blocks by a hash of doc_id, in which good and bad ones meet. Each pass (scales, Newton
steps, threshold) is arithmetic on whole blocks, added up as whole numbers, so neither order nor partitions matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import cut, id_and_text, prepared
from martloom.llm.labelled import held_out

#: Documents of the other class that each document meets (the one with the fewer documents; of the other, as many as that
#: takes, at least one), labelled documents of a block, whole units of a sum, and ranges a search for a rank looks at.
PAIRS, BLOCK, UNIT, RANGES = 8, 4096, float(1 << 40), 4096
THRESHOLD = 0.3


def _class_table() -> np.ndarray:
    kind = np.full(256, 9, np.uint8)  # control characters and other punctuation
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:'-", b"!?", b"|\t", b"#$%&*@^~=+<>{}[]_\\/")):
        kind[list(chars)] = k
    kind[128:] = 10
    return kind


_CLASS, _CLASSES = _class_table(), 11
FEATURES = _CLASSES + 7


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row per text: shares of byte classes, and what its words are like."""
    n, size = len(at) - 1, np.maximum(np.diff(at), 1)
    out = np.zeros((n, FEATURES))
    kind = _CLASS[data]
    for k in range(_CLASSES):
        total = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        out[:, k] = (total[at[1:]] - total[at[:-1]]) / size
    letters = out[:, 0] + out[:, 1]
    out[:, 1] /= np.maximum(letters, 1e-9)  # capitals among ASCII letters
    start, end, first = arrays.words(data, at)
    words = np.diff(first)
    some = np.maximum(words, 1)
    h = arrays.span_hashes(data, start, end)
    text = np.repeat(np.arange(n), words)
    for k in (1, 2, 3):  # words that are there again k words later
        again = (h[k:] == h[:-k]) & (text[k:] == text[:-k]) if len(h) > k else np.zeros(0, bool)
        out[:, _CLASSES + k - 1] = np.bincount(text[: len(again)][again], minlength=n) / some
    order = np.lexsort((h, text))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])] if len(h) else np.zeros(0, bool)
    out[:, _CLASSES + 3] = np.bincount(text[order][new], minlength=n) / some / (1 + 0.05 * np.log1p(words))
    long = np.bincount(text, weights=end - start, minlength=n) / some
    out[:, _CLASSES + 4] = np.minimum(long, 40) / 10
    odd = _CLASS[data[end - 1]] if len(end) else np.zeros(0, np.uint8)
    out[:, _CLASSES + 5] = np.bincount(text[(odd == 6) | (odd == 8)], minlength=n) / some  # words that end in a symbol
    out[:, _CLASSES + 6] = np.log1p(words) / 10
    return out


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = (np.clip((x - self.mean) / self.scale, -8, 8)) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, bad_share: float, penalty: float = 1e-3, seed: int = 7) -> Ranking:
    """The ranking learned from features and labels; without both labels every document scores the threshold."""
    if not len(x) or len(np.unique(y)) < 2:
        return Ranking(np.zeros(FEATURES), np.zeros(FEATURES), np.ones(FEATURES), 0.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    bad = np.repeat(np.flatnonzero(y == 0), PAIRS)
    differ = z[rng.choice(np.flatnonzero(y == 1), len(bad))] - z[bad]
    w = np.zeros(FEATURES)
    for _ in range(30):  # Newton steps on the mean logistic loss
        p = 1 / (1 + np.exp(np.clip(differ @ w, -30, 30)))
        gradient = -differ.T @ p / len(differ) + penalty * w
        curve = (differ * (p * (1 - p))[:, None]).T @ differ / len(differ) + penalty * np.eye(FEATURES)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    # the quantile of a corpus with its share of bad documents, from classes sampled apart
    weight = np.where(y == 0, bad_share / (y == 0).sum(), (1 - bad_share) / (y == 1).sum())
    order = np.argsort(raw, kind="stable")
    at = int(np.searchsorted(np.cumsum(weight[order]), bad_share))
    return Ranking(w, mean, scale, float(raw[order][max(0, at - 1) : at + 2].mean()))


def pairs(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the good and the bad document of each pair of a block; every document is in one, if both classes are there.

    Each bad one meets the next ``PAIRS`` good ones, or more where that leaves good ones out, around the block.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    each = max(PAIRS, -(-len(good) // len(bad)))
    return good[np.arange(each * len(bad)) % len(good)], np.repeat(bad, each)


def _totals(blocks: DataFrame, found: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of what ``found`` makes of features and labels, an array of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for batch in batches:
            for x, y in _unpacked(batch):
                own = [int(v) for v in np.rint(found(x, y) * UNIT)]
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.decimal128(38, 0))], ["place", "total"])

    rows = blocks.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    return np.array([int(r["total"]) / UNIT for r in sorted(rows.collect(), key=lambda r: r["place"])])  # some hundred numbers


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
        yield np.array(x, float).reshape(len(y), FEATURES), np.array(y, np.int64)


def _featured(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches):
            x = features(*arrays.texts(batch.column("text")))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "x"])

    return docs.mapInArrow(run, "doc_id long, x array<double>")


def _labelled(docs: DataFrame, featured: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, x, y of every document that may be learned from.

    Of several labels of a doc_id the largest counts, of several texts the first in order. Texts are compared only where
    rows of one doc_id differ in their features.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("y")).where("y IN (0, 1)")
    found = featured.join(known, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.max("x").alias("_last"), F.max("y").alias("y"))
    found = cut(found, "quality-labelled")
    unlike = cut(found.where("x <> _last").select("doc_id", "y"), "quality-unlike")
    first = docs.join(unlike, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    picked = _featured(first.select("doc_id", "text")).join(unlike, "doc_id").select("doc_id", "x", "y")
    return found.where("x = _last").select("doc_id", "x", "y").unionByName(picked)


def _blocks(rows: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Rows packed into blocks by a hash of doc_id, and how many there are of each class."""
    rows = cut(rows, "quality-rows")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # at least some dozens of the rarer class in a block
    many = max(1, min(-(-sum(sizes.values()) // BLOCK), min(sizes.get(0, 0), sizes.get(1, 0)) // 64))
    hashed = F.xxhash64("doc_id")
    packed = rows.groupBy(F.pmod(hashed, F.lit(many)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(hashed.alias("h"), "doc_id", "x", "y"))).alias("r")
    )
    return cut(packed.select(F.flatten("r.x").alias("x"), F.col("r.y").alias("y")), "quality-blocks"), sizes


def _crossing(scores: DataFrame, sizes: dict[int, int], bad_share: float) -> float:
    """The score at which the rows up to it weigh ``bad_share``, as in :func:`fit`; ranges are narrowed until one value is left."""
    weight = bad_share / sizes[0], (1 - bad_share) / sizes[1]
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    before = 0.0
    while low < high:
        step = (high - low) / RANGES
        place = F.least(F.floor((F.col("raw") - low) / step), F.lit(RANGES - 1)).alias("place")
        ranges = scores.where(F.col("raw").between(low, high)).groupBy(place).agg(
            F.count_if(F.col("y") == 0).alias("bad"), F.count_if(F.col("y") == 1).alias("good"), F.min("raw").alias("low"), F.max("raw").alias("high")
        )
        for r in sorted(ranges.collect(), key=lambda r: r["place"]):  # at most RANGES
            low, high, own = r["low"], r["high"], r["bad"] * weight[0] + r["good"] * weight[1]
            if before + own >= bad_share:
                break
            before += own
    raw = F.col("raw")
    below, above, n = scores.agg(F.max(F.when(raw < low, raw)), F.min(F.when(raw > low, raw)), F.count_if(raw == low)).first()
    near = [v for v in (below, low, above) if v is not None] if n == 1 else [low]
    return float(np.mean(near))


def train(docs: DataFrame, labels: DataFrame, featured: DataFrame | None = None) -> Ranking:
    """The ranking learned from every labelled document; ``featured``: :func:`_featured` of ``docs`` as a table, if there is one."""
    docs = id_and_text(docs)
    featured = cut(_featured(docs), "quality-features") if featured is None else featured
    blocks, sizes = _blocks(_labelled(docs, featured, labels))
    if not sizes.get(0) or not sizes.get(1):
        return fit(np.zeros((0, FEATURES)), np.zeros(0), 0.0)
    n = sum(sizes.values())
    mean = _totals(blocks, lambda x, y: x.sum(0)) / n
    scale = np.maximum(np.sqrt(_totals(blocks, lambda x, y: ((x - mean) ** 2).sum(0)) / n), 1e-3)

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -8, 8)

    w, penalty = np.zeros(FEATURES), 1e-3
    for _ in range(30):  # Newton steps on the mean logistic loss

        def slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            z, (good, bad) = scaled(x), pairs(y)
            differ = z[good] - z[bad]
            p = 1 / (1 + np.exp(np.clip(differ @ w, -30, 30)))
            return np.concatenate([[len(bad)], -differ.T @ p, ((differ * (p * (1 - p))[:, None]).T @ differ).ravel()])

        met, *sums = _totals(blocks, slopes)
        if not met:
            break
        gradient = np.array(sums[:FEATURES]) / met + penalty * w
        curve = np.array(sums[FEATURES:]).reshape(FEATURES, FEATURES) / met + penalty * np.eye(FEATURES)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in _unpacked(batch):
                yield pa.RecordBatch.from_arrays([pa.array(scaled(x) @ w), pa.array(y, pa.int32())], ["raw", "y"])

    scores = cut(blocks.mapInArrow(run, "raw double, y int"), "quality-scores")
    shares = labels.where(~held_out()).agg(F.avg((F.col("quality") == 0).cast("double"))).first()[0]
    return Ranking(w, mean, scale, _crossing(scores, sizes, shares or 0.0))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= 0.3) for every row.

    A NULL text scores as an empty one; rows that repeat a doc_id score each; a NULL doc_id stays NULL. No labels: every
    score is 0.3. No rows, no rows.
    """
    featured = cut(_featured(id_and_text(docs)), "quality-features")
    model = train(docs, labels, featured)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = featured.mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all their columns, that the classifier accepts; the decision is made where the row is."""
    model, names = train(docs, labels), docs.columns
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches):
            score = model.score(features(*arrays.texts(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(batch.columns, names).filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
