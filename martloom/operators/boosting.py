"""Gradient boosted trees, many fits at once.

All fits (folds of a cross-validation, sets of features, the final model) grow in lock-step: one Spark job per tree level
gives the gradient sums of every (fit, node, feature, bin). The sums of a fit meet in one task, which chooses its splits;
the driver gets splits only, a few numbers per node. The number of jobs is rounds times depth, whatever the number of fits.
Where the rows have at most ``CELLS`` different combinations of bins, as categories do, one job per round gives the sums of
every (fit, combination) instead, which holds all levels of the tree. Where even combination, fold, label and weight together
have at most ``CELLS`` different values (kinds of rows), all rows of a kind have one margin and one gradient: a job then
counts the kinds' rows that each of the next ``WINDOW`` trees learns from, and a fit grows them from these counts. The trees
are the same.

Rows are binned once into blocks of arrays that carry the predictions by every fit, so what a fit was not trained on is
scored on the way. A level is a pass over cached blocks whose partial sums are added in a tree; a pass is arithmetic on
whole arrays and plans no query, which at thousands of passes counts more than the rows do. Every ``WINDOW`` rounds the
blocks are written, so a lost executor costs a few rounds. Gradients are added as whole numbers: neither a retried task nor
another partitioning can change a split.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martloom.session import ship_package

Cut = Callable[[DataFrame, str], DataFrame]

#: Rounds between written predictions, rows of a block, most tasks of a pass, and whole units of a gradient.
WINDOW, ROWS, TASKS, UNIT = 50, 1 << 14, 4096, float(1 << 30)
#: Different combinations of bins up to which a round is one pass, and different kinds of rows up to which a window is.
CELLS = 1 << 14
#: Blocks that a task takes before a pass has more tasks than cores, and counts of kinds that a task holds.
BLOCKS, COUNTS = 64, 1 << 23


@dataclass(frozen=True)
class Boosting:
    """How trees grow. ``l1`` and ``l2`` shrink leaves, ``min_weight`` is the least sum of second derivatives of a side."""

    rounds: int = 400
    depth: int = 4
    rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_weight: float = 3.0
    l1: float = 0.1
    l2: float = 1.0
    seed: int = 42
    bins: int = 256
    logistic: bool = False


@dataclass(frozen=True)
class Fit:
    """One model: the places of the features it may use, and the fold it does not learn from (None: learns from all)."""

    features: tuple[int, ...]
    left_out: int | None = None


@dataclass
class Trees:
    """The trees of one fit as complete binary heaps: node i has children 2i + 1 and 2i + 2; larger values go right.

    A node that is not split sends everything left. ``cover``: sums of second derivatives of the rows a node was grown on.
    """

    names: list[str]
    base: float
    logistic: bool
    feature: np.ndarray  # (rounds, 2 ** depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (rounds, 2 ** depth)
    gain: np.ndarray
    cover: np.ndarray  # (rounds, 2 ** (depth + 1) - 1)

    @property
    def depth(self) -> int:
        return self.leaf.shape[1].bit_length() - 1

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Predictions of rows of values, before any logistic function; a missing value (NaN) goes left."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return out

    def predict(self, df: DataFrame, name: str = "prediction", columns: Sequence[str] | None = None) -> DataFrame:
        """``df`` with a prediction; ``columns`` stand for the features, in their order."""
        ship_package(df.sparkSession)
        sent, used = df.sparkSession.sparkContext.broadcast(self), list(columns or self.names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = sent.value
            for batch in batches:
                margins = trees.margins(values_of(batch, used))
                found = 1 / (1 + np.exp(-margins)) if trees.logistic else margins
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

        return df.mapInArrow(run, _with(df.schema, (name, "double")))

    def paths(self) -> list[tuple[list[tuple[int, float, float]], np.ndarray]]:
        """Of every leaf that rows reach: its conditions (feature, above, at most) and :func:`shares` of its value."""
        found, inner = [], self.feature.shape[1]
        for feature, threshold, leaf, cover in zip(self.feature, self.threshold, self.leaf, self.cover, strict=True):
            for place, value in enumerate(leaf):
                node, held = place + inner, {}
                if cover[node] <= 0:
                    continue
                while node:
                    parent, right = (node - 1) // 2, node % 2 == 0
                    f, t = int(feature[parent]), float(threshold[parent])
                    low, high, part = held.get(f, (-np.inf, np.inf, 1.0))
                    low, high = (max(low, t), high) if right else (low, min(high, t))
                    held[f] = (low, high, part * float(cover[node] / cover[parent]))
                    node = parent
                # a feature whose nodes do not split says nothing
                held = {f: v for f, v in held.items() if v[0] > -np.inf or v[1] < np.inf}
                found.append(([(f, low, high) for f, (low, high, _) in held.items()], float(value) * shares([p for *_, p in held.values()])))
        return found

    def expected(self) -> float:
        """The mean margin of the rows the trees were grown on, each node's rows going on by their shares."""
        total, inner = self.base, self.feature.shape[1]
        return total + sum(float((leaf * cover[inner:]).sum() / cover[0]) for leaf, cover in zip(self.leaf, self.cover, strict=True) if cover[0] > 0)

    def attributions(self, x: np.ndarray, paths: list | None = None) -> np.ndarray:
        """How much each feature adds to each row's margin, compared to :meth:`expected`: Shapley values over the trees.

        An unknown feature lets a row go both ways at its nodes, by the shares of the rows the trees were grown on.
        """
        out = np.zeros(x.shape)
        for conditions, table in self.paths() if paths is None else paths:
            met = np.zeros(len(x), np.int64)
            for i, (f, low, high) in enumerate(conditions):
                # a missing value goes left: it is never above anything
                inside = ~(x[:, f] > high) if low == -np.inf else (x[:, f] > low) & ~(x[:, f] > high)
                met |= inside.astype(np.int64) << i
            for i, (f, _, _) in enumerate(conditions):
                out[:, f] += table[met, i]
        return out

    def attribute(self, df: DataFrame, name: str = "attributions", columns: Sequence[str] | None = None) -> DataFrame:
        """``df`` with the :meth:`attributions`, an array in the order of the features."""
        ship_package(df.sparkSession)
        sent, used = df.sparkSession.sparkContext.broadcast((self, self.paths())), list(columns or self.names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, paths = sent.value
            for batch in batches:
                found = pa.array(list(trees.attributions(values_of(batch, used), paths)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

        return df.mapInArrow(run, _with(df.schema, (name, "array<double>")))

    def importance(self) -> np.ndarray:
        """Each feature's share of the gain of all splits."""
        total = np.bincount(self.feature.ravel(), self.gain.ravel(), minlength=len(self.names))
        return total / total.sum() if total.sum() else total

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree, and the settings with them."""
        rows = [
            (i, f.tolist(), t.tolist(), leaf.tolist(), g.tolist(), c.tolist())
            for i, (f, t, leaf, g, c) in enumerate(zip(self.feature, self.threshold, self.leaf, self.gain, self.cover, strict=True))
        ]
        meta = json.dumps({"names": self.names, "base": self.base, "logistic": self.logistic})
        trees = spark.createDataFrame(rows, _TREES).withColumn("meta", F.lit(meta))
        trees.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Trees:
        rows = spark.read.parquet(path).orderBy("tree").collect()  # as many as rounds
        meta = json.loads(rows[0]["meta"])
        columns = (np.array([r[c] for r in rows]) for c in ("feature", "threshold", "leaf", "gain", "cover"))
        return Trees(meta["names"], meta["base"], meta["logistic"], *columns)


_TREES = "tree int, feature array<int>, threshold array<double>, leaf array<double>, gain array<double>, cover array<double>"


def _with(schema: StructType, *columns: tuple[str, str]) -> StructType:
    """A schema and further columns (name, type), which it must not have yet."""
    return StructType([*schema.fields, *(StructField(name, StructType.fromDDL(f"c {kind}")[0].dataType) for name, kind in columns)])


def shares(part: list[float]) -> np.ndarray:
    """Of a leaf with value 1 the Shapley value of each condition, for every set of conditions that hold (bits of the row).

    ``part``: the share of rows that meet each condition, where it is unknown whether they do.
    """
    d = len(part)
    holds = np.array([[(p >> i) & 1 for i in range(d)] for p in range(1 << d)], float).reshape(1 << d, d)
    out = np.zeros((1 << d, d))
    for j in range(d):
        others = [k for k in range(d) if k != j]
        total = np.zeros(1 << d)
        for size in range(d):
            weight = factorial(size) * factorial(d - size - 1) / factorial(d)
            for known in combinations(others, size):
                term = np.full(1 << d, weight)
                for k in others:
                    term = term * (holds[:, k] if k in known else part[k])
                total += term
        out[:, j] = (holds[:, j] - part[j]) * total
    return out


def values_of(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """The columns as an array of doubles, a missing value as NaN."""
    held = [batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns]
    return np.stack(held, axis=1) if held else np.zeros((batch.num_rows, 0))


def cut_points(df: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """Up to ``bins`` - 1 split values per column: values at evenly spaced ranks; one pass, bounded sketches."""
    shares = ", ".join(f"{(i + 1) / bins}D" for i in range(bins - 1))
    found = df.agg(*[F.expr(f"percentile_approx(`{c}`, array({shares}), 100000)").alias(f"c{i}") for i, c in enumerate(columns)]).first()
    # the largest value is no split, but harmless: nothing lies beyond it
    return [np.unique(np.array(found[f"c{i}"] or [], float)) for i in range(len(columns))]


# ---------------------------------------------------------------- within a task
def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def sampled(key: np.ndarray, share: float, seed: int, fit: int, tree: int) -> np.ndarray:
    """The rows a tree learns from, by a hash of their key: the same ones in every pass."""
    salt = _mixed(np.array([(seed << 40) + (fit << 24) + tree + 1], np.uint64))
    return (_mixed(key ^ salt) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


@dataclass
class Block:
    """Rows as arrays: ``bins`` (rows, features), ``f`` (fits, rows) the margins so far, ``keep`` the other columns as bytes."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    key: np.ndarray
    fold: np.ndarray
    f: np.ndarray
    keep: bytes
    cell: np.ndarray | None = None  # of each row the place of its combination, or of its kind

    @staticmethod
    def read(row: Row) -> Block:
        y = np.frombuffer(row["y"])
        wide = {n: np.frombuffer(row[n], t) for n, t in (("w", float), ("key", np.uint64), ("fold", np.int32))}
        bins, f = np.frombuffer(row["bins"], np.uint8).reshape(len(y), -1), np.frombuffer(row["f"]).reshape(-1, len(y))
        return Block(bins, y, f=f, keep=bytes(row["keep"]), **wide)

    def row(self) -> tuple:
        return tuple(bytearray(a.tobytes()) for a in (self.bins, self.y, self.w, self.key, self.fold, self.f)) + (bytearray(self.keep),)


_BLOCK = "bins binary, y binary, w binary, key binary, fold binary, f binary, keep binary"


@dataclass
class _Tree:
    """Splits as bins and leaves of one tree per fit; a node that is not split has the last bin."""

    feature: np.ndarray  # (fits, nodes)
    bin: np.ndarray
    leaf: np.ndarray


def _walk(bins: np.ndarray, feature: np.ndarray, bin_: np.ndarray, depth: int) -> np.ndarray:
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        node = 2 * node + 1 + (bins[rows, feature[node]] > bin_[node])
    return node


def _grown(tree: _Tree, depth: int):
    """Blocks with a tree more in their margins."""

    def run(block: Block) -> Block:
        f, inner = block.f.copy(), tree.feature.shape[1]
        for k in range(len(f)):
            f[k] += tree.leaf[k][_walk(block.bins, tree.feature[k], tree.bin[k], depth) - inner]
        return replace(block, f=f)

    return run


def _learned(block: Block, s: Boosting, fit: Fit, k: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that a tree of a fit learns from, and their first and second derivatives as whole numbers."""
    used = sampled(block.key, s.row_share, s.seed, k, number)
    if fit.left_out is not None:
        used &= block.fold != fit.left_out
    rows = np.flatnonzero(used)
    f, y, w = block.f[k, rows], block.y[rows], block.w[rows]
    p = 1 / (1 + np.exp(-f)) if s.logistic else f
    return rows, np.rint((p - y) * w * UNIT), np.rint((p * (1 - p) if s.logistic else np.ones(len(rows))) * w * UNIT)


def _sums(at: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """Sums of g and h by place. Whole numbers below 2 ** 53 add up exactly in doubles, and a block has few rows."""
    return np.stack([np.bincount(at, g, size), np.bincount(at, h, size)]).astype(np.int64)


def _histograms(s: Boosting, fits: list[Fit], allowed: list[np.ndarray], number: int, level: int, tree: _Tree, bins: int):
    """Of some blocks the sums of first and second derivatives by (fit, node of the level, feature, bin)."""

    def run(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        nodes, total = 1 << level, None
        for block in blocks:
            features = block.bins.shape[1]
            size = nodes * features * bins
            if total is None:
                total = np.zeros((2, len(fits), size), np.int64)
            for k, fit in enumerate(fits):
                rows, g, h = _learned(block, s, fit, k, number)
                own = block.bins[rows]
                node = _walk(own, tree.feature[k], tree.bin[k], level) - (nodes - 1)
                for j in allowed[k]:
                    total[:, k] += _sums((node * features + j) * bins + own[:, j], g, h, size)
        if total is not None:
            yield total

    return run


def _cell_sums(s: Boosting, fits: list[Fit], number: int, cells: int):
    """Of some blocks the sums of first and second derivatives by (fit, combination of bins)."""

    def run(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        total = None
        for block in blocks:
            total = np.zeros((2, len(fits), cells), np.int64) if total is None else total
            for k, fit in enumerate(fits):
                rows, g, h = _learned(block, s, fit, k, number)
                total[:, k] += _sums(block.cell[rows], g, h, cells)
        if total is not None:
            yield total

    return run


def _marks(block: Block, kinds: bool) -> np.ndarray:
    """Of each row its combination of bins as bytes, for kinds with its fold, label and weight."""
    own = [block.bins, *([a[:, None].view(np.uint8) for a in (block.fold, block.y, block.w)] if kinds else [])]
    wide = np.ascontiguousarray(np.concatenate(own, axis=1))
    return wide.view(f"V{wide.shape[1]}").ravel()


def _combinations(table: DataFrame, kinds: bool = False) -> list[bytes] | None:
    """The different combinations of bins (or kinds of rows), ascending, or None if there are more than ``CELLS``."""
    most = CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for row in batch.to_pylist():
                if len(seen) <= most:
                    seen |= {bytes(m) for m in np.unique(_marks(Block.read(row), kinds))}
        yield pa.RecordBatch.from_arrays([pa.array(list(seen)[: most + 1], pa.binary())], ["mark"])

    found = table.mapInArrow(run, "mark binary").distinct().limit(most + 1).collect()
    return sorted(bytes(r["mark"]) for r in found) if len(found) <= most else None


def _celled(marks: list[bytes], kinds: bool):
    place = {m: i for i, m in enumerate(marks)}

    def run(block: Block) -> Block:
        rows, back = np.unique(_marks(block, kinds), return_inverse=True)
        return replace(block, cell=np.array([place[bytes(r)] for r in rows], np.int64)[back])

    return run


def _counts(s: Boosting, fits: int, numbers: range, kinds: int):
    """Of some blocks the rows of each kind that each tree of each fit learns from, the fold it leaves out among them."""

    def run(blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        total = None
        for block in blocks:
            total = np.zeros((fits, len(numbers), kinds), np.int64) if total is None else total
            for k in range(fits):
                for i, number in enumerate(numbers):
                    total[k, i] += np.bincount(block.cell[sampled(block.key, s.row_share, s.seed, k, number)], minlength=kinds)
        if total is not None:
            yield from enumerate(total)

    return run


# ---------------------------------------------------------------- of one fit, from sums
def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_splits(g: np.ndarray, h: np.ndarray, s: Boosting) -> tuple[np.ndarray, ...]:
    """Of sums (nodes, features, bins): feature, bin and gain (0: none) of each node's best split, ties to the first."""
    left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
    all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h

    def quality(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _shrunk(a, s.l1) ** 2 / np.maximum(b + s.l2, 1e-300)

    gain = quality(left_g, left_h) + quality(right_g, right_h) - quality(all_g, all_h)
    gain[(left_h < s.min_weight) | (right_h < s.min_weight)] = 0
    flat = gain.reshape(len(g), -1)
    best = flat.argmax(axis=1)
    value = flat[np.arange(len(g)), best]
    return best // g.shape[2], best % g.shape[2], np.where(value > 1e-6, value, 0.0)


def central(points: np.ndarray, h: np.ndarray, b: int) -> int:
    """Of the bins that split a node's rows like ``b``, the last one up to the middle of the gap between their values.

    ``h``: the node's sums by bin. Rows of other folds, or yet to come, may have values within the gap.
    """
    beyond = np.flatnonzero(h[b + 1 :])
    upto = b + int(beyond[0]) if len(beyond) else len(points) - 1
    middle = (points[b] + points[min(upto + 1, len(points) - 1)]) / 2
    return int(np.clip(np.searchsorted(points, middle, "right") - 1, b, max(b, upto)))


@dataclass
class Boosted:
    """Trees per fit, and the rows with ``predictions``, an array of each fit's margin."""

    trees: list[Trees]
    rows: DataFrame


def boost(
    df: DataFrame, columns: Sequence[str], label: str, key: str, fits: Sequence[Fit], settings: Boosting, cut: Cut,
    fold: str | None = None, weight: str | None = None, keep: Sequence[str] = (),
) -> Boosted:
    """Fit all ``fits`` to the rows of ``df``, a table (read several times).

    ``label`` must not be missing; rows without it, or with a weight that is missing or 0 or less, take no part. A missing
    feature value goes left at every split. ``keep``: columns that the returned rows also have. No rows: an error.
    """
    spark = df.sparkSession
    ship_package(spark)
    s, fits, columns = settings, list(fits), list(columns)
    own = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]
    rows = df.select(
        F.xxhash64(F.col(key)).alias("_key"),
        (F.col(fold).cast("int") if fold else F.lit(-1)).alias("_fold"),
        F.col(label).cast("double").alias("_y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"),
        *own,
        *keep,
    ).where("_y IS NOT NULL AND _w > 0")
    points = cut_points(rows, [f"_x{i}" for i in range(len(columns))], s.bins)
    # the start: the mean label, as log odds for a logistic loss, of the rows each fit learns from
    learned = [F.lit(True) if fit.left_out is None else F.col("_fold") != fit.left_out for fit in fits]
    start = rows.agg(
        F.count("*").alias("n"),
        *[F.sum(F.when(c, F.col("_y") * F.col("_w")).cast("decimal(38,12)")).alias(f"y{k}") for k, c in enumerate(learned)],
        *[F.sum(F.when(c, F.col("_w")).cast("decimal(38,12)")).alias(f"w{k}") for k, c in enumerate(learned)],
    ).first()
    if not start["n"]:
        raise ValueError("boosting needs rows with a label")
    mean = np.array([float(start[f"y{k}"] or 0) / float(start[f"w{k}"] or 1) for k in range(len(fits))])
    base = np.log(np.clip(mean, 1e-9, 1 - 1e-9) / (1 - np.clip(mean, 1e-9, 1 - 1e-9))) if s.logistic else mean

    held = rows.select("_key", "_fold", "_y", "_w", *[f"_x{i}" for i in range(len(points))], F.struct(*keep, F.lit(0).alias("_")).alias("_keep"))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, ROWS):
            x = values_of(batch, [f"_x{i}" for i in range(len(points))])
            bins = np.stack([np.searchsorted(p, np.where(np.isnan(x[:, i]), -np.inf, x[:, i])) for i, p in enumerate(points)], axis=1)
            y, w, key, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_w", "_key", "_fold"))
            other = pa.BufferOutputStream()
            with pa.ipc.new_stream(other, pa.schema([batch.schema.field("_keep")])) as writer:
                writer.write_batch(batch.select(["_keep"]))
            block = Block(bins.astype(np.uint8), y, w, key, fold.astype(np.int32), np.repeat(base[:, None], len(y), axis=1), other.getvalue().to_pybytes())
            columns_ = [pa.array([bytes(v)], pa.binary()) for v in block.row()]
            yield pa.RecordBatch.from_arrays(columns_, [c.split()[0] for c in _BLOCK.split(", ")])

    many = -(-start["n"] // ROWS)
    tasks = max(1, min(TASKS, many, max(spark.sparkContext.defaultParallelism, many // BLOCKS)))
    spread = held.coalesce(1) if tasks == 1 else held.repartition(tasks)
    table = cut(spread.mapInArrow(blocks_of, _BLOCK), "boosting-blocks")
    marks = _combinations(table, kinds=True)
    if marks is not None:
        blocks = table.rdd.map(lambda row, celled=_celled(marks, True): celled(Block.read(row))).persist(StorageLevel.MEMORY_AND_DISK)
        rounds, margins = _grow_kinds(blocks, s, fits, base, points, marks)
        scored = blocks.map(lambda block: replace(block, f=margins[:, block.cell]).row())
        table = cut(spark.createDataFrame(scored, _BLOCK), "boosting-blocks")
        blocks.unpersist()
        return Boosted(_trees(columns, base, s, points, rounds), _listed(table, rows, keep))
    marks = _combinations(table)
    cells = None if marks is None else np.array([np.frombuffer(m, np.uint8) for m in marks])
    read = Block.read if marks is None else (lambda row, celled=_celled(marks, False): celled(Block.read(row)))
    blocks = table.rdd.map(read).persist(StorageLevel.MEMORY_AND_DISK)
    rounds: list[list[_Growing]] = []
    older: list[RDD] = []
    for number in range(s.rounds):
        allowed = [_features(fit, s, k, number) for k, fit in enumerate(fits)]
        rounds.append(_grow(blocks, s, fits, allowed, number, points, cells))
        before, blocks = blocks, blocks.map(_grown(_tree(rounds[-1], s), s.depth))
        if (number + 1) % WINDOW == 0 or number + 1 == s.rounds:
            table = cut(spark.createDataFrame(blocks.map(Block.row), _BLOCK), "boosting-blocks")
            blocks = table.rdd.map(read)
        blocks.persist(StorageLevel.MEMORY_AND_DISK)
        # the blocks before are read once more, when the next are made
        older = [before, *older]
        if len(older) > 2:
            older.pop().unpersist()
    for rdd in (*older, blocks):
        rdd.unpersist()
    return Boosted(_trees(columns, base, s, points, rounds), _listed(table, rows, keep))


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``size``, the last one smaller."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = size - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _listed(table: DataFrame, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The blocks as rows: fold, label, weight, the columns of ``keep`` and predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.to_pylist():
                block = Block.read(held)
                other = pa.ipc.open_stream(block.keep).read_all().combine_chunks().column("_keep").combine_chunks()
                kept = [other.field(i) for i in range(len(keep))]
                found = pa.array(list(np.ascontiguousarray(block.f.T)), pa.list_(pa.float64()))
                own = [pa.array(block.fold), pa.array(block.y), pa.array(block.w)]
                yield pa.RecordBatch.from_arrays([*own, *kept, found], ["fold", "label", "weight", *keep, "predictions"])

    out = rows.select(F.col("_fold").alias("fold"), F.col("_y").alias("label"), F.col("_w").alias("weight"), *keep).schema
    return table.mapInArrow(run, _with(out, ("predictions", "array<double>")))


def _trees(columns: list[str], base: np.ndarray, s: Boosting, points: list[np.ndarray], rounds: list[list[_Growing]]) -> list[Trees]:
    """Trees of each fit, bins as values."""
    wide = np.full((len(points), s.bins), np.inf)
    for i, p in enumerate(points):
        wide[i, : len(p)] = p
    found = []
    for k in range(len(base)):
        own = [trees[k] for trees in rounds]
        feature, bin_ = (np.array([getattr(t, n) for t in own], np.int64) for n in ("feature", "bin"))
        leaf, gain, cover = np.array([t.leaf(s) for t in own]), np.array([t.gain for t in own]), np.array([t.cover for t in own])
        found.append(Trees(columns, float(base[k]), s.logistic, feature, wide[feature, bin_], leaf, gain, cover))
    return found


def _features(fit: Fit, s: Boosting, k: int, tree: int) -> np.ndarray:
    """The features a tree may use."""
    many = max(1, int(s.feature_share * len(fit.features)))
    return np.sort(np.random.default_rng([s.seed, k, tree]).permutation(fit.features)[:many])


@dataclass
class _Growing:
    """A tree of one fit while it grows; nodes as in :class:`Trees`, ``slope`` the sums of first derivatives."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    slope: np.ndarray
    alive: np.ndarray

    @staticmethod
    def of(s: Boosting) -> _Growing:
        inner = (1 << s.depth) - 1
        return _Growing(
            np.zeros(inner, np.int64), np.full(inner, s.bins - 1), np.zeros(inner), np.zeros(2 * inner + 1), np.zeros(2 * inner + 1), np.ones(1, bool)
        )

    def leaf(self, s: Boosting) -> np.ndarray:
        h, g = self.cover[len(self.feature) :], self.slope[len(self.feature) :]
        return np.where(h > 0, -_shrunk(g, s.l1) / np.maximum(h + s.l2, 1e-300) * s.rate, 0.0)

    def split(self, level: int, sums: np.ndarray, s: Boosting, use: np.ndarray, points: list[np.ndarray]) -> _Growing:
        """Split the nodes of a level by their sums (first and second derivatives, by node, feature and bin)."""
        nodes = 1 << level
        at, (g, h), bins = np.arange(nodes) + nodes - 1, sums / UNIT, sums.shape[-1]
        f, b, v = best_splits(g[:, use], h[:, use], s)
        f, dead = use[f], ~self.alive | (v <= 0)
        for i in np.flatnonzero(~dead):
            b[i] = central(points[f[i]], h[i, f[i]], b[i])
        f[dead], b[dead], v[dead] = 0, s.bins - 1, 0
        self.feature[at], self.bin[at], self.gain[at] = f, b, v
        # the sums of the children; a node that is not split goes left as it is
        pick = np.where(dead, use[0], f)
        upto = np.arange(bins)[None] <= b[:, None]
        for sums_, into in ((h, self.cover), (g, self.slope)):
            own = sums_[np.arange(nodes), pick]
            into[at] = own.sum(axis=1)
            into[2 * at + 1], into[2 * at + 2] = (own * upto).sum(axis=1), (own * ~upto).sum(axis=1)
        self.alive = np.repeat(~dead, 2)
        return self

    def rest(self, level: int) -> _Growing:
        """No node of the level may be split: everything goes left from here on."""
        at = np.arange(1 << level) + (1 << level) - 1
        self.cover[2 * at + 1], self.slope[2 * at + 1] = self.cover[at], self.slope[at]
        self.alive = np.repeat(self.alive, 2)
        return self

    @staticmethod
    def from_cells(by_cell: np.ndarray, cells: np.ndarray, s: Boosting, use: np.ndarray, points: list[np.ndarray]) -> _Growing:
        """A whole tree from the sums of each combination of bins."""
        tree, bins = _Growing.of(s), _bins(points)
        for level in range(s.depth):
            if not tree.alive.any():
                tree.rest(level)
                continue
            nodes = 1 << level
            node = _walk(cells, tree.feature, tree.bin, level) - (nodes - 1)
            slot = (node[:, None] * len(points) + use) * bins + cells[:, use]
            sums = np.zeros((2, nodes * len(points) * bins), np.int64)
            for total, own in zip(sums, by_cell, strict=True):
                np.add.at(total, slot, own[:, None])
            tree.split(level, sums.reshape(2, nodes, len(points), bins), s, use, points)
        return tree


def _bins(points: list[np.ndarray]) -> int:
    """A row's bin is at most the number of points, so nothing lies beyond the last bin."""
    return max(map(len, points)) + 1


def _by_fit(sums: RDD, fits: int) -> RDD:
    """Added up by fit (the key), each in one task."""
    return sums.reduceByKey(np.add, fits) if sums.getNumPartitions() > 1 else sums


def _grow(
    blocks: RDD, s: Boosting, fits: list[Fit], allowed: list[np.ndarray], number: int, points: list[np.ndarray], cells: np.ndarray | None
) -> list[_Growing]:
    """One tree per fit; one pass per level, or with ``cells`` one in all."""
    if cells is not None:
        sums = blocks.mapPartitions(_cell_sums(s, fits, number, len(cells))).flatMap(lambda total: enumerate(total.swapaxes(0, 1)))
        found = _by_fit(sums, len(fits)).map(lambda own: (own[0], _Growing.from_cells(own[1], cells, s, allowed[own[0]], points))).collect()
        return [tree for _, tree in sorted(found, key=lambda own: own[0])]
    trees, bins = [_Growing.of(s) for _ in fits], _bins(points)
    for level in range(s.depth):
        if not any(tree.alive.any() for tree in trees):
            trees = [tree.rest(level) for tree in trees]
            continue

        def chosen(own: tuple[int, np.ndarray], trees=trees, level=level) -> tuple[int, _Growing]:
            k, sums = own
            return k, trees[k].split(level, sums.reshape(2, 1 << level, len(points), bins), s, allowed[k], points)

        sums = blocks.mapPartitions(_histograms(s, fits, allowed, number, level, _tree(trees, s), bins))
        found = _by_fit(sums.flatMap(lambda total: enumerate(total.swapaxes(0, 1))), len(fits)).map(chosen).collect()
        trees = [tree for _, tree in sorted(found, key=lambda own: own[0])]
    return trees


def _tree(trees: list[_Growing], s: Boosting) -> _Tree:
    return _Tree(np.array([t.feature for t in trees]), np.array([t.bin for t in trees]), np.array([t.leaf(s) for t in trees]))


def _from_counts(counts: np.ndarray, margin: np.ndarray, s: Boosting, k: int, fit: Fit, numbers: range, points: list[np.ndarray], kinds: tuple) -> tuple:
    """Some trees of a fit from the rows of each kind that they learn from, and the kinds' margins behind them."""
    bins, fold, y, w = kinds
    cells, cell = np.unique(bins, axis=0, return_inverse=True)
    cell, grown = cell.ravel(), []
    learned = np.ones(len(y), bool) if fit.left_out is None else fold != fit.left_out
    for count, number in zip(counts, numbers, strict=True):
        p = 1 / (1 + np.exp(-margin)) if s.logistic else margin
        each = np.rint((p - y) * w * UNIT), np.rint((p * (1 - p) if s.logistic else np.ones(len(y))) * w * UNIT)
        by_cell = np.zeros((2, len(cells)), np.int64)
        for total, own in zip(by_cell, each, strict=True):
            np.add.at(total, cell, own.astype(np.int64) * np.where(learned, count, 0))
        tree = _Growing.from_cells(by_cell, cells, s, _features(fit, s, k, number), points)
        margin = margin + tree.leaf(s)[_walk(bins, tree.feature, tree.bin, s.depth) - len(tree.feature)]
        grown.append(tree)
    return grown, margin


def _grow_kinds(blocks: RDD, s: Boosting, fits: list[Fit], base: np.ndarray, points: list[np.ndarray], marks: list[bytes]) -> tuple[list, np.ndarray]:
    """All trees of all fits, by round, and each fit's margin of each kind; one pass per window."""
    wide = np.array([np.frombuffer(m, np.uint8) for m in marks])
    bins, rest = wide[:, : len(points)], np.ascontiguousarray(wide[:, len(points) :])
    kinds = (bins, *(np.frombuffer(np.ascontiguousarray(rest[:, a:b]).tobytes(), t) for a, b, t in ((0, 4, np.int32), (4, 12, float), (12, 20, float))))
    margins, rounds = np.repeat(base[:, None], len(marks), axis=1), []
    window = max(1, min(WINDOW, COUNTS // (len(fits) * len(marks))))
    for start in range(0, s.rounds, window):
        numbers = range(start, min(s.rounds, start + window))
        counted = _by_fit(blocks.mapPartitions(_counts(s, len(fits), numbers, len(marks))), len(fits))

        def grown(own: tuple[int, np.ndarray], margins=margins, numbers=numbers) -> tuple:
            k, counts = own
            return k, *_from_counts(counts, margins[k], s, k, fits[k], numbers, points, kinds)

        found = sorted(counted.map(grown).collect(), key=lambda own: own[0])
        rounds += [list(trees) for trees in zip(*(trees for _, trees, _ in found), strict=True)]
        margins = np.array([margin for *_, margin in found])
    return rounds, margins
