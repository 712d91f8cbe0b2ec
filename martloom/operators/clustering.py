"""K-means with all starts and cluster counts in one pass per iteration, and silhouettes without a row per pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import ship_package

Cut = Callable[[DataFrame, str], DataFrame]

#: Points that starts are chosen from, points of a silhouette tile, and whole units of a coordinate.
SAMPLE, TILE, UNIT = 4096, 2048, float(1 << 30)


@dataclass(frozen=True)
class Start:
    """One run: how many clusters, and the seed of its first centres."""

    k: int
    seed: int


@dataclass(frozen=True)
class Clusters:
    """Centres as rows, and the sum of squared distances of all points to the nearest one."""

    centers: np.ndarray
    cost: float

    def nearest(self, features: Column) -> Column:
        """The number of the centre nearest to an array of doubles, the first of equally near ones."""
        x = [F.get(features, j) for j in range(self.centers.shape[1])]
        far = F.array(*[sum(((a - float(c)) * (a - float(c)) for a, c in zip(x, center, strict=True)), F.lit(0.0)) for center in self.centers])
        return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Of every point the squared distances to the centres; long vectors, one per centre and coordinate."""
    columns, far = np.ascontiguousarray(x.T), np.zeros((len(centers), len(x)))
    for own, center in zip(far, centers, strict=True):
        for column, c in zip(columns, center, strict=True):
            apart = column - c
            own += apart * apart
    return far.T


def _spread(sample: np.ndarray, start: Start) -> np.ndarray:
    """First centres: each next one is a sample point with a probability by its squared distance to the ones before."""
    rng = np.random.default_rng(start.seed)
    centers = [sample[rng.integers(len(sample))]]
    while len(centers) < start.k:
        far = _squares(sample, np.array(centers)).min(axis=1)
        total = far.sum()
        pick = rng.choice(len(sample), p=far / total) if total > 0 else rng.integers(len(sample))
        centers.append(sample[pick])
    return np.array(centers)


def _pass(points: DataFrame, column: str, runs: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """Of each run (its centres) the sums and counts of the points nearest to each centre, and the cost; one aggregate."""
    width = runs[0].shape[1] + 2  # coordinates, count, cost

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[list[int]] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(column))
            scaled = np.rint(x * UNIT).astype(np.int64)
            found = []
            for centers in runs:
                far = _squares(x, centers)
                label = far.argmin(axis=1)
                near = np.rint(far.min(axis=1) * UNIT).astype(np.int64)
                sums = np.zeros((len(centers), width), np.int64)
                for c in range(len(centers)):
                    own = label == c
                    sums[c, :-2], sums[c, -2], sums[c, -1] = scaled[own].sum(axis=0), own.sum(), near[own].sum()
                found += sums.ravel().tolist()
            # whole numbers of any size, so that neither order nor number of points matters
            total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            place = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([place, pa.array(total, pa.decimal128(38, 0))], ["place", "total"])

    rows = points.select(column).mapInArrow(run, "place int, total decimal(38,0)")
    held = {r["place"]: int(r["total"]) for r in rows.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    flat = np.array([held.get(i, 0) for i in range(sum(len(c) for c in runs) * width)], object)
    sums, counts, costs, at = [], [], [], 0
    for centers in runs:
        own = flat[at : at + len(centers) * width].reshape(len(centers), width)
        at += len(centers) * width
        sums.append((own[:, :-2] / UNIT).astype(float))
        counts.append(own[:, -2].astype(np.int64))
        costs.append(float(own[:, -1].sum() / UNIT))
    return sums, counts, costs


def kmeans(points: DataFrame, starts: Sequence[Start], column: str = "features", iterations: int = 300, tol: float = 1e-4) -> list[Clusters]:
    """All ``starts`` until their centres move by no more than ``tol``; each iteration is one pass for all that still move.

    ``points``: a table with an array of finite doubles. First centres are chosen from ``SAMPLE`` points, those with the
    smallest hashes. A centre without points stays where it is. No points: an error.
    """
    ship_package(points.sparkSession)
    hashed = F.xxhash64(column)
    sample = np.array([r[0] for r in points.select(column).orderBy(hashed, column).limit(SAMPLE).collect()], float)
    if not len(sample):
        raise ValueError("k-means needs points")
    centers = [_spread(sample, s) for s in starts]
    cost, moving = [0.0] * len(starts), list(range(len(starts)))
    for _ in range(iterations):
        sums, counts, costs = _pass(points, column, [centers[i] for i in moving])
        still = []
        for i, s, n, c in zip(moving, sums, counts, costs, strict=True):
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centers[i])
            moved = ((new - centers[i]) ** 2).sum(axis=1).max()
            cost[i] = c
            if moved > tol * tol:
                still.append(i)
            # a run that has settled keeps the centres its cost belongs to
            centers[i] = new if moved > tol * tol else centers[i]
        moving = still
        if not moving:
            break
    return [Clusters(c, v) for c, v in zip(centers, cost, strict=True)]


def silhouettes(points: DataFrame, key: str, labels: Sequence[Column], cut: Cut, column: str = "features", tile: int = TILE) -> list[float]:
    """The mean silhouette, on Euclidean distances, of each labelling (0, 1, ...) of the points; 0 for a cluster of one.

    Points are dealt to tiles. A task holds one tile and takes the others one after another, keeping a sum of distances per
    point and cluster for all labellings at once; it answers with one number per labelling.
    """
    ship_package(points.sparkSession)
    width = len(labels)
    rows = cut(points.select(F.col(key).alias("key"), F.col(column).alias("x"), F.array(*labels).alias("labels")), "labelled")
    sizes = [{r["label"]: r["n"] for r in rows.groupBy(F.col("labels")[i].alias("label")).agg(F.count("*").alias("n")).collect()} for i in range(width)]
    counts = [np.array([s.get(c, 0) for c in range(max(s) + 1)], float) for s in sizes]
    n = int(counts[0].sum()) if counts and len(counts[0]) else 0
    tiles = max(1, -(-n // tile))
    dealt = rows.withColumn("tile", F.pmod(F.xxhash64("key"), F.lit(tiles)).cast("int"))
    held = cut(dealt.groupBy("tile").agg(F.flatten(F.collect_list("x")).alias("xs"), F.flatten(F.collect_list("labels")).alias("ls"), F.count("*").alias("n")), "tiles")
    own = held.select("tile", F.lit(-1).alias("other"), "xs", "ls", "n")
    met = held.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.col("tile").alias("other"), "xs", "ls", "n")
    both = own.unionByName(met).repartition(tiles, "tile").sortWithinPartitions("tile", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, x, own_labels, sums = [0] * width, None, None, []

        def close() -> None:
            for i, (s, c) in enumerate(zip(sums, counts, strict=True)):
                label = own_labels[:, i]
                rows_ = np.arange(len(label))
                inner = s[rows_, label] / np.maximum(c[label] - 1, 1)
                mean = s / np.maximum(c, 1)
                mean[:, c == 0] = np.inf
                mean[rows_, label] = np.inf
                outer = mean.min(axis=1)
                fine = (c[label] > 1) & np.isfinite(outer)
                top = np.maximum(inner, outer)
                score = np.where(fine & (top > 0), (outer - inner) / np.where(fine & (top > 0), top, 1), 0.0)
                total[i] += int(np.rint(score * UNIT).astype(np.int64).sum())

        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column("n")[i].as_py()
                xs = batch.column("xs")[i].values.to_numpy(zero_copy_only=False).reshape(size, -1)
                ls = batch.column("ls")[i].values.to_numpy(zero_copy_only=False).reshape(size, -1)
                if batch.column("other")[i].as_py() < 0:
                    if x is not None:
                        close()
                    x, own_labels, sums = xs, ls, [np.zeros((size, len(c))) for c in counts]
                    continue
                for low in range(0, len(x), 256):
                    far = np.sqrt(((x[low : low + 256, None] - xs[None]) ** 2).sum(axis=2))
                    for k, s in enumerate(sums):
                        s[low : low + 256] += far @ (ls[:, k][:, None] == np.arange(s.shape[1])[None])
        if x is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total, pa.decimal128(38, 0))], ["place", "total"])

    found = both.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total")).collect()
    by_place = {r["place"]: int(r["total"]) for r in found}
    return [by_place.get(i, 0) / UNIT / max(n, 1) for i in range(width)]
