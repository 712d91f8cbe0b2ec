"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code is cut into segments. A shard of the table holds, per segment, its codes sorted by the segment's value. A query
looks up, round by round, all values within radius 0, 1, 2, ... of its own segments. After the round of radius r every
code not yet seen differs by at least r + 1 bits in each segment, so by at least segments * (r + 1) in all: when the
k-th verified distance is below that, the answer is complete (Norouzi et al., 2012).

Codes are deduplicated first. As ties are broken by id, the k + 1 smallest ids of a code are all that can be answers.
Every query first searches the shard its hash names. The k-th distance found there bounds its search in the other shards,
which ends with the radius that cannot come below. For either pass a code travels once to its shard (where shards are fewer
than cores, to as many copies of it as there are cores in all), a query as 24 bytes to each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import cut, prepared

#: Codes of a shard.
SHARD = 1 << 17
SEGMENTS, BITS = 4, 16


def sign_codes(vectors: DataFrame, vector: str = "embedding", dims: int = 64) -> DataFrame:
    """The rows with a 64-bit ``code``: bit i is set if component i is at least 0 (missing, NULL and NaN: not set)."""
    bit = F.aggregate(
        F.sequence(F.lit(0), F.lit(dims - 1)),
        F.lit(0).cast("long"),
        lambda code, i: F.when(
            (F.get(vector, i) >= 0) & ~F.isnan(F.get(vector, i)), code.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
        ).otherwise(code),
    )
    return vectors.withColumn("code", F.coalesce(bit, F.lit(0).cast("long")))


class Shard:
    """The codes of a shard by the values of their segments."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.order, self.first = codes, [], []
        for j in range(SEGMENTS):
            part = self.part(codes, j)
            order = np.argsort(part, kind="stable")
            self.order.append(order)
            self.first.append(np.searchsorted(part[order], np.arange((1 << BITS) + 1)))

    @staticmethod
    def part(codes: np.ndarray, j: int) -> np.ndarray:
        return (codes >> np.uint64(BITS * j)).astype(np.int64) & ((1 << BITS) - 1)

    def nearest(
        self, query: np.uint64, k: int, ties: np.ndarray, masks: list[np.ndarray], bound: int = 64
    ) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the k nearest codes within ``bound``, equal distances by ``ties``."""
        found, distance = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        parts = [int(self.part(np.array([query], np.uint64), j)[0]) for j in range(SEGMENTS)]
        held = 0
        for radius in range(BITS + 1):
            if SEGMENTS * radius > bound:  # all that is left is further away
                break
            for j in range(SEGMENTS):
                values = parts[j] ^ masks[radius]
                low, high = self.first[j][values], self.first[j][values + 1]
                some = high > low
                if not some.any():
                    continue
                low, size = low[some], (high - low)[some]
                at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                near = self.order[j][at]
                differ = self.codes[near] ^ query
                # a code is taken where its segment is the first of those with the smallest distance
                new = np.ones(len(near), bool)
                for i in range(SEGMENTS):
                    if i != j:
                        apart = np.bitwise_count(self.part(differ, i).astype(np.uint64))
                        new &= (apart > radius) if i < j else (apart >= radius)
                found.append(near[new])
                distance.append(np.bitwise_count(differ[new]).astype(np.int64))
                held += int(new.sum())
            if held >= min(k, len(self.codes)):
                d = np.concatenate(distance)
                if held == len(self.codes) or np.partition(d, k - 1)[k - 1] < SEGMENTS * (radius + 1):
                    break
        found, distance = np.concatenate(found), np.concatenate(distance)
        best = np.lexsort((ties[found], distance))[:k]
        best = best[distance[best] <= bound]
        return found[best], distance[best]


def _search(k: int):
    """Of rows (shard, bound, code, least_id), sorted by shard and bound: rows without a bound are a shard's codes, others ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [
            np.array([sum(1 << b for b in bits) for bits in combinations(range(BITS), r)], np.int64) for r in range(BITS + 1)
        ]
        number, held, shard, ids = None, [], None, None
        for batch in batches:
            at, bounds = batch.column("shard").to_numpy(), batch.column("bound").to_numpy()
            codes, least = batch.column("code").to_numpy(), batch.column("least_id").to_numpy()
            out = ([], [], [], [])
            cuts = np.flatnonzero((np.diff(at) != 0) | ((bounds[1:] < 0) != (bounds[:-1] < 0))) + 1
            for part in np.split(np.arange(len(at)), cuts):
                if not len(part):
                    continue
                if at[part[0]] != number:
                    number, held, shard = at[part[0]], [], None
                if bounds[part[0]] < 0:
                    held.append((codes[part], least[part]))
                    continue
                if not held:
                    continue
                if shard is None:
                    shard, ids = Shard(np.concatenate([c for c, _ in held]).view(np.uint64)), np.concatenate([i for _, i in held])
                for q, bound in zip(codes[part], bounds[part].tolist(), strict=True):
                    near, distance = shard.nearest(q.view(np.uint64), k, ids, masks, bound)
                    found = (np.full(len(near), q), shard.codes[near].view(np.int64), distance, ids[near])
                    for column, values in zip(out, found, strict=True):
                        column.append(values)
            columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out]
            yield pa.RecordBatch.from_arrays(columns, ["query_code", "code", "distance", "least_id"])

    return run


def _found(codes: DataFrame, asked: DataFrame, k: int, shards: int, copies: int) -> DataFrame:
    """Rows (query_code, code, distance, least_id): what ``asked`` (shard, code, bound) find in the shards of ``codes``.

    Each shard has ``copies``, and a query asks one of them.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    own = codes.select("shard", F.lit(-1).alias("bound"), "code", "least_id", every)
    one = F.pmod(F.xxhash64("code", F.lit(copies)), F.lit(copies)).cast("int").alias("copy")
    both = own.unionByName(asked.select("shard", "bound", "code", F.lit(0).cast("long").alias("least_id"), one))
    both = both.withColumn("shard", F.col("shard") * copies + F.col("copy"))
    dealt = both.repartition(shards * copies, "shard").sortWithinPartitions("shard", "bound")
    return dealt.mapInArrow(_search(k), "query_code long, code long, distance long, least_id long")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD) -> DataFrame:
    """query_id, rank (1 to k), id and distance: the k rows nearest to each query, itself left out, ties by id.

    ``rows`` and ``queries``: id, code (long). Rows with a NULL id or code are ignored; rows that repeat an id with one code
    are one. Fewer than k others: as many as there are. No rows or no queries, no rows.
    """
    spark = prepared(rows.sparkSession)
    rows = rows.select(F.col("id").cast("long"), F.col("code").cast("long")).dropna().distinct()
    queries = queries.select(F.col("id").cast("long").alias("query_id"), F.col("code").cast("long").alias("query_code")).dropna().distinct()
    rows, queries = cut(rows, "codes"), cut(queries, "query-codes")
    # the k + 1 smallest ids of each code; first in parts, so that a frequent code is no single task
    salted = Window.partitionBy("code", "salt").orderBy("id")
    first = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = first.withColumn("n", F.row_number().over(salted)).where(F.col("n") <= k + 1)
    whole = Window.partitionBy("code").orderBy("id")
    first = cut(first.withColumn("n", F.row_number().over(whole)).where(F.col("n") <= k + 1).select("code", "id"), "first-ids")
    distinct = first.groupBy("code").agg(F.min("id").alias("least_id"))
    n_codes, cores = distinct.count(), spark.sparkContext.defaultParallelism
    n_shards = max(-(-n_codes // shard), 1)
    # with fewer shards than cores each is copied, which the number of cores bounds and not that of the codes
    copies = -(-cores // n_shards)
    home = F.pmod(F.xxhash64("code"), F.lit(n_shards)).alias("shard")
    codes = cut(distinct.select("code", "least_id", home), "shards")
    asked = cut(queries.select(F.col("query_code").alias("code")).distinct().select("code", home), "asked")
    near = cut(_found(codes, asked.withColumn("bound", F.lit(64)), k + 1, n_shards, copies), "near-home")
    if n_shards > 1:
        # the (k + 1)-th distance, where the home shard has so many
        last = near.groupBy(F.col("query_code").alias("code")).agg(F.max("distance").cast("int").alias("last"), F.count("*").alias("n"))
        bounds = asked.join(last.where(F.col("n") > k).drop("n"), "code", "left").withColumn("bound", F.coalesce("last", F.lit(64)))
        every = F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))
        others = bounds.select("code", "bound", F.explode(F.array_remove(every, F.col("shard"))).alias("shard"))
        near = near.unionByName(_found(codes, others, k + 1, n_shards, copies))
    best = Window.partitionBy("query_code").orderBy("distance", "least_id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n", "least_id")
    ids = near.join(first, "code").groupBy("query_code").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("distance", "id"))), 1, k + 1).alias("near")
    )
    found = queries.join(ids, "query_code").withColumn("near", F.filter("near", lambda x: x["id"] != F.col("query_id")))
    listed = found.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("rank", "hit"))
    return listed.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.id").alias("id"), F.col("hit.distance").alias("distance"))
