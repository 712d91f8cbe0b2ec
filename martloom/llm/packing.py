"""Best-fit packing of tokenized documents into sequences, after a dominance reduction.

A document becomes its token ids and an end token; one that is longer than a sequence is cut into full pieces and a
rest. Piece lengths are whole numbers up to the sequence length, so any corpus is packed from the histogram of its
lengths: at most ``length`` rows, whatever the corpus. The plan works on that histogram (`Martello and Toth's
dominance criterion <https://en.wikipedia.org/wiki/Bin_packing_problem>`_ first, best-fit decreasing for the rest) and
says which slots a length has; pieces take the slots by their rank among pieces of the same length, found by Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.arrays import pieces
from martloom.llm.common import cut, id_and_text
from martloom.llm.tokens import worker_cache

Pattern = tuple[tuple[int, int], ...]  # (length, copies) by falling length


# ---------------------------------------------------------------- the plan, on a histogram
def _dominating_set(sizes: list[int], have: dict[int, int], first: int, room: int) -> tuple[int, ...] | None:
    """Companions of the piece ``first`` that dominate every other choice, or None if none is proven.

    A set dominates another if the other can be split into groups, each of which fits into a different member of the
    set (Martello and Toth, 1990). ``sizes``: the lengths that are left, ascending; ``have``: their counts without
    ``first`` itself.
    """
    free = room - first
    k = _largest(sizes, have, free)
    if k is None:
        return ()
    if k == free:  # no other set can hold more than this one piece does
        return (k,)
    low = _smallest(sizes, have, 3)
    if len(low) < 2 or low[0] + low[1] > free:  # at most one more piece fits: the largest
        return (k,)
    if len(low) < 3 or sum(low) > free:  # at most two more pieces fit
        pairs, best, left = [], 0, dict(have)
        for a in reversed(sizes[: bisect_right(sizes, free)]):
            if have.get(a, 0) < 1:
                continue
            left[a] -= 1
            b = _largest(sizes, left, free - a)
            left[a] += 1
            if b is not None:
                best = max(best, a + b)
                pairs.append((max(a, b), min(a, b)))
        if best <= k:
            return (k,)
        with_k = max((b for a, b in pairs if a == k), default=0)
        if with_k and all(b <= with_k or a + b <= k for a, b in pairs):
            return (k, with_k)
    return None


def _largest(sizes: list[int], have: dict[int, int], most: int) -> int | None:
    for i in range(bisect_right(sizes, most) - 1, -1, -1):
        if have.get(sizes[i], 0) > 0:
            return sizes[i]
    return None


def _smallest(sizes: list[int], have: dict[int, int], n: int) -> list[int]:
    found: list[int] = []
    for s in sizes:
        found += [s] * min(have.get(s, 0), n - len(found))
        if len(found) == n:
            break
    return found


def reduce_by_dominance(histogram: dict[int, int], room: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Sets that can be fixed without loss, with their number, and the histogram that is left."""
    left = {s: n for s, n in histogram.items() if n > 0}
    sizes, fixed = sorted(left), []
    changed = True
    while changed:
        changed = False
        for s in reversed(list(sizes)):
            while left.get(s, 0) > 0:
                left[s] -= 1
                mates = _dominating_set(sizes, left, s, room)
                left[s] += 1
                if mates is None:
                    break
                members = Counter((s, *mates))
                # all copies at once: with fewer pieces left, whatever was shown not to fit, or not to be better, still is
                # not, and the set's own members are there until one of them runs out
                times = min(left[x] // c for x, c in members.items())
                for x, c in members.items():
                    left[x] -= c * times
                fixed.append((tuple(sorted(members.items(), reverse=True)), times))
                changed = True
            sizes = [x for x in sizes if left.get(x, 0) > 0]
    return fixed, {s: n for s, n in left.items() if n > 0}


def best_fit(histogram: dict[int, int], room: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing for all copies of a length at once: equal sequences are kept as one pattern and a number."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}  # by room left
    rooms: list[int] = []

    def put(left: int, pattern: Pattern, times: int) -> None:
        if times:
            if left not in open_:
                rooms.insert(bisect_left(rooms, left), left)
                open_[left] = []
            open_[left].append((pattern, times))

    for s in sorted(histogram, reverse=True):
        n, grown = histogram[s], []
        i = bisect_left(rooms, s)
        while n and i < len(rooms):
            left = rooms[i]
            most, groups, rest = left // s, open_.pop(left), []
            rooms.pop(i)
            for pattern, times in groups:
                full = min(times, n // most)
                n -= full * most
                if full:
                    grown.append((left - most * s, (*pattern, (s, most)), full))
                times -= full
                if times and n:  # fewer copies are left than one more sequence takes
                    grown.append((left - n * s, (*pattern, (s, n)), 1))
                    n, times = 0, times - 1
                if times:
                    rest.append((pattern, times))
            for pattern, times in rest:
                grown.append((left, pattern, times))
        if n:
            most = room // s
            if n // most:
                grown.append((room - most * s, ((s, most),), n // most))
            if n % most:
                grown.append((room - n % most * s, ((s, n % most),), 1))
        for left, pattern, times in grown:
            put(left, pattern, times)
    return [x for groups in open_.values() for x in groups]


def plan(histogram: dict[int, int], room: int) -> list[tuple[Pattern, int]]:
    fixed, left = reduce_by_dominance(histogram, room)
    return fixed + best_fit(left, room)


def slots(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, ranks, first sequence, offset): the places that pieces of a length take in turn."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        at = 0
        for s, copies in pattern:
            for _ in range(copies):
                rows.append((s, used[s], times, sequence, at))
                used[s] += times
                at += s
        sequence += times
    return rows


# ---------------------------------------------------------------- Spark
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized(docs: DataFrame, tokenizer: str, room: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of the tokenized documents: doc_id, piece, start, length, ids_crc32 (of unsigned 32-bit ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in pieces(batches):
            out: list[list] = [[] for _ in range(5)]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), cache.encode(batch.column("text").to_pylist()), strict=True):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * room)):
                    part = ids[at : at + 4 * room]
                    for column, value in zip(out, (doc, number, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return id_and_text(docs).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, room: int = 4096, end_id: int = 1, buckets: int | None = None) -> DataFrame:
    """All documents in sequences of at most ``room`` tokens: the pieces, their sequence_id and offset.

    A NULL or empty text is one piece that holds only the end token. Documents that repeat a doc_id are packed each. No
    documents, no rows. ``buckets``: parts in which the pieces of one length are numbered, by default as many as
    shuffle partitions; each holds that share of the pieces of a length.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = cut(tokenized(docs, tokenizer, room, end_id), "pieces")
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    found = found.withColumn("part", part)
    counts = found.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # written first, so that what joins it is dealt by both keys: one length may hold a third of all pieces
    first = cut(counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "first-ranks")
    # at most ``room`` rows: the lengths are whole numbers from 1 to room
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # its rows are bounded by the patterns: each uses up a length, or the last copies of one, so a few for each length
    places = spark.createDataFrame(
        slots(plan(histogram, room)) or [(0, 0, 0, 0, 0)], "length long, rank long, ranks long, sequence long, offset long"
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = found.withColumn("nth", F.row_number().over(within)).join(first, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("nth") - 1).drop("first", "nth", "part")
    p, r = places.withColumnRenamed("rank", "from"), ranked
    joined = r.join(p, "length").where("rank >= from AND rank < from + ranks")
    return joined.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("from")).alias("sequence_id"), "offset"
    )
