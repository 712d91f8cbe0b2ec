"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed per document, distinct ones dealt to tiles by their number of set bits, and tiles compared
with exclusive-or and bit counts in numpy. Fingerprints that differ in at most ``radius`` bits differ by at most that in
their number of set bits, so tile pairs further apart are skipped. A tile pair answers with a spanning forest of its
links, never with all of them, and components are closed over the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import cut, id_and_text, text_digest

#: Fingerprints of one tile; 16 bytes each per lane and id.
TILE = 16384
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after another with one space between; where each starts and ends there."""
    size = end - start + 1
    after = np.cumsum(size)
    begin = after - size
    place = np.repeat(start - begin, size) + np.arange(int(after[-1]) if len(after) else 0)
    joined = data[np.minimum(place, len(data) - 1)] if len(place) else data[:0]
    joined[after - 1] = 0x20
    return joined, begin, after - 1


def _shingles(begin: np.ndarray, end: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every shingle of ``n`` words (fewer words: all of them), and the number of them per text."""
    words = np.diff(first)
    count = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    text = np.repeat(np.arange(len(words)), count)
    word = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[text]
    last = np.minimum(word + n, first[text + 1]) - 1
    return begin[word], end[last], count


def lanes_of(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64 bits per text, each set if it is set in over half of the text's hashes."""
    out = np.zeros(len(count), np.uint64)
    have = np.flatnonzero(count)
    if len(have):
        at = (np.cumsum(count) - count)[have]
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        out[have] = np.packbits(2 * ones > count[have, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _shingled(column: pa.Array, words: int) -> tuple[list[bytes], np.ndarray]:
    """The shingles of all texts one after another, a-z for A-Z, and the number of them per text."""
    data, at = arrays.texts(column)
    data = _LOWER[data]
    start, end, first = arrays.words(data, at)
    joined, begin, stop = _spaced(data, start, end)
    a, b, count = _shingles(begin, stop, first, words)
    raw = joined.tobytes()
    return [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], count


def fingerprints(docs: DataFrame, words: int = 3, lanes: int = 1, seed: int = 42, digest: bool = False) -> DataFrame:
    """doc_id and f0, f1, ...: ``lanes`` times 64 bits, lane i from XXH64 with seed + i of the shingles, a-z for A-Z.

    ``digest``: also the text's digest, see :func:`~martloom.llm.common.text_digest`.
    """
    names = [f"f{i}" for i in range(lanes)]
    own = ["doc_id", "digest"] if digest else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh64_intdigest
        for batch in arrays.pieces(batches):
            shingles, count = _shingled(batch.column("text"), words)
            out = []
            for lane in range(lanes):
                hashes = np.array([hashed(s, seed + lane) for s in shingles], np.uint64)
                out.append(pa.array(lanes_of(hashes, count).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *out], [*own, *names])

    read = id_and_text(docs)
    if digest:
        read = read.withColumn("digest", text_digest())
    kinds = ["doc_id long", *(["digest string"] if digest else []), *(f"{n} long" for n in names)]
    return read.mapInArrow(run, ", ".join(kinds))


class Forest:
    """Sets of linked places that grow together."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of a[i] and b[i]; the smallest place is a set's root."""
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            ra, rb = np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart]
            np.minimum.at(self.root, ra, rb)
            while True:  # shorten the paths
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up
            a, b = ra, rb


def _linked(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Roots of all places (left ones, then right ones); left and right: (lanes, n) arrays."""
    n, other = left.shape[1], left if right is None else right
    forest = Forest(n + (0 if right is None else right.shape[1]))
    shift, rows = (0, 32) if right is None else (n, 32)
    for low in range(0, n, rows):
        begin = low if right is None else 0
        differ = np.bitwise_count(left[0, low : low + rows, None] ^ other[0, None, begin:])
        if len(left) > 1:
            differ = differ.astype(np.uint16)
            for a, b in zip(left[1:], other[1:], strict=True):
                differ += np.bitwise_count(a[low : low + rows, None] ^ b[None, begin:])
        x, y = np.nonzero(differ <= radius)
        forest.link(x + low, y + begin + shift)
    return forest.root


def _tile_of(column: pa.Array, i: int, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and fingerprints of a tile."""
    held = column[i].values
    return held.field(0).to_numpy(), np.stack([held.field(k + 1).to_numpy().view(np.uint64) for k in range(lanes)])


def _compare(lanes: int, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                nodes, left = _tile_of(batch.column("tile"), i, lanes)
                right = None
                if not batch.column("itself")[i].as_py():
                    more, right = _tile_of(batch.column("other"), i, lanes)
                    nodes = np.r_[nodes, more]
                root = _linked(left, right, radius)
                own = np.flatnonzero(root != np.arange(len(root)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["a", "b"])

    return run


def links(nodes: DataFrame, lanes: int, radius: int, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between nodes (node, f0, ...) that connect exactly what lies within ``radius`` bits."""
    pairs = _tile_pairs(nodes, lanes, radius, tile)
    return pairs.mapInArrow(_compare(lanes, radius), "a long, b long").distinct()


def _tile_pairs(nodes: DataFrame, lanes: int, radius: int, tile: int) -> DataFrame:
    """Pairs of tiles that may hold links, each of members (node, f0, ...)."""
    ones = sum((F.bit_count(f"f{i}") for i in range(lanes)), F.lit(0))
    nodes = nodes.withColumn("ones", ones)
    # at most 64 rows per lane and one: the numbers of set bits there can be
    sizes = nodes.groupBy("ones").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    dealt = nodes.join(F.broadcast(sizes), "ones").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    member = F.struct("node", *(f"f{i}" for i in range(lanes)))
    tiles = cut(dealt.groupBy("ones", "part").agg(F.collect_list(member).alias("tile")), "tiles")
    near = tiles.select("ones", "part", F.explode(F.sequence("ones", F.col("ones") + radius)).alias("ones2"))
    near = near.join(F.broadcast(sizes.withColumnsRenamed({"ones": "ones2"})), "ones2")
    near = near.select("ones", "part", "ones2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part2"))
    near = near.where("ones < ones2 OR part <= part2")
    other = tiles.withColumnsRenamed({"ones": "ones2", "part": "part2", "tile": "other"})
    itself = (F.col("ones") == F.col("ones2")) & (F.col("part") == F.col("part2"))
    pairs = near.join(tiles, ["ones", "part"]).join(other, ["ones2", "part2"]).select(
        "tile", F.when(~itself, F.col("other")).alias("other"), itself.alias("itself")
    )
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return pairs.repartition(parts)


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): the smallest node of each node's component, by large-star and small-star rounds."""
    spark = edges.sparkSession
    edges = cut(edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v").unionByName(least.selectExpr("u", "m AS v"))
        edges = cut(small.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.selectExpr("u AS node", "v AS root")
        state = now


def near_duplicates(docs: DataFrame, words: int = 3, lanes: int = 1, radius: int = 2, tile: int = TILE) -> DataFrame:
    """doc_id, f0, ... and component_id, the smallest doc_id that links of at most ``radius`` differing bits reach.

    A NULL text is an empty one; texts without words have fingerprint 0 and link like any other. Rows that repeat a doc_id
    keep each their fingerprint and do not link by it. A NULL doc_id stays NULL, counts as the largest, and is the
    component_id only of components without any other. No rows, no rows.
    """
    names = [f"f{i}" for i in range(lanes)]
    marked = cut(fingerprints(docs, words, lanes), "fingerprints")
    rooted = _rooted(marked, lanes, radius, tile)
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    out = marked.join(rooted.join(first, "root").select(*names, "component_id"), names)
    return out.select("doc_id", *names, "component_id")


def _rooted(marked: DataFrame, lanes: int, radius: int, tile: int) -> DataFrame:
    """The distinct fingerprints f0, ... of rows (doc_id, f0, ...), the smallest doc_id of each and the root of its component."""
    names = [f"f{i}" for i in range(lanes)]
    nodes = marked.groupBy(*names).agg(F.min("doc_id").alias("least"))
    # a key of its own: several fingerprints may share their smallest doc_id, or have none
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct-fingerprints")
    roots = components(links(nodes.drop("least"), lanes, radius, tile))
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")


_DIGEST = "text digest"


def keep_first(docs: DataFrame, words: int = 3, lanes: int = 1, radius: int = 2, tile: int = TILE) -> DataFrame:
    """The rows, with all their columns, of one document per component of :func:`near_duplicates`: the smallest doc_id's.

    Of rows that repeat a doc_id one stays and takes part. A row without a doc_id is a document of its own, after all
    others; its exact copies are one. Texts without words have one fingerprint, so one of them stays.
    """
    names = [f"f{i}" for i in range(lanes)]
    marked = fingerprints(docs, words, lanes, digest=True)
    rows = marked.groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("digest")).alias("own"))
    rows = cut(rows.agg(F.min(F.struct("digest", *names)).alias("row")).select("doc_id", "row.*"), "fingerprints")
    rooted = _rooted(rows, lanes, radius, tile)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest")
    firsts = rows.join(rooted, names).groupBy("root").agg(F.min(order).alias("first"))
    firsts = cut(firsts.select(F.col("first.doc_id").alias("first_doc"), "first.digest"), "firsts")
    keyed = docs.withColumn(_DIGEST, text_digest())
    same = keyed["doc_id"].cast("long").eqNullSafe(firsts["first_doc"]) & (keyed[_DIGEST] == firsts["digest"])
    return keyed.join(firsts, same, "left_semi").dropDuplicates(["doc_id", _DIGEST]).drop(_DIGEST)
