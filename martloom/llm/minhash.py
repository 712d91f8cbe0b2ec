"""MinHash near-duplicates with tensored banding, every link confirmed on whole shingle sets.

Banding needs many tables whose keys are several minhashes each. Here two collections of ``side`` short keys are computed
per set, and the key of table (i, j) is the pair of key i of the first and key j of the second collection: side * side
tables from 2 * side short keys, so a square root of the minhashes that independent tables would need (Christiani,
"Fast locality-sensitive hashing frameworks", 2019). A pair with similarity s meets in some table with probability
(1 - (1 - s ** hashes) ** side) ** 2.

Equal sets are one node, however many documents have them. Nodes that meet in a table are linked to the smallest one there
and the groups closed, which bounds where links can be; a group is then joined exactly, tile by tile of bounded bytes: two
sets that are similar enough share one of the rarest few shingles of either (prefix filter), and only pairs that share
one, and are not yet connected, are compared. Tiles answer with spanning forests of confirmed links, never with all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import cut, id_and_text
from martloom.llm.simhash import _LOWER, components

#: Short keys of each collection, and minhashes of a short key: 100 tables of 8 minhashes from 80 minhashes.
#: Of pairs with similarity 0.85, 0.9988 meet in a table, of pairs with 0.9 or more, 0.99995.
SIDE, HASHES = 10, 4
#: Shingle hashes of a tile.
TILE = 1 << 19


def shingle_hashes(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of ``n`` words of all texts, a-z for A-Z, and the number of them per text.

    A text of fewer words has one, of all its words; a text without words has none.
    """
    data = _LOWER[data]
    start, end, first = arrays.words(data, at)
    words = arrays.word_hashes(data, start, end)
    many = np.diff(first)
    count = np.where(many >= n, many - n + 1, np.minimum(many, 1))
    text = np.repeat(np.arange(len(many)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[text]
    held = np.zeros(len(text), np.uint64)
    for i in range(n):
        # a shorter text's shingle is told apart by the number of its words
        inside = place + i < first[text + 1]
        word = words[np.minimum(place + i, max(len(words) - 1, 0))] if len(words) else held
        held = np.where(inside, arrays.mixed((held + word) * np.uint64(0x9FB21C651E98DF25) + np.uint64(i + 1)), held)
    return held, count


def sorted_sets(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, ascending, one text after another, and the number of them per text."""
    text = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])] if len(hashes) else np.zeros(0, bool)
    return hashes[new], np.bincount(text[new], minlength=len(count))


def short_keys(hashes: np.ndarray, count: np.ndarray, side: int, per_key: int) -> np.ndarray:
    """(texts, 2 * side) keys of ``per_key`` minhashes each; texts must not be empty."""
    rng = np.random.default_rng(20190101)
    at = np.cumsum(count) - count
    out = np.zeros((len(count), 2 * side), np.uint64)
    for k in range(2 * side):
        for _ in range(per_key):
            factor, shift = rng.integers(1, 1 << 63, 2, dtype=np.uint64)
            h = hashes * (factor | np.uint64(1)) + shift
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[:, k] = arrays.mixed(out[:, k] * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h, at))
    return out


_MARKED = "doc_id long, text_key string, n_shingles long, h1 long, h2 long, keys array<long>"


def marked(docs: DataFrame, words: int, side: int, per_key: int) -> DataFrame:
    """doc_id, text_key (tells texts apart), n_shingles, digest of the set (h1, h2) and the short keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, limit=1 << 20):
            hashes, count = sorted_sets(*shingle_hashes(*arrays.texts(batch.column("text")), words))
            have = np.flatnonzero(count)
            keys = np.zeros((len(have), 2 * side), np.uint64)
            if len(have):
                keys = short_keys(hashes, count[have], side, per_key)
            raw, end = memoryview(np.ascontiguousarray(hashes)).cast("B"), np.cumsum(count) * 8
            spans = zip((end - count * 8).tolist(), end.tolist(), strict=True)
            digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in spans]), "<i8")
            size = np.zeros(len(count), np.int32)
            size[have] = 2 * side
            offsets = pa.array(np.r_[0, np.cumsum(size)].astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(count), pa.array(digest[::2]), pa.array(digest[1::2]), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "h1", "h2", "keys"])

    return id_and_text(docs).withColumn("text_key", F.md5("text")).mapInArrow(run, _MARKED)


def table_keys(side: int) -> F.Column:
    """The keys of all tables: each short key of the first collection with each of the second, and the table's number."""
    first = F.sequence(F.lit(0), F.lit(side - 1))
    pair = lambda i, j: F.xxhash64(i * side + j, F.get("keys", i), F.get("keys", j + side))
    return F.flatten(F.transform(first, lambda i: F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda j: pair(i, j))))


def candidates(nodes: DataFrame, side: int) -> DataFrame:
    """Edges (a, b): each node and the smallest one it meets in a table, of rows (node, keys)."""
    keyed = nodes.select("node", F.explode(table_keys(side)).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last").drop("last")
    return keyed.join(shared, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def joined(nodes: np.ndarray, sets: list[np.ndarray], part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of nodes whose sets have ``percent`` of their union in common.

    ``part``: 0 or 1; pairs within part 1 are left to the tile where that part is part 0.
    """
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    ids, at = np.unique(np.concatenate(sets), return_inverse=True)[1], np.r_[0, np.cumsum(size)]
    often = np.bincount(ids)
    # the rarest shingles of each set: one more than may be missing from a set that is similar enough
    order = np.lexsort((ids, often[ids], owner))
    nth = np.arange(len(ids)) - at[owner]
    prefix = order[nth < (size - (percent * size + 99) // 100 + 1)[owner]]
    prefix = prefix[often[ids[prefix]] > 1]
    by_id = prefix[np.argsort(ids[prefix], kind="stable")]
    begin = np.searchsorted(ids[by_id], np.arange(len(often) + 1))
    mine = np.searchsorted(owner[prefix], np.arange(len(sets) + 1))
    holders = owner[by_id]
    root, links, mark = np.arange(len(sets)), [], np.zeros(len(often), bool)
    for i in np.flatnonzero(np.diff(mine)):
        own = ids[prefix[mine[i] : mine[i + 1]]]
        met = np.unique(np.concatenate([holders[begin[t] : begin[t + 1]] for t in own]))
        fits = (100 * np.minimum(size[met], size[i]) >= percent * np.maximum(size[met], size[i])) & (part[met] + part[i] < 2)
        met = met[(met > i) & fits]
        met = met[root[met] != root[i]]
        if not len(met):
            continue
        mark[ids[at[i] : at[i + 1]]] = True
        for low in range(0, len(met), 256):
            some = met[low : low + 256]
            some = some[root[some] != root[i]]
            if not len(some):
                continue
            held = np.concatenate([ids[at[j] : at[j + 1]] for j in some])
            same = np.add.reduceat(mark[held].astype(np.int64), np.cumsum(size[some]) - size[some])
            for j in some[100 * same >= percent * (size[some] + size[i] - same)]:
                if root[j] != root[i]:
                    links.append((int(nodes[i]), int(nodes[j])))
                    low_root, high_root = sorted((root[i], root[j]))
                    root[root == high_root] = low_root
        mark[ids[at[i] : at[i + 1]]] = False
    return links


def confirmed(sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Edges (a, b) that connect what is similar within each group, of rows (root, node, size, shingles).

    A set is similar only to sets of its own or a neighbouring size class, so a group of more than ``tile`` shingles is
    dealt to tiles by class and, where a class is larger still, by hash; every pair of tiles of neighbouring classes meets.
    """
    step = float(np.log(100 / percent))
    sizes = sets.groupBy("root").agg(F.sum("size").alias("all"))
    classed = sets.join(cut(sizes, "group-sizes"), "root").withColumn(
        "class", F.when(F.col("all") > tile, F.floor(F.log(F.col("size").cast("double")) / step + 1e-9)).otherwise(0).cast("int")
    )
    per = classed.groupBy("root", "class").agg(F.ceil(F.sum("size") / tile).cast("int").alias("parts"))
    per = cut(per, "group-tiles")
    above = per.select("root", (F.col("class") - 1).alias("class"), F.col("parts").alias("more"))
    below = per.select("root", (F.col("class") + 1).alias("class"), F.col("parts").alias("fewer"))
    per = per.join(above, ["root", "class"], "left").join(below, ["root", "class"], "left")
    dealt = classed.join(cut(per.na.fill(0, ["more", "fewer"]), "group-neighbours"), ["root", "class"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # tile (class, p) with (class, q), q >= p, and with every tile of the next class
    upto = lambda low, high: F.when(F.expr(f"{low} < {high}"), F.expr(f"sequence({low}, {high} - 1)")).otherwise(F.array().cast("array<int>"))
    key = lambda c, p, d, q, side: F.struct(c.alias("c"), p.alias("p"), d.alias("d"), q.alias("q"), F.lit(side).alias("side"))
    c, p = F.col("class"), F.col("part")
    first = F.concat(
        F.transform(F.expr("sequence(part, parts - 1)"), lambda q: key(c, p, c, q, 0)),
        F.transform(upto("0", "more"), lambda q: key(c, p, c + 1, q, 0)),
    )
    second = F.concat(
        F.transform(upto("0", "part"), lambda q: key(c, q, c, p, 1)),
        F.transform(upto("0", "fewer"), lambda q: key(c - 1, q, c, p, 1)),
    )
    spread = dealt.select("root", "node", "shingles", F.explode(F.concat(first, second)).alias("meet")).select("root", "node", "shingles", "meet.*")

    def run(table: pa.Table) -> pa.Table:
        nodes, part = table.column("node").to_numpy(), table.column("side").to_numpy()
        alone = bool((table.column("p")[0] == table.column("q")[0]) and (table.column("c")[0] == table.column("d")[0]))
        held = table.column("shingles").combine_chunks()
        flat, at = held.values.to_numpy(), held.offsets.to_numpy()
        order = np.lexsort((nodes, part))
        sets_ = [flat[at[i] : at[i + 1]] for i in order]
        found = joined(nodes[order], sets_, part[order] * (0 if alone else 1), percent) if len(nodes) > 1 else []
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return spread.groupBy("root", "c", "p", "d", "q").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 3, percent: int = 85, side: int = SIDE, per_key: int = HASHES, tile: int = TILE
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    ``component_id`` is the smallest doc_id that links reach; a link is a pair of documents whose sets of shingles (64-bit
    hashes of ``words`` words) have ``percent`` of their union in common. ``kept``: it is the document's own. A text that is
    NULL or without words has an empty set and is linked with nothing. Rows that repeat a doc_id are documents of their own.
    A NULL doc_id counts as the largest: the component_id of its group is another's, or NULL, and then all its rows are
    kept. No rows, no rows.
    """
    rows = cut(marked(docs, words, side, per_key), "minhashes")
    nodes = rows.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "text_key")).alias("of"),  # a text that has the set
        F.first("n_shingles").alias("size"),
        F.first("keys").alias("keys"),
    )
    # written, so that the numbers stay the same
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct-sets")
    groups = components(cut(candidates(nodes, side), "candidates"))
    groups = cut(groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()), "groups")

    wanted = cut(nodes.select("node", F.col("of.doc_id").alias("of_doc"), F.col("of.text_key").alias("of_text"), "size").join(groups, "node"), "candidate-sets")
    texts = id_and_text(docs).withColumn("text_key", F.md5("text"))
    own = texts["doc_id"].eqNullSafe(wanted["of_doc"]) & (texts["text_key"] == wanted["of_text"])
    texts = texts.join(wanted, own).dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, limit=1 << 20):
            hashes, count = sorted_sets(*shingle_hashes(*arrays.texts(batch.column("text")), words))
            offsets = pa.array(np.r_[0, np.cumsum(count)].astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("root", "node", "size")), lists], ["root", "node", "size", "shingles"])

    sets = texts.select("root", "node", "size", "text").mapInArrow(run, "root long, node long, size long, shingles array<long>")
    links = components(confirmed(cut(sets, "shingle-sets"), percent, tile))
    rooted = nodes.join(links, "node", "left").select("h1", "h2", "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    found = rows.join(rooted.join(least, "root").select("h1", "h2", "component"), ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
