"""Ranked lexical search over a document FP-tree.

For a block of items, a document is the vector of those of its terms that an item has, with their frequencies tf. Ordered
by document frequency, the vectors of a shard of documents form a prefix tree (an FP-tree, Han et al., 2000): documents that
begin alike share a path. A node knows the largest tf of every term, and the smallest length factor m, of the documents
below it; a score grows with tf and falls with m, so the two bound every score below. Each item searches the tree depth
first, best bound first, and leaves out what cannot reach its k-th best score so far. Documents of a leaf are scored as they are.

All scores are whole numbers, see :func:`search`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import cut, id_and_text, prepared

#: Item terms that are sent to the tasks at once; items beyond that wait for the next block.
BLOCK = 1 << 20
#: Documents and vector entries of a tree, documents below which a subtree is a leaf, distinct terms of a group of items.
DOCS, ENTRIES, LEAF, GROUP = 1 << 15, 1 << 22, 256, 1 << 13
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the terms of all texts, a-z for A-Z, and the number of them per text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    return arrays.word_hashes(_LOWER[data], start, end), np.diff(np.searchsorted(start, at))


def _counted(column: pa.Array, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text, and rows (text, term, tf); ``known``: only these terms, by their place."""
    hashes, n = terms_of(*arrays.texts(column))
    text = np.repeat(np.arange(len(n)), n)
    if known is None:
        known = np.unique(hashes)
    if not len(known):
        none = np.zeros(0, np.int64)
        return n, none, none, none
    term = np.searchsorted(known, hashes)
    ok = known[np.minimum(term, len(known) - 1)] == hashes
    both, tf = np.unique(text[ok] * len(known) + term[ok], return_counts=True)
    return n, both // len(known), both % len(known), tf


# ---------------------------------------------------------------- the tree
class Tree:
    """Documents of a shard in the order of their vectors; a node is a range of them."""

    def __init__(self, first: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, terms: int, leaf: int = LEAF):
        """Vectors as entries first[i]:first[i + 1] of ``term`` (ascending within a document) and ``tf``; ``terms`` exist."""
        wide = term.astype(">u4")
        keys = [wide[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        size = np.diff(first)[self.order]
        self.first = np.r_[0, np.cumsum(size)]
        entry = np.arange(self.first[-1]) + np.repeat(first[self.order] - self.first[:-1], size)
        self.term, self.tf, self.m = term[entry], tf[entry].astype(np.int64), m[self.order]
        self.part = 1_000_000_000 * self.tf // (1000 * self.tf + 12 * np.repeat(self.m, size))
        # few enough nodes for their tf maxima, whatever the number of terms
        self._grow(max(leaf, len(keys) * terms >> 25))
        self._sum_up(terms)

    def _grow(self, leaf: int) -> None:
        """Nodes (low, high) and their children, parents before children."""
        self.low, self.high, self.children = [0], [len(self.order)], [[]]
        open_ = [(0, 0)]
        while open_:
            node, depth = open_.pop()
            low, high = self.low[node], self.high[node]
            if high - low <= leaf:
                continue
            ends, at = self.first[low + 1 : high + 1], self.first[low:high] + depth
            here = np.where(at < ends, self.term[np.minimum(at, len(self.term) - 1)], -1)
            runs = np.r_[0, np.flatnonzero(np.diff(here)) + 1, high - low]
            if len(runs) == 2:
                if here[0] >= 0:  # one path
                    open_.append((node, depth + 1))
                continue
            # neighbouring small branches are one leaf
            begin = 0
            for a, b in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
                if b - begin > leaf:
                    if a > begin:
                        self._child(node, low + begin, low + a)
                    if b - a > leaf:
                        open_.append((self._child(node, low + a, low + b), depth + 1 if here[a] >= 0 else 1 << 40))
                        a = b
                    begin = a
            if begin < high - low:
                self._child(node, low + begin, high)

    def _child(self, parent: int, low: int, high: int) -> int:
        self.low.append(low)
        self.high.append(high)
        self.children.append([])
        self.children[parent].append(len(self.low) - 1)
        return len(self.low) - 1

    def _sum_up(self, terms: int) -> None:
        """The largest tf of each term and the smallest m below each node."""
        nodes = len(self.low)
        self.most, self.least = np.zeros((nodes, terms), np.int32), np.zeros(nodes, np.int64)
        leaf_of = np.zeros(len(self.order), np.int64)
        for i in range(nodes):
            if not self.children[i]:
                leaf_of[self.low[i] : self.high[i]] = i
        owner = np.repeat(leaf_of, np.diff(self.first))
        np.maximum.at(self.most, (owner, self.term), np.minimum(self.tf, np.iinfo(np.int32).max).astype(np.int32))
        for i in range(nodes - 1, -1, -1):
            if self.children[i]:
                self.most[i] = self.most[self.children[i]].max(axis=0)
            self.least[i] = self.m[self.low[i] : self.high[i]].min()

    def bounds(self, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """No document below a node scores more, for each node."""
        tf = self.most[:, term].astype(np.int64)
        return (1_000_000_000 * tf // (1000 * tf + 12 * self.least[:, None])) @ weight

    def scores(self, node: int, dense: np.ndarray) -> np.ndarray:
        """The scores of a node's documents; ``dense``: the item's weight of every term."""
        low, high = self.low[node], self.high[node]
        a, b = self.first[low], self.first[high]
        return np.add.reduceat(dense[self.term[a:b]] * self.part[a:b], self.first[low:high] - a)


@dataclass
class Best:
    """The k best documents of an item so far."""

    k: int
    score: np.ndarray
    unknown: np.ndarray
    doc: np.ndarray

    @classmethod
    def none(cls, k: int) -> Best:
        return cls(k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """A document has to score at least this."""
        return max(int(self.score[-1]), 1) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, unknown: np.ndarray, doc: np.ndarray) -> None:
        score, unknown, doc = np.r_[self.score, score], np.r_[self.unknown, unknown], np.r_[self.doc, doc]
        order = np.lexsort((doc, unknown, -score))[: self.k]
        self.score, self.unknown, self.doc = score[order], unknown[order], doc[order]


def descend(tree: Tree, doc: np.ndarray, unknown: np.ndarray, term: np.ndarray, weight: np.ndarray, dense: np.ndarray, best: Best) -> int:
    """Depth first, best bound first, into ``best``; returns the number of documents scored."""
    bounds, stack, seen = tree.bounds(term, weight), [0], 0
    dense[term] = weight
    while stack:
        node = stack.pop()
        if bounds[node] < best.least:
            continue
        below = tree.children[node]
        if below:
            stack += sorted(below, key=bounds.__getitem__)
            continue
        score = tree.scores(node, dense)
        seen += len(score)
        good = np.flatnonzero(score >= best.least)
        if len(good):
            of = tree.order[tree.low[node] + good]
            best.add(score[good], unknown[of], doc[of])
    dense[term] = 0
    return seen


# ---------------------------------------------------------------- Spark
@dataclass(frozen=True)
class Items:
    """Items in groups of bounded vocabulary: terms by rank, per group (ranks, [(item, places in ranks, weights)])."""

    rank: np.ndarray
    groups: list[tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]]

    @classmethod
    def of(cls, rank: np.ndarray, items: list[tuple[int, np.ndarray, np.ndarray]], most: int = GROUP) -> Items:
        groups: list[tuple[np.ndarray, list]] = []
        held: set[int] = set()
        for item, term, weight in items:
            own = set(rank[term].tolist())
            if not groups or len(held | own) > most:
                held = set()
                groups.append((np.zeros(0, np.int64), []))
            held |= own
            groups[-1] = (np.array(sorted(held), np.int64), [*groups[-1][1], (item, rank[term], weight)])
        placed = [(ranks, [(i, np.searchsorted(ranks, r), w) for i, r, w in own]) for ranks, own in groups]
        return cls(rank, placed)


def _search(items: Items, documents: int, all_terms: int, k: int, leaf: int, shard_docs: int):
    def shard(held: list[pa.RecordBatch], best: dict[int, Best]) -> None:
        table = pa.Table.from_batches(held).combine_chunks()
        doc = table.column("doc_id").combine_chunks()
        unknown, doc = np.asarray(doc.is_null()), doc.fill_null(0).to_numpy()
        m = 75 + 25 * table.column("n").to_numpy() * documents // all_terms
        lists = table.column("terms").combine_chunks()
        at, tf = lists.offsets.to_numpy(), table.column("tfs").combine_chunks().values.to_numpy()
        rank = items.rank[lists.values.to_numpy()]
        owner = np.repeat(np.arange(len(m)), np.diff(at))
        order = np.lexsort((rank, owner))  # a vector in the order of the tree
        rank, tf = rank[order], tf[order]
        for ranks, own in items.groups:
            place = np.minimum(np.searchsorted(ranks, rank), len(ranks) - 1)
            entry = np.flatnonzero(ranks[place] == rank)
            count = np.bincount(owner[entry], minlength=len(m))
            some = np.flatnonzero(count)
            if not len(some):
                continue
            tree = Tree(np.r_[0, np.cumsum(count[some])], place[entry], tf[entry], m[some], len(ranks), leaf)
            dense = np.zeros(len(ranks), np.int64)
            for item, term, weight in own:
                descend(tree, doc[some], unknown[some], term, weight, dense, best.setdefault(item, Best.none(k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        held, docs, entries = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                docs, entries = docs + batch.num_rows, entries + len(batch.column("terms").values)
            if docs >= shard_docs or entries >= ENTRIES:
                shard(held, best)
                held, docs, entries = [], 0, 0
        if held:
            shard(held, best)
        for item, found in best.items():
            n = len(found.score)
            doc = pa.array(found.doc, mask=found.unknown)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, item)), doc, pa.array(found.score)], ["item", "doc_id", "score"])

    return run


def _vectors(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches):
            n, text, term, tf = _counted(batch.column("text"), known)
            offsets = pa.array(np.searchsorted(text, np.arange(len(n) + 1)).astype(np.int32))
            terms = pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32)))
            tfs = pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64)))
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int64)), terms, tfs], ["doc_id", "n", "terms", "tfs"])
            yield whole.filter(pa.array(n > 0))

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.pieces(batches):
        hashes, _ = terms_of(*arrays.texts(batch.column("text")))
        known = np.unique(hashes)
        _, text, term, tf = _counted(batch.column("text"), known)
        columns = [batch.column("item").take(pa.array(text)), pa.array(known[term].view(np.int64)), pa.array(tf.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "term", "tf"])


def search(
    docs: DataFrame, benchmark: DataFrame, k: int = 20, block: int = BLOCK, group: int = GROUP, leaf: int = LEAF, shard: int = DOCS
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` best documents with a score above 0, ties by doc_id.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, a-z for A-Z. N documents have a term, L terms in
    all, a document n, df documents a given term, tf times. A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), a
    document's length factor is m = 75 + 25 * n * N div L, and its score the sum over the item's terms, repeats
    included, of w * (1000000000 * tf div (1000 * tf + 12 * m)), in 64 bits. Texts that are NULL or without terms find and are
    found by nothing. Rows that repeat a doc_id are documents each; a NULL doc_id comes last among equals. Different texts
    of one item_id (NULL is one, too) are one item that has the terms of all; a repeated row counts once.

    One scan of the documents per ``block`` of item terms.
    """
    spark = prepared(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    # a number for each item_id, which may be NULL
    items = items.withColumn("item", F.xxhash64(F.struct("item_id")))
    names = cut(items.groupBy("item_id").agg(F.first("item").alias("item")), "items")
    rows = items.select("item", "text").mapInArrow(_item_terms, "item long, term long, tf long")
    rows = cut(rows.groupBy("item", "term").agg(F.sum("tf").alias("tf")), "item-terms")
    blocks = -(-rows.count() // block)
    found = None
    for number in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        mine = own.toPandas()  # about ``block`` rows, whatever the benchmark
        if not len(mine):
            continue
        known = np.unique(mine["term"].to_numpy().view(np.uint64))
        sent = spark.sparkContext.broadcast(known)

        def vectors(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            yield from _vectors(sent.value)(batches)

        read = cut(id_and_text(docs).mapInArrow(vectors, "doc_id long, n long, terms array<int>, tfs array<long>"), "vectors")
        documents, all_terms = read.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        df = np.zeros(len(known), np.int64)
        counts = read.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas()
        df[counts["term"].to_numpy()] = counts["df"].to_numpy()
        # rare terms first: their branches are short, and bounds low wherever an item's rare terms are missing
        rank = np.empty(len(known), np.int64)
        rank[np.lexsort((known, df))] = np.arange(len(known))
        weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
        mine["place"] = np.searchsorted(known, mine["term"].to_numpy().view(np.uint64))
        mine["weight"] = weight[mine["place"]] * mine["tf"]
        held = [(int(i), g["place"].to_numpy(), g["weight"].to_numpy()) for i, g in mine[mine["weight"] > 0].groupby("item", sort=True)]
        plan = spark.sparkContext.broadcast(Items.of(rank, held, group))

        def run(batches: Iterator[pa.RecordBatch], plan=plan, n=documents, total=all_terms) -> Iterator[pa.RecordBatch]:
            yield from _search(plan.value, n, total, k, leaf, shard)(batches)

        part = read.where("size(terms) > 0").mapInArrow(run, "item long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
