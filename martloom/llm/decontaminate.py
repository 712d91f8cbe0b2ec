"""Benchmark items in documents, also with other numbers, names and units: template windows and slot consistency.

Text is canonicalised to a sequence of tokens: a number is a placeholder, a unit after a number another, a capitalised word
inside a sentence a third; every other word stands for itself in lower case, signs are dropped. Windows of ``window``
tokens are joined by hash with those of the benchmark, and also as they stand, numbers, units and names included, without
regard to case: so windows of numbers match, and names in another case. What stood at the placeholders are a window's slots:
along one alignment of a document with an item, a value of the item must always meet the same value in the document, or the
windows that hold it and differ from the item's do not count. An item counts as contained if the others cover enough of its
windows. An item of fewer tokens than a window is one window, of all its tokens.

A document and an item meet in one row per common window, with the places on both sides, and in one row of those in all. As they
stand windows need no alignment, however often either side repeats them; alignments of changed ones are looked at by ranges
of shifts, so that a table of numbers within an item and a longer one within a document take time but no space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import cut, id_and_text, prepared, text_digest

#: A window of less than ``LEAST`` tokens, or ``LITERALS`` words that stand for themselves, counts only as it stands: with
#: other numbers it would be found anywhere.
WINDOW, COVER, LITERALS, LEAST = 8, 0.5, 2, 4
#: Pairs of equal windows of a document and an item that are aligned at once.
PAIRS = 1 << 18
#: Slots of a filter of benchmark windows that documents are read with; its size does not depend on any data.
FILTER = 1 << 22

# ---- fixed values: units that may follow a number
UNITS = (
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml cl l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur percent mph kmh kph degree degrees hz khz mhz ghz w kw v a j kj kb mb gb tb"
).split()
# ---- end of fixed values

_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0x1F3D5B79A2C4E6F1, 0x2E4C6A88B1D3F507, 0x3D5B7997C0E2F416))
_OTHER, _LETTER, _DIGIT = 0, 1, 2


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.zeros(256, np.uint8)
    kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
    kind[48:58] = _DIGIT
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    ends = np.zeros(256, bool)
    ends[list(b".!?:\n\r|\"")] = True
    return kind, lower, ends


_KIND, _LOWER, _ENDS = _tables()


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    start, end, _ = arrays.words(data, np.array([0, len(data)]))
    return np.sort(arrays.word_hashes(data, start, end))


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kind of each byte, and start and end of each run of letters or digits."""
    kind = _KIND[data]
    if len(data) > 2:  # a point or comma between digits belongs to the number
        inner = (data[1:-1] == 46) | (data[1:-1] == 44)
        kind[1:-1][inner & (kind[:-2] == _DIGIT) & (kind[2:] == _DIGIT)] = _DIGIT
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    change = np.flatnonzero(edge[:-1] | np.r_[True, kind[1:] != kind[:-1]]) if len(data) else np.zeros(0, np.int64)
    stop = np.r_[change[1:], len(data)]
    word = kind[change] != _OTHER if len(change) else np.zeros(0, bool)
    return kind, change[word], stop[word]


def _folded(data: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words without regard to case, of any script."""
    if (data < 128).all():
        return arrays.word_hashes(_LOWER[data], start, end)
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace").casefold().encode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    folded, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    _, begin, stop = _runs(folded, bounds)
    # folding turns letters into letters, so the words stay the same ones
    return arrays.word_hashes(folded, begin, stop)


class Tokens:
    """Canonical tokens of texts: ``hashes``, ``slots`` (hash of what a placeholder stands for, else 0), first per text."""

    units: np.ndarray | None = None

    def __init__(self, data: np.ndarray, at: np.ndarray):
        if Tokens.units is None:
            Tokens.units = _unit_hashes()
        kind, start, end = _runs(data, at)
        self.first = np.searchsorted(start, at)
        if not len(start):
            self.hashes = self.slots = self.own = np.zeros(0, np.uint64)
            return
        own = _folded(data, at, start, end)
        number = kind[start] == _DIGIT
        text = arrays.owner(at, start)
        same = np.r_[False, text[1:] == text[:-1]]
        after_number = np.r_[False, number[:-1]] & same & (start - np.r_[0, end[:-1]] <= 1)
        unit = ~number & after_number & (self.units[np.minimum(np.searchsorted(self.units, own), len(self.units) - 1)] == own)
        # the last sign before a word other than a space tells whether a sentence begins there
        signs = np.concatenate([[0], np.cumsum(_ENDS[data])])
        previous = np.where(same, np.r_[0, end[:-1]], at[text])
        begins = ~same | (signs[start] > signs[previous])
        second = np.minimum(start + 1, len(data) - 1)
        capital = (data[start] >= 65) & (data[start] <= 90) & (end - start > 1) & (data[second] > 90)
        name = ~number & ~unit & ~begins & capital
        self.own = own
        self.hashes = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, own)))
        self.slots = np.where(number | unit | name, own, np.uint64(0))

    def windows(self, size: int, literals: int, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place in it and hash of every window that has at least ``literals`` words that stand for themselves.

        ``plain``: of every window, and each word in them stands for itself.
        """
        if len(self.hashes) < size:
            none = np.zeros(0, np.int64)
            return none, none, none
        h = arrays.gram_hashes(self.own if plain else self.hashes, size).view(np.int64) ^ np.int64(-size if plain else size)
        literal = np.concatenate([[0], np.cumsum(self.slots == 0)])
        start = np.arange(len(h))
        text = np.searchsorted(self.first, start, "right") - 1
        ok = (start + size <= self.first[text + 1]) & (plain | (literal[size:] - literal[:-size] >= literals))
        return text[ok], start[ok] - self.first[text[ok]], h[ok]


_WINDOWS = "id long, row string, size int, place int, of int, plain boolean, hash long, slots array<long>"


def _windows(column: str, sizes: list[int] | None, size: int, keep: np.ndarray | None):
    """Windows of the texts: all of the given sizes that pass the filter, or, without sizes, those of benchmark items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, limit=1 << 20):
            tokens = Tokens(*arrays.texts(batch.column("text")))
            count = np.diff(tokens.first)
            # an item of fewer tokens than a window is one window, of its own size
            wanted = sizes if sizes is not None else sorted({min(size, int(c)) for c in count if c})
            for n, plain in [(n, plain) for n in wanted for plain in (False, True) if plain or n >= min(size, LEAST)]:
                text, place, h = tokens.windows(n, LITERALS, plain)
                if sizes is None:
                    ok = np.minimum(count[text], size) == n
                else:
                    ok = keep[h & (FILTER - 1)] > 0
                text, place, h = text[ok], place[ok], h[ok]
                if plain and sizes is not None:  # where in a document does not matter
                    first = np.unique(np.stack([text, h]), axis=1, return_index=True)[1]
                    text, place, h = text[first], place[first], h[first]
                start = tokens.first[text] + place
                slots = tokens.slots[start[:, None] + np.arange(n)].view(np.int64)
                held = [row[row != 0] for row in slots]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(column).take(pa.array(text)),
                        batch.column("row").take(pa.array(text)),
                        pa.array(np.full(len(text), n, np.int32)),
                        pa.array(place.astype(np.int32)),
                        pa.array((count[text] - n + 1).astype(np.int32)),
                        pa.array(np.full(len(text), plain)),
                        pa.array(h),
                        pa.array(held, pa.list_(pa.int64())),
                    ],
                    ["id", "row", "size", "place", "of", "plain", "hash", "slots"],
                )

    return run


def _within(at_doc: np.ndarray, at_item: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the places (item, document) whose shift is at least ``low`` and less than ``high``; ``at_doc`` ascends."""
    begin, end = np.searchsorted(at_doc, at_item + low), np.searchsorted(at_doc, at_item + high)
    item = np.repeat(np.arange(len(at_item)), end - begin)
    return item, np.arange(len(item)) + np.repeat(begin - (np.cumsum(end - begin) - (end - begin)), end - begin)


def consistent(templates: list[tuple[np.ndarray, ...]], pairs: int = PAIRS) -> tuple[set[int], int, int]:
    """Item places that some alignment matches, and the values and changed values of the alignment with the most changed.

    ``templates``: per common window the ascending places and the slots in the document, then in the item.
    """
    places: set[int] = set()
    slots = changed = 0
    several = []
    for at_doc, held_doc, at_item, held_item in templates:
        if held_doc.shape[1]:
            several.append((at_doc, held_doc, at_item, held_item))
        else:  # without placeholders there is nothing to be consistent about
            places |= set(at_item.tolist())
    if not several:
        return places, slots, changed
    low = min(int(d[0] - i.max()) for d, _, i, _ in several)
    high = max(int(d[-1] - i.min()) for d, _, i, _ in several) + 1
    names = np.unique(np.concatenate([held.ravel() for t in several for held in (t[1], t[3])]))
    several = [(d, np.searchsorted(names, hd), i, np.searchsorted(names, hi)) for d, hd, i, hi in several]
    blocks = max(-(-sum(len(d) * len(i) for d, _, i, _ in several) // pairs), (high - low) * len(names) // (16 * pairs) + 1)
    step = max(1, -(-(high - low) // blocks))
    for begin in range(low, high, step):
        met = [_within(at_doc, at_item, begin, begin + step) for at_doc, _, at_item, _ in several]
        # by alignment and value of the item: a value it met, whether it met several, whether it counts, and as changed
        first, many, seen, other = np.full(step * len(names), -1), *np.zeros((3, step * len(names)), bool)
        rows = []
        for (item, doc), (at_doc, held_doc, at_item, held_item) in zip(met, several, strict=True):
            key = (at_doc[doc] - at_item[item] - begin)[:, None] * len(names) + held_item[item]
            rows.append((key, held_doc[doc], held_doc[doc] != held_item[item]))
            first[key] = held_doc[doc]
        for key, now, _ in rows:
            many[key[first[key] != now]] = True
        for (item, _), (_, _, at_item, _), (key, _, differs) in zip(met, several, rows, strict=True):
            # a value that meets several values takes the changed windows that hold it along
            good = ~(differs.any(axis=1) & many[key].any(axis=1))
            places |= set(np.unique(at_item[item[good]]).tolist())
            seen[key[good]] = True
            other[key[good][differs[good]]] = True
        count = zip(other.reshape(step, -1).sum(axis=1).tolist(), seen.reshape(step, -1).sum(axis=1).tolist(), strict=True)
        changed, slots = max((changed, slots), max(count))
    return places, slots, changed
    low = min(int(d[0] - i.max()) for d, _, i, _ in several)
    high = max(int(d[-1] - i.min()) for d, _, i, _ in several) + 1
    blocks = -(-sum(len(d) * len(i) for d, _, i, _ in several) // pairs)
    step = max(1, -(-(high - low) // blocks))
    for begin in range(low, high, step):
        window, shift, was, now, of = [], [], [], [], []
        for at_doc, held_doc, at_item, held_item in several:
            item, doc = _within(at_doc, at_item, begin, begin + step)
            number = len(of) + np.arange(len(item))
            of += at_item[item].tolist()
            width = held_doc.shape[1]
            window.append(np.repeat(number, width))
            shift.append(np.repeat(at_doc[doc] - at_item[item], width))
            was.append(held_item[item].ravel())
            now.append(held_doc[doc].ravel())
        if not of:
            continue
        window, shift, was, now = (np.concatenate(a) for a in (window, shift, was, now))
        # a value that meets several values along an alignment takes the changed windows that hold it along
        order = np.lexsort((now, was, shift))
        s, a, b = shift[order], was[order], now[order]
        value = np.cumsum(np.r_[True, (s[1:] != s[:-1]) | (a[1:] != a[:-1])]) - 1
        many = np.zeros(value[-1] + 1, bool)
        many[value[1:][(value[1:] == value[:-1]) & (b[1:] != b[:-1])]] = True
        altered, torn = np.zeros(len(of), bool), np.zeros(len(of), bool)
        altered[window[was != now]] = True
        torn[window[order][many[value]]] = True
        good = ~(altered & torn)
        places |= set(np.array(of)[good].tolist())
        rows = np.unique(np.stack([shift, was, now], axis=1)[good[window]], axis=0)
        if len(rows):
            along, count = np.unique(rows[:, 0], return_counts=True)
            other = np.bincount(np.searchsorted(along, rows[:, 0]), rows[:, 1] != rows[:, 2], len(along)).astype(int)
            best = max(zip(other.tolist(), count.tolist(), strict=True))
            if best > (changed, slots):
                changed, slots = best
    return places, slots, changed


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document and item the number of windows matched, of values at placeholders there, and of changed ones."""

    def arrays_of(windows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        windows = sorted(windows, key=lambda w: w["place"])
        held = np.array([w["slots"] for w in windows], np.int64).reshape(len(windows), -1)
        return np.array([w["place"] for w in windows], np.int64), held

    for batch in batches:
        out = []
        for plain, values, templates in zip(*(batch.column(c).to_pylist() for c in ("plain_places", "plain_slots", "templates")), strict=True):
            places, slots, changed = consistent([(*arrays_of(t["at_doc"]), *arrays_of(t["at_item"])) for t in templates])
            out.append((len(places | set(plain)), max(slots, len(values)), changed))
        same = [batch.column(c) for c in ("doc_id", "row", "item_id", "item_row", "item_windows")]
        new = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*same, *new], ["doc_id", "row", "item_id", "item_row", "item_windows", "windows", "slots", "changed"])


def contained(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """doc_id, item_id, windows, coverage, slots, changed and kind ('verbatim' or 'reparameterised') of contained items.

    ``coverage`` is the share of the item's windows that are matched, at least ``cover``; ``slots`` the
    item's distinct values at placeholders there, ``changed`` those that the document replaces. Texts that are NULL, empty or
    without words contain nothing and are contained in nothing; items of fewer than ``window`` tokens match as a whole.
    Documents that repeat a doc_id are one document, items that repeat an item_id one item, and the best of its texts counts.
    Each text without a doc_id is a document of its own, with its own rows under NULL.
    """
    return _contained(docs, benchmark, window, cover).drop("own")


def _contained(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """What :func:`contained` returns, and own, which tells documents without a doc_id apart (NULL for others)."""
    prepared(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.withColumn("row", text_digest())
    items = cut(items.mapInArrow(_windows("item_id", None, window, None), _WINDOWS), "benchmark-windows")
    # bounded: the window sizes, and the places in the filter
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    keep = np.zeros(FILTER, np.uint8)
    places = items.select(F.col("hash").bitwiseAND(FILTER - 1).cast("int").alias("place")).distinct().toPandas()["place"]
    keep[places.to_numpy(dtype=np.int64)] = 1
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(keep))

    def run(batches: Iterator[pa.RecordBatch], size=window) -> Iterator[pa.RecordBatch]:
        yield from _windows("doc_id", sizes, size, np.unpackbits(sent.value))(batches)

    seen = id_and_text(docs).withColumn("row", text_digest()).mapInArrow(run, _WINDOWS)
    at = F.struct("place", "slots")
    of_item = items.groupBy("hash", "size", "plain", F.col("id").alias("item_id"), F.col("row").alias("item_row")).agg(
        F.max("of").alias("item_windows"), F.collect_list(at).alias("at_item")
    )
    of_doc = seen.groupBy(F.col("id").alias("doc_id"), "row", "hash", "size", "plain").agg(
        F.collect_list(F.when(~F.col("plain"), at)).alias("at_doc")
    )
    hits = of_doc.join(of_item, ["hash", "size", "plain"])
    met = hits.groupBy("doc_id", "row", "item_id", "item_row").agg(
        F.max("item_windows").alias("item_windows"),
        F.array_distinct(F.flatten(F.collect_list("at_item.place"))).alias("reach"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("plain"), F.col("at_item.place"))))).alias("plain_places"),
        F.array_distinct(F.flatten(F.flatten(F.collect_list(F.when(F.col("plain"), F.col("at_item.slots")))))).alias("plain_slots"),
        F.collect_list(F.when(~F.col("plain"), F.struct("at_doc", "at_item"))).alias("templates"),
    )
    # what does not reach the share with all windows, consistent or not, cannot with fewer
    met = met.where(F.size("reach") >= cover * F.col("item_windows")).drop("reach")
    found = met.mapInArrow(_matched, "doc_id long, row string, item_id long, item_row string, item_windows int, windows long, slots long, changed long")
    own = F.when(F.col("doc_id").isNull(), F.col("row")).alias("own")
    found = found.where("windows > 0").select("doc_id", own, "item_id", "item_row", "item_windows", "windows", "slots", "changed")
    found = found.groupBy("doc_id", "own", "item_id", "item_row", "item_windows").agg(F.max(F.struct("windows", "slots", "changed")).alias("best"))
    found = found.select("doc_id", "own", "item_id", "item_windows", "best.*")
    found = found.withColumn("coverage", F.col("windows") / F.col("item_windows")).where(F.col("coverage") >= cover)
    kind = F.when(F.col("changed") > 0, "reparameterised").otherwise("verbatim")
    best = F.max(F.struct("coverage", "windows", "slots", "changed")).alias("best")
    found = found.groupBy("doc_id", "own", "item_id").agg(best).select("doc_id", "own", "item_id", "best.*")
    return found.select("doc_id", "own", "item_id", "windows", "coverage", "slots", "changed", kind.alias("kind"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, of documents that contain no benchmark item."""
    hit = _contained(docs, benchmark).select(F.col("doc_id").alias("hit_doc"), F.col("own").alias("hit_own")).distinct()
    hit = cut(hit, "contaminated")
    known = docs["doc_id"].cast("long")
    own = F.when(known.isNull(), F.md5(F.coalesce(docs["text"], F.lit(""))))
    return docs.join(hit, known.eqNullSafe(hit["hit_doc"]) & own.eqNullSafe(hit["hit_own"]), "left_anti")
