"""Windows that occur more than once, found without sending every window.

A text is a sequence (of bytes, or of words). Each window of ``size`` elements has a minimiser: the leftmost of its
``gram``-element pieces whose hash is smallest. Equal windows have equal minimisers at the same place, so consecutive
windows with one minimiser travel as one segment, and only segments of one minimiser need comparing:

1. ``segments``: (minimiser, digest) of every segment, no text. Runs of one repeated segment are one row.
2. ``Found.shared``: segments whose minimiser occurs again. If all segments of a minimiser are the same string, the
   digest settles it; copies, however many, end here.
3. ``Found.ranges``: where strings differ, each distinct string travels once, from its smallest document, to its
   minimiser, and a compare step (given by the operator) works on the strings themselves.
4. A minimiser with more than ``block`` distinct strings is split by what equal windows must share. Its strings are
   aligned at the minimiser; the windows that start left of the middle of the alignment all cover a stretch that is
   longer than the minimiser, and so do those right of it. Either half goes to the part that its stretch names, so equal
   windows meet in one part, and parts that are still crowded are halved again. Where one column is left, the stretch
   is the window, and a part is one distinct string. Strings that share a half are one row of its part.
5. The removed spans return to the documents.

Every step is a shuffle by a key, counts are pre-aggregated, joins can be split, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import cut, id_and_text

SEGMENTS = (
    "doc_id long, row_key long, minimiser long, h1 long, h2 long, start int, windows int, reps int, place int"
)
_STEP = 1 << 20  # elements handled at once
_PLACE_BITS = np.uint64(24)


@dataclass(frozen=True)
class Scheme:
    """``elements``: (bytes, text bounds) -> (values, bounds of the texts among them)."""

    size: int
    gram: int
    elements: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def bytes_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, at


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, bounds = arrays.words(data, at)
    return arrays.word_hashes(data, start, end), bounds


def row_keys(texts: pa.Array) -> np.ndarray:
    """With doc_id, what tells rows apart also where a doc_id comes twice."""
    return np.array([xxhash.xxh3_64_intdigest(t.as_buffer() if t.is_valid else b"") for t in texts], np.uint64).view(np.int64)


def _segments(values: np.ndarray, bounds: np.ndarray, scheme: Scheme) -> Iterator[dict[str, np.ndarray]]:
    """Segments of the windows of all texts; windows that start in different steps are in different segments."""
    size, gram = scheme.size, scheme.gram
    width = size - gram + 1
    for low in range(0, max(0, len(values) - size + 1), _STEP):
        part = values[low : low + _STEP + size - 1]
        h = arrays.gram_hashes(part, gram)
        key = (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        least = (arrays.sliding_min(key, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
        starts = np.arange(len(least))
        text = arrays.owner(bounds, starts + low)
        ok = starts + low + size <= bounds[text + 1]
        starts, text, least = starts[ok], text[ok], least[ok]
        if not len(starts):
            continue
        new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
        count = np.diff(np.r_[new, len(starts)])
        begin = starts[new]
        view, wide = memoryview(np.ascontiguousarray(part)).cast("B"), part.itemsize
        digest = xxhash.xxh3_128_digest
        ends = (begin + count + size - 1) * wide
        digests = np.frombuffer(b"".join([digest(view[a:b]) for a, b in zip((begin * wide).tolist(), ends.tolist(), strict=True)]), "<i8")
        h1, h2, text = digests[::2], digests[1::2], text[new]
        # a run of one segment, as periodic texts have it, is one row
        again = np.r_[False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1]) & (text[1:] == text[:-1]) & (count[1:] == count[:-1])]
        first = np.flatnonzero(~again)
        place = least[new] - begin
        yield {
            "text": text[first],
            "minimiser": h[least[new][first]].view(np.int64),
            "h1": h1[first],
            "h2": h2[first],
            "start": (begin[first] + low - bounds[text[first]]).astype(np.int32),
            "windows": count[first].astype(np.int32),
            "reps": np.diff(np.r_[first, len(new)]).astype(np.int32),
            "place": place[first].astype(np.int32),
        }


#: Stands for a NULL doc_id while documents are compared; it counts as the smallest.
_NO_ID = -(1 << 63)


def _known(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)))


def segments(docs: DataFrame, scheme: Scheme) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches):
            data, at = arrays.texts(batch.column("text"))
            values, bounds = scheme.elements(data, at)
            keys = row_keys(batch.column("text"))
            for found in _segments(values, bounds, scheme):
                text = found.pop("text")
                columns = [batch.column("doc_id").take(pa.array(text)), pa.array(keys[text]), *map(pa.array, found.values())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", *found])

    return _known(docs).mapInArrow(run, SEGMENTS)


#: Distinct strings as they are compared; ``place`` is where the minimiser stands in them.
STRINGS = "minimiser long, h1 long, h2 long, first_doc long, windows int, place int, string binary"
#: The half (o1, o2 from window ``shift`` on) of a string whose windows start in columns low to high of the alignment.
PARTS = f"{STRINGS}, part long, low int, high int, o1 long, o2 long, shift int"


def _halves(size: int, cut_out: Callable):
    """Each string (PARTS) as its windows left and right of the middle column, with the part of what they all cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PARTS.split(", ")]
        for batch in batches:
            held = {n: batch.column(n).to_numpy() for n in ("low", "high", "place", "windows", "shift")}
            middle = (held["low"] + held["high"]) // 2
            for low, high in ((held["low"], middle), (middle + 1, held["high"])):
                # columns of the first and the last window that the string has there
                first, last = np.maximum(low, -held["place"]), np.minimum(high, held["windows"] - 1 - held["place"])
                use = np.flatnonzero(first <= last)
                strings, parts = [], np.zeros(len(use), np.uint64)
                for k, i in enumerate(use):
                    begin, end = np.array([first[i], high[i]]), np.array([last[i], low[i]]) + size
                    text, shared = cut_out(batch.column("string")[int(i)].as_py(), begin + held["place"][i], end + held["place"][i])
                    strings.append(text)
                    parts[k] = xxhash.xxh3_64_intdigest(shared, seed=int(-low[i]))
                digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), "<i8")
                skipped = (first + held["place"])[use]
                rows = batch.take(pa.array(use, pa.int64()))
                new = {
                    "h1": digests[::2],
                    "h2": digests[1::2],
                    "windows": (last - first + 1)[use],
                    "place": held["place"][use] - skipped,
                    "part": parts.view(np.int64),
                    "low": low[use],
                    "high": high[use],
                    "shift": held["shift"][use] + skipped,
                }
                new = {n: pa.array(v, rows.schema.field(n).type) for n, v in new.items()}
                new["string"] = pa.array(strings, pa.binary())
                yield pa.RecordBatch.from_arrays([new.get(n, rows.column(n)) for n in names], names)

    return run


@dataclass
class Found:
    """Segments that occur again: ``same`` (their minimiser has one string only) and ``mixed``."""

    docs: DataFrame
    scheme: Scheme
    shared: DataFrame
    distinct: DataFrame

    @classmethod
    def of(cls, docs: DataFrame, scheme: Scheme, across_docs: bool) -> Found:
        """``across_docs``: only minimisers that occur in two documents matter."""
        rows = cut(segments(docs, scheme), "segments")
        per = rows.groupBy("minimiser").agg(
            F.sum("reps").alias("copies"),
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
            (F.min("h1") != F.max("h1")).alias("mixed"),
        )
        per = per.where("first_doc < last_doc" if across_docs else "copies > 1").drop("last_doc")
        shared = cut(rows.join(per, "minimiser"), "shared-segments")
        distinct = (
            shared.where("mixed")
            .groupBy("minimiser", "h1", "h2")
            .agg(
                F.sum("reps").alias("copies"),
                F.min("doc_id").alias("first_doc"),
                F.min_by("row_key", "doc_id").alias("row_key"),
                F.min_by("start", "doc_id").alias("start"),
                F.first("windows").alias("windows"),
                F.first("place").alias("place"),
            )
        )
        return cls(docs, scheme, shared, cut(distinct, "distinct-segments"))

    def ranges(self, cut_out: Callable, compare: Callable, block: int, again: str) -> DataFrame:
        """The windows that go, per distinct string: minimiser, h1, h2, ranges.

        ``cut_out(text, starts, ends)`` gives strings of a text, or of a string. ``compare`` judges whole groups of
        (minimiser, part). ``again``: condition under which all windows of a half go, on n (strings that hold it), best
        (the smallest document of these) and first_doc (the string's).
        """
        keys = ["minimiser", "h1", "h2"]
        crowded = self.distinct.groupBy("minimiser").agg(F.count("*").alias("strings")).where(F.col("strings") > block)
        # written first, so that the joins deal both sides anew and can split a crowded minimiser
        crowded = cut(crowded.select("minimiser"), "crowded")
        uncrowded = crowded.isEmpty()
        plain = self.distinct if uncrowded else self.distinct.join(crowded, "minimiser", "left_anti")
        whole = self._strings(plain, cut_out).withColumn("part", F.lit(0).cast("long"))
        found = cut(self._by_part(whole).mapInArrow(compare, COMPARED), "compared").select(*keys, "ranges")
        if uncrowded:
            return found
        parts = self._parts(self._strings(self.distinct.join(crowded, "minimiser", "left_semi"), cut_out), cut_out, block)
        part_keys = ["minimiser", "part", "h1", "h2"]
        alike = parts.groupBy(*part_keys).agg(
            F.count("*").alias("n"),
            F.min("first_doc").alias("first_doc"),
            *(F.first(c).alias(c) for c in ("windows", "place", "string")),
        )
        alike = cut(alike, "alike-parts")
        compared = self._by_part(alike.drop("n")).mapInArrow(compare, COMPARED)
        judged = alike.select(*part_keys, "n", F.col("first_doc").alias("best")).join(compared, part_keys, "left")
        held = parts.select(*part_keys, "o1", "o2", "shift", "windows", "first_doc").join(judged, part_keys)
        every = F.array(F.struct(F.col("shift").alias("a"), (F.col("shift") + F.col("windows")).alias("b")))
        some = F.transform(
            "ranges", lambda r: F.struct((F.col("shift") + r["a"]).alias("a"), (F.col("shift") + r["b"]).alias("b"))
        )
        held = held.withColumn("every", F.expr(again)).where("every OR ranges IS NOT NULL")
        held = held.select("minimiser", "o1", "o2", F.when(F.col("every"), every).otherwise(some).alias("ranges"))
        split = held.groupBy("minimiser", F.col("o1").alias("h1"), F.col("o2").alias("h2"))
        return found.unionByName(split.agg(F.flatten(F.collect_list("ranges")).alias("ranges")))

    def _parts(self, strings: DataFrame, cut_out: Callable, block: int) -> DataFrame:
        """Halves of the strings, and halves of those, until no part has more than ``block`` distinct ones.

        A round halves the columns, so there are at most log2(size) + 1 of them.
        """
        whole = {"part": F.lit(0).cast("long"), "low": F.lit(self.scheme.gram - self.scheme.size), "high": F.lit(0)}
        whole |= {"o1": F.col("h1"), "o2": F.col("h2"), "shift": F.lit(0)}
        rows, done = strings.withColumns(whole), []
        while True:
            rows = cut(rows.mapInArrow(_halves(self.scheme.size, cut_out), PARTS), "parts")
            per = rows.where("low < high").select("minimiser", "part", "h1", "h2").distinct()
            per = per.groupBy("minimiser", "part").agg(F.count("*").alias("strings")).where(F.col("strings") > block)
            crowded = cut(per.select("minimiser", "part"), "crowded")
            if crowded.isEmpty():
                return reduce(DataFrame.unionByName, done, rows)
            done.append(rows.join(crowded, ["minimiser", "part"], "left_anti"))
            rows = rows.join(crowded, ["minimiser", "part"], "left_semi")

    def _by_part(self, strings: DataFrame) -> DataFrame:
        parts = int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return strings.repartition(parts, "minimiser", "part").sortWithinPartitions("minimiser", "part")

    def _strings(self, distinct: DataFrame, cut_out: Callable) -> DataFrame:
        """``distinct`` with the strings, cut out of one document each."""
        size = self.scheme.size
        inner = ["start", "minimiser", "h1", "h2", "windows", "place"]
        per_doc = distinct.groupBy("first_doc", "row_key").agg(F.collect_list(F.struct(*inner)).alias("wanted"))
        packed = squeezed(self.docs).join(
            per_doc, F.expr("doc_id = first_doc AND text_key = row_key")
        ).select("doc_id", "text", "wanted")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            inflate = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                for i in range(batch.num_rows):
                    text = inflate(batch.column("text")[i].as_py())
                    doc, spans = batch.column("doc_id")[i].as_py(), batch.column("wanted")[i].values
                    held = {name: spans.field(k) for k, name in enumerate(inner)}
                    begin = held["start"].to_numpy()
                    strings = cut_out(text, begin, begin + held["windows"].to_numpy() + size - 1)
                    columns = [held[n] for n in ("minimiser", "h1", "h2")]
                    columns += [pa.array([doc] * len(begin), pa.int64()), held["windows"], held["place"], pa.array(strings, pa.binary())]
                    yield pa.RecordBatch.from_arrays(
                        columns, ["minimiser", "h1", "h2", "first_doc", "windows", "place", "string"]
                    )

        return packed.mapInArrow(run, STRINGS)

    def spans(self, compared: DataFrame, covers_all: str) -> DataFrame:
        """Removed spans per row: doc_id, row_key, spans array<struct<start, end>> in elements.

        ``compared``: what ``ranges`` gives. ``covers_all``: condition on copies, first_doc and doc_id
        under which all windows of a segment go.
        """
        size = self.scheme.size
        same = self.shared.where("NOT mixed").withColumn("ranges", F.lit(None).cast("array<struct<a:int,b:int>>"))
        keys = ["minimiser", "h1", "h2"]
        judged = self.distinct.select(*keys, "copies", "first_doc").join(compared, keys, "left")
        mixed = self.shared.where("mixed").drop("copies", "first_doc").join(judged, keys)
        columns = ["doc_id", "row_key", "start", "windows", "reps", "copies", "first_doc", "ranges"]
        both = same.select(*columns).unionByName(mixed.select(*columns)).withColumn("whole", F.expr(covers_all))
        every = F.array(
            F.struct(F.col("start").alias("start"), (F.col("start") + F.col("windows") * F.col("reps") + size - 1).alias("end"))
        )
        some = F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.col("reps") - 1),
                lambda k: F.transform(
                    "ranges",
                    lambda r: F.struct(
                        (F.col("start") + k * F.col("windows") + r["a"]).alias("start"),
                        (F.col("start") + k * F.col("windows") + r["b"] + size - 1).alias("end"),
                    ),
                ),
            )
        )
        out = both.where("whole OR ranges IS NOT NULL").select(
            "doc_id", "row_key", F.explode(F.when(F.col("whole"), every).otherwise(some)).alias("span")
        )
        return out.groupBy("doc_id", "row_key").agg(F.collect_list("span").alias("spans"))

    def kept(self, spans: DataFrame, keep: Callable, schema: str) -> DataFrame:
        """``keep(text bytes, starts, ends)`` of every row, with doc_id in front; ``schema`` names its values."""
        texts = squeezed(self.docs)
        s = spans.withColumnsRenamed({"doc_id": "span_doc"})
        joined = texts.join(s, F.expr("doc_id = span_doc AND text_key = row_key"), "left").select("doc_id", "text", "spans")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            inflate = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                rows, names = [], [c.split()[0] for c in schema.split(",")]
                for i in range(batch.num_rows):
                    found = batch.column("spans")[i]
                    none = np.zeros(0, np.int64)
                    a, b = (none, none) if not found.is_valid else (found.values.field(k).to_numpy() for k in (0, 1))
                    rows.append(keep(inflate(batch.column("text")[i].as_py()), a, b))
                columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

        return joined.mapInArrow(run, f"doc_id long, {schema}").withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def squeezed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the text, compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            texts = batch.column("text")
            small = pa.array([press(t.as_buffer()) if len(t.as_buffer()) else press(b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(row_keys(texts)), small], ["doc_id", "text_key", "text"])

    return _known(docs).mapInArrow(run, "doc_id long, text_key long, text binary")


def groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows in batches that hold whole (minimiser, part) groups and, beyond one group, about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column("minimiser").to_numpy(), batch.column("part").to_numpy()])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        if held and (tuple(keys[:, 0]) != (held[-1].column("minimiser")[-1].as_py(), held[-1].column("part")[-1].as_py())):
            change = np.r_[0, change]
        last = 0
        for c in change:
            # only cut where enough has come together
            size += int(batch.nbytes * (c - last) / batch.num_rows)
            held.append(batch.slice(last, c - last))
            last = int(c)
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
        held.append(batch.slice(last))
        size += int(batch.nbytes * (batch.num_rows - last) / batch.num_rows)
    if any(b.num_rows for b in held):
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks().to_batches()[0]


def union_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans, merged where they touch or overlap, in order."""
    if not len(starts):
        return starts.astype(np.int64), ends.astype(np.int64)
    order = np.argsort(starts, kind="stable")
    a, b = starts[order].astype(np.int64), np.maximum.accumulate(ends[order].astype(np.int64))
    new = np.r_[True, a[1:] > b[:-1]]
    return a[new], b[np.r_[np.flatnonzero(new)[1:] - 1, len(a) - 1]]


#: A string's repeated windows as ranges [a, b); strings without any have no row.
COMPARED = "minimiser long, part long, h1 long, h2 long, ranges array<struct<a:int,b:int>>"


def compared_rows(batch: pa.RecordBatch, hits: list[np.ndarray]) -> pa.RecordBatch:
    """``hits``: repeated windows per string, ascending."""
    use = [i for i, h in enumerate(hits) if len(h)]
    ranges = []
    for i in use:
        runs = np.split(hits[i], np.flatnonzero(np.diff(hits[i]) > 1) + 1)
        ranges.append([{"a": int(r[0]), "b": int(r[-1]) + 1} for r in runs])
    rows = batch.take(pa.array(use, pa.int64()))
    pair = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    names = ["minimiser", "part", "h1", "h2"]
    return pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), pa.array(ranges, pair)], [*names, "ranges"])
