"""Secrets in whole texts through a trigram index.

Every rule is an alternation of sequences of literals and character classes, from which the trigrams follow that any
match must hold: a Boolean query of the form any-of (all-of trigrams). A piece of the table is one shard of the index:
for the trigrams the rules need it holds posting lists of its documents. A rule's query intersects and unites
posting lists; only the documents that remain are searched with the expression. A rule without mandatory trigrams
searches every document. Shards need no shuffle, as a document lies in one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.common import id_and_text, prepared

try:  # the regular-expression parser moved in Python 3.11
    from re import _constants as sre
    from re import _parser as parser
except ImportError:  # pragma: no cover
    import sre_constants as sre
    import sre_parse as parser


@dataclass(frozen=True)
class Rule:
    """``least``: characters of ``group`` under which a match is dropped."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# ---- fixed values: the base rules
BASE = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# ---- end of fixed values

#: A private key of any type: to its END line, or, where another BEGIN or the text's end comes first, to the end of the
#: header lines and the base64 block. Lines may be parted by the two characters of an escaped line break.
PEM = (
    r"-----BEGIN (?P<type>[A-Z0-9 ]{0,40})PRIVATE KEY(?P<block> BLOCK)?-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END (?P=type)PRIVATE KEY(?(block) BLOCK)-----"
    r"|(?:(?:(?:\s|\\[nr])*(?:(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID): [^\r\n\\]*|[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9+/]+={1,2}|=[A-Za-z0-9+/]{4}(?![A-Za-z0-9+/])))+"
    r"(?:\s*\n[A-Za-z0-9+/]{1,15}(?![^\r\n]))?)?)"
)
#: Further forms; their spans are added to those of the base.
MORE = (
    Rule("pem", PEM),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url", r"[a-z][a-z0-9+]{1,9}://[^\s:/@]+:[^\s/@]{3,}@"),
)

Query = frozenset[frozenset[str]]  # any of these sets of trigrams, in lower case; the empty query asks for nothing


def _strings(parsed, most: int = 32) -> list[list[str]]:
    """Runs of literals that a match holds, one list per alternative; between two runs anything may stand.

    Where more than ``most`` alternatives would result, a part is taken as anything: the query then asks for less.
    """
    found: list[list[str]] = [[""]]

    def extend(options: list[list[str]]) -> None:
        nonlocal found
        if len(found) * len(options) > most:
            options = [["", ""]]
        found = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in found for b in options]

    for op, value in parsed:
        if op is sre.LITERAL:
            extend([[chr(value).lower()]])
        elif op is sre.SUBPATTERN:
            extend(_strings(value[-1], most))
        elif op is sre.BRANCH:
            extend([s for branch in value[1] for s in _strings(branch, most)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = value
            if low == high == 1:
                extend(_strings(inner, most))
            elif (low, high) == (0, 1):  # with it or without
                extend([[""], *_strings(inner, most)])
            else:
                extend([["", ""]])
        elif op is sre.IN and len(value) <= 8 and all(k is sre.LITERAL for k, _ in value):
            extend([[chr(v).lower()] for _, v in value])
        else:
            extend([["", ""]])
    return found


def trigram_query(pattern: str) -> Query:
    """The trigrams any match must hold; empty if there is an alternative without a literal of three characters."""
    wanted = set()
    for runs in _strings(parser.parse(pattern)):
        grams = frozenset(r[i : i + 3] for r in runs for i in range(len(r) - 2) if r.isascii())
        if not grams:
            return frozenset()
        wanted.add(grams)
    return frozenset(w for w in wanted if not any(v < w for v in wanted))


class Index:
    """Posting lists of the rules' trigrams, built for one shard at a time."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.queries = {r.kind: trigram_query(r.pattern) for r in rules}
        grams = sorted({g for q in self.queries.values() for s in q for g in s})
        self.number = {g: i + 1 for i, g in enumerate(grams)}
        self.table = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for g, i in self.number.items():
            a, b, c = g.encode("ascii")
            self.table[a << 16 | b << 8 | c] = i
        self.lower = np.arange(256, dtype=np.int32)
        self.lower[65:91] += 32

    def shard(self, data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Documents of each trigram, ascending."""
        low = self.lower[data]
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else low[:0]
        gram = self.table[code]
        place = np.flatnonzero(gram)
        doc = arrays.owner(at, place)
        inside = place + 3 <= at[doc + 1]
        pair = np.unique(gram[place][inside].astype(np.int64) * len(at) + doc[inside])
        gram, doc = np.divmod(pair, len(at))
        cuts = np.searchsorted(gram, [*self.number.values(), len(self.number) + 1])
        return {g: doc[a:b] for g, a, b in zip(self.number, cuts, cuts[1:], strict=False)}

    def candidates(self, kind: str, postings: dict[str, np.ndarray], docs: int) -> np.ndarray:
        if not self.queries[kind]:
            return np.arange(docs)
        some = []
        for grams in self.queries[kind]:
            lists = sorted((postings[g] for g in grams), key=len)
            held = lists[0]
            for more in lists[1:]:
                held = np.intersect1d(held, more, assume_unique=True)
            some.append(held)
        return np.unique(np.concatenate(some))


def spans_of(rule: Rule, expression: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in expression.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def find_secrets(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id and, for all documents, spans: array of (start, end, kind) in characters, end exclusive, by start, then kind.

    Also base_spans, those of the base rules. Matches are leftmost and non-overlapping per rule. A NULL or empty text has
    none. Every row has its own, repeated doc_ids too. No rows, no rows.
    """
    rules = (*base, *more)
    rank = {r.kind: i for i, r in enumerate(rules)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, expressions = Index(rules), {r.kind: re.compile(r.pattern) for r in rules}
        kind_of = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in arrays.pieces(batches):
            data, at = arrays.texts(batch.column("text"))
            postings, found = index.shard(data, at), [[] for _ in range(batch.num_rows)]
            texts: dict[int, str] = {}
            for rule in rules:
                for i in index.candidates(rule.kind, postings, batch.num_rows).tolist():
                    if i not in texts:
                        texts[i] = batch.column("text")[i].as_py() or ""
                    found[i] += [(a, rank[rule.kind], b) for a, b in spans_of(rule, expressions[rule.kind], texts[i])]
            rows = [[{"start": a, "end": b, "kind": rules[k].kind} for a, k, b in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind_of)], ["doc_id", "spans"])

    found = id_and_text(docs).mapInArrow(run, "doc_id long, spans array<struct<start:int,end:int,kind:string>>")
    names = [r.kind for r in base]
    return found.withColumn("base_spans", F.filter("spans", lambda s: s["kind"].isin(names)))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; in text, overlapping spans of secrets are united and replaced by ``mark``."""
    prepared(docs.sparkSession)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = (*BASE, *MORE)
        index, expressions = Index(rules), {r.kind: re.compile(r.pattern) for r in rules}
        for batch in arrays.pieces(batches):
            data, offsets = arrays.texts(batch.column("text"))
            postings, found = index.shard(data, offsets), {}
            for rule in rules:
                for i in index.candidates(rule.kind, postings, batch.num_rows).tolist():
                    text = batch.column("text")[i].as_py() or ""
                    if spans := spans_of(rule, expressions[rule.kind], text):
                        found.setdefault(i, []).extend(spans)
            if found:
                texts = batch.column("text").to_pylist()
                for i, spans in found.items():
                    texts[i] = _masked(texts[i], spans, mark)
                columns = [batch.column(k) if k != at else pa.array(texts, batch.column(at).type) for k in range(len(names))]
                batch = pa.RecordBatch.from_arrays(columns, names)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def _masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
