"""Token ids of whole texts, with a cache of words.

The tokenizer of `tokenizers` lower-cases a text, splits it at white space and at the border between letters and other
characters, and tokenizes each part for itself. Texts of Latin-1 are therefore lower-cased and full stops and commas
set apart first, which leaves fewer words; words of letters only, or of one sign, are tokenized many at a
time. Everything else goes through the tokenizer as it is.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

#: What the tokenizer takes as one part. An apostrophe may start a contraction, so it is none of the signs.
_PART = re.compile(r"[a-zß-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")
_ASCII_SIGN = np.zeros(256, dtype=bool)
_ASCII_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127), *range(0x80, 0xC0), 0xD7, 0xF7]] = True


class WordCache:
    """Little-endian unsigned 32-bit ids of texts. ``most`` bounds the words that are kept."""

    def __init__(self, path: str, most: int = 700_000):
        self.tokenizer = Tokenizer.from_file(path)
        ends = self.tokenizer.get_vocab()
        self.last = np.zeros(max(ends.values()) + 1, dtype=bool)
        self.last[[i for token, i in ends.items() if token.endswith("</w>")]] = True
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        self.most = most

    def _direct(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _learn(self, words: list[str]) -> None:
        """Fill the cache: words of one part are tokenized together, and the ids cut at the ends of parts."""
        match = _PART.fullmatch
        plain = [w for w in words if match(w)]
        odd = [w for w in words if not match(w)] if len(plain) < len(words) else []
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) == len(plain):
                raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                self.known.update(zip(plain, [raw[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
            else:  # a word that is not one part for the tokenizer
                odd += plain
        self.known.update(zip(odd, self._direct(odd), strict=True))

    def _split(self, text: str) -> list[str]:
        """Words; of Latin-1 texts in which no two signs meet, full stops and commas before a space stand apart."""
        try:
            signs = _ASCII_SIGN[np.frombuffer(text.encode("latin-1"), np.uint8)]
        except UnicodeEncodeError:
            return text.replace("\n", " ").split(" ")
        text = text.lower().replace("\n", " ")
        if not (signs[1:] & signs[:-1]).any():
            text = f"{text} ".replace(". ", " . ").replace(", ", " , ")
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most:
            self.known = {"": b""}
        split = [self._split(t) for t in texts]
        unknown = set().union(*split).difference(self.known)
        if unknown:
            self._learn(list(unknown))
        found = self.known.__getitem__
        out = [b"".join(map(found, words)) for words in split]
        # lower-casing may have made one, which the tokenizer would not see
        both = [(t, t.lower()) for t in texts]
        direct = [i for i, (t, low) in enumerate(both) if any(s in t or s in low for s in self.special)]
        if direct:
            for i, ids in zip(direct, self._direct([texts[i] for i in direct]), strict=True):
                out[i] = ids
        return out


_caches: dict[str, WordCache] = {}


def worker_cache(path: str) -> WordCache:
    """The cache of this Python worker, which serves one task after another."""
    if path not in _caches:
        _caches[path] = WordCache(path)
    return _caches[path]
