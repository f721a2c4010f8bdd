"""Token ids of whole texts under the public lower-casing word BPE, fast enough for a corpus.

The vocabulary's merges are run by a rank-based BPE over words that end in a marker byte; both give the
same ids. White space never lies inside a piece, so the ids of a white-space-delimited chunk do not depend
on its neighbours and are remembered between texts, in a cache of at most ``CACHE`` chunks a worker. Texts
with a rare character on which the two splitters might differ go through the vocabulary's own library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np

CACHE = 250_000
MARK = "\x01"
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Outside these the quick splitter is not used: other scripts, other numerals, control characters.
_RARE = re.compile("[^\t-\r -~¡-¨«-±´¶·»¿-ɏ‐-‧€]")


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        plain = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
        others = [b for b in range(256) if b not in set(plain.values())]
        plain |= {chr(256 + i): b for i, b in enumerate(others)}

        def raw(token: str) -> bytes:
            whole = token.endswith(end) and len(token) > len(end)
            return bytes(plain[c] for c in (token[: -len(end)] if whole else token)) + (MARK.encode() if whole else b"")

        ids = {raw(t): i for t, i in vocabulary.items() if not t.startswith("<|")}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        ranks: dict[bytes, int] = {}
        for token in [bytes([b]) for b in range(256)] + [bytes([b]) + MARK.encode() for b in range(256)] + [raw(a + b) for a, b in pairs]:
            ranks.setdefault(token, len(ranks))
        self.ids = np.array([ids[t] for t in ranks], np.uint16)
        self.gap = ranks[b" "]
        self.quick = tiktoken.Encoding("words", pat_str=f"[^{MARK} ]+{MARK}| ", mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks in one go; the space between two of them marks where the ids of the first end."""
        ranks = self.quick.encode_to_numpy(_PIECE.sub(lambda m: m[0] + MARK, " ".join(chunks)))
        gaps = np.flatnonzero(ranks == self.gap)
        ends = np.append(gaps, len(ranks)) - np.arange(len(gaps) + 1)
        known = len(self.place)
        self.flat = np.concatenate([self.flat, np.delete(self.ids[ranks], gaps)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
        self.place.update(zip(chunks, range(known, known + len(chunks)), strict=True))

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another as unsigned 16-bit numbers, and each text's start (one more at the end)."""
        split: list[list[str]] = []
        apart: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            if _RARE.search(text):
                apart[i] = np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint16)
                split.append([])
            else:
                split.append(text.lower().split())
        distinct = set()
        for chunks in split:
            distinct.update(chunks)
        missing = [c for c in distinct if c not in self.place]
        if len(self.place) + len(missing) > CACHE:
            self._forget()
            missing = list(distinct)
        if missing:
            self._learn(missing)
        counts = np.array([len(c) for c in split], np.int64)
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(ends[-1]) + np.repeat(self.starts[at] - ends[:-1], lengths)
        ids, bounds = self.flat[take], ends[np.concatenate([[0], np.cumsum(counts)])]
        if apart:
            parts = [apart.get(i, ids[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
