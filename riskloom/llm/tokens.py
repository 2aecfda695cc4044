"""Token ids of whole texts, encoding every distinct word of a worker once.

The tokenizer here lower-cases, drops white space and merges inside runs without white space only.  So
the ids of a text are those of its white-space-free parts in order; a part's ids are kept for the
texts that follow in the same Python worker.
"""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts whose ids a worker keeps; when there are more, it forgets them all and begins anew.
KEEP_PARTS = 600_000
#: Runs of letters whose ids a worker keeps besides, for parts that differ in case or stops only.
KEEP_HEADS = 150_000

_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    """Encodes columns of texts with a tokenizers file whose merges stay inside white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.byte_letters = _byte_letters()
        self.tails: dict[str, list[int]] = {"": []}
        self.heads: dict[str, list[int]] = {}
        self.reset()

    def reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)  # of slot i: ids[at[i]:at[i + 1]]

    def _part(self, w: str) -> list[int] | None:
        """Ids of a part by the merges alone; None if it needs the library's normaliser and splitter.

        Full stops and commas after a Latin-1 letter are tokens apart from it, and a run of Latin-1
        letters is one run for the merges, in lower case, with its UTF-8 bytes as letters."""
        head, tail = w, ""
        if w[-1:] in (".", ","):
            head = w.rstrip(".,")
            tail = w[len(head) :]
        if not head.isalpha():
            return None if w else []
        if head.isascii():
            head = head.lower()
        elif max(head) < "Ā":
            head = head.lower().translate(self.byte_letters)
        else:
            return None
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {"": []}
            self.tails[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
        ids = self.heads.get(head)
        if ids is None:  # a word comes with and without stops, in lower and upper case
            if len(self.heads) >= KEEP_HEADS:
                self.heads = {}
            ids = self.heads[head] = [t.id for t in self.tokenizer.model.tokenize(head)]
        return ids + self.tails[tail] if tail else ids

    def _learn(self, parts: list[str]) -> None:
        found = [self._part(w) for w in parts]
        other = [i for i, ids in enumerate(found) if ids is None]
        for k in range(0, len(other), 4096):
            group = other[k : k + 4096]
            got = self.tokenizer.encode_batch_fast([parts[i] for i in group], add_special_tokens=False)
            for i, e in zip(group, got, strict=True):
                found[i] = e.ids
        n, used = len(self.slot), int(self.at[len(self.slot)])
        ends = used + np.cumsum([len(x) for x in found])
        while n + len(parts) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[used : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1]) - used)
        self.at[n + 1 : n + 1 + len(parts)] = ends
        self.slot.update(zip(parts, range(n, n + len(parts)), strict=True))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order as uint32, offsets of the n + 1 texts); null counts as empty."""
        column = column.fill_null("") if column.null_count else column
        lists = pc.ascii_split_whitespace(column)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        coded = words.dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # strings made in one go
        slots = np.fromiter(map(self.slot.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(slots < 0)
        if len(missing) and len(self.slot) + len(missing) > KEEP_PARTS:
            self.reset()
            missing = np.arange(len(parts))
        if len(missing):
            slots[missing] = len(self.slot) + np.arange(len(missing))
            self._learn([parts[i] for i in missing.tolist()])
        slots = slots[coded.indices.to_numpy()]
        lens = self.at[slots + 1] - self.at[slots]
        to = np.concatenate([[0], np.cumsum(lens)])
        from_ = np.repeat(self.at[slots] - to[:-1], lens) + np.arange(to[-1])
        return self.ids[from_], to[offsets - offsets[0]]


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet for Latin-1 letters: a printable byte stands for itself, the others,
    in order, for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    of = {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(of[b] for b in chr(c).encode()) for c in range(128, 256)}
