"""Unigram token counts by trie-shared dynamic programming (operator 4).

The vocabulary is a list of pieces in order of frequency; the piece at rank r scores -log(r + 1), a
unigram model after Zipf.  A text's pre-tokens are its runs without ASCII white space, each with the
word mark before it, and a pre-token's tokens are the split into pieces with the greatest summed score;
of equal sums the one with fewer tokens.  A character no piece covers costs ``UNKNOWN`` and counts as
its UTF-8 bytes (byte fallback).

The distinct pre-tokens of a chunk of texts are put in a trie, level by level.  A node's forward score
is the best over the pieces that end there, each added to the forward score of the node above its
start; so a shared prefix is scored once for all words that have it, and terminal nodes hold the counts.
Chunks lie in tasks side by side, nothing is shuffled, and a document's count is a sum over its words.

Null and empty texts have zero tokens; repeated rows and ids come back as they came; an empty table
gives no row; only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskloom.llm.common import text_chunks, texts

MARK = "▁"
UNKNOWN = -30.0
#: Longer pre-tokens are scored alone: they share little and would add a level for every character.
TRIE_DEPTH = 64

_MODELS: dict[str, UnigramModel] = {}


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file, most frequent first."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_unknown(i) or p.is_control(i) or p.is_byte(i) or p.is_unused(i))]


def model(path: str) -> UnigramModel:
    """The worker's model of a vocabulary file."""
    if path not in _MODELS:
        _MODELS[path] = UnigramModel(sentencepiece_pieces(path))
    return _MODELS[path]


class UnigramModel:
    def __init__(self, pieces: list[str]):
        self.score: dict[str, float] = {}
        for rank, p in enumerate(pieces):
            if p:
                self.score.setdefault(p, -math.log(rank + 1))
        self.longest = max(map(len, self.score), default=1)
        # Suffix hashes: that of a longer suffix adds one character before it, so a node's come from
        # its parent's; looked up in a sorted table and confirmed by construction (no two are equal).
        self.base = np.uint64(0x9E3779B97F4A7C15)
        known = np.array([self._hash(p) for p in self.score], np.uint64)
        if len(np.unique(known)) != len(known):
            raise ValueError("two pieces share a hash")
        order = np.argsort(known)
        self.known, self.value = known[order], np.array(list(self.score.values()))[order]
        lengths = np.array([len(p) for p in self.score])[order]
        self.by_length = [(self.known[lengths == n], self.value[lengths == n]) for n in range(self.longest + 1)]

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self.base) + ord(c) + 1) % 2**64
        return h

    def count_alone(self, word: str) -> int:
        """The plain forward recurrence over one pre-token."""
        best, count = [0.0], [0]
        for j in range(1, len(word) + 1):
            top, tokens = best[j - 1] + UNKNOWN, count[j - 1] + len(word[j - 1].encode())
            for i in range(max(0, j - self.longest), j):
                s = self.score.get(word[i:j])
                if s is not None and (best[i] + s, -count[i] - 1) > (top, -tokens):
                    top, tokens = best[i] + s, count[i] + 1
            best.append(top)
            count.append(tokens)
        return count[-1]

    def count_words(self, words: list[str]) -> np.ndarray:
        """Token counts of distinct pre-tokens."""
        out = np.zeros(len(words), np.int64)
        lens = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(lens > TRIE_DEPTH):
            out[i] = self.count_alone(words[i])
        own = [i for i in np.flatnonzero((lens > 0) & (lens <= TRIE_DEPTH))]
        own.sort(key=lambda i: words[i])  # words with a common prefix side by side
        if not own:
            return out
        lens = lens[own]
        depth = int(lens.max())
        chars = np.frombuffer("".join(words[i].ljust(depth, "\0") for i in own).encode("utf-32-le"), np.uint32).reshape(len(own), depth)
        wide = min(self.longest, depth)
        node = np.zeros(len(own), np.int64)  # of each word, its node one level up
        ended = np.zeros(len(own), np.int64)
        # Of the level's nodes: forward score and tokens of the node 0, 1, ... levels up, and the
        # hashes of the last 0, 1, ... characters.
        score, tokens, suffix = np.zeros((1, 1)), np.zeros((1, 1), np.int64), np.zeros((1, 1), np.uint64)
        for d in range(depth):
            live = np.flatnonzero(lens > d)
            c, up = chars[live, d], node[live]
            new = np.ones(len(live), bool)
            new[1:] = (up[1:] != up[:-1]) | (c[1:] != c[:-1])
            first = np.flatnonzero(new)
            node[live] = np.cumsum(new) - 1
            c, up = c[first], up[first]
            above, spent = score[up], tokens[up]  # column k: the node k + 1 levels up
            k = min(d + 1, wide)
            ends = (c.astype(np.uint64) + np.uint64(1))[:, None]  # hash of the last character
            if k > 1:
                ends = np.concatenate([ends, suffix[up][:, : k - 1] * self.base + ends], axis=1)
            size = np.where(c < 0x80, 1, np.where(c < 0x800, 2, np.where(c < 0x10000, 3, 4)))
            best, least = above[:, 0] + UNKNOWN, spent[:, 0] + size
            for n in range(k, 0, -1):  # longer pieces first, as they start further up
                keys, values = self.by_length[n]
                if not len(keys):
                    continue
                at = np.minimum(np.searchsorted(keys, ends[:, n - 1]), len(keys) - 1)
                hit = keys[at] == ends[:, n - 1]
                s, t = above[:, n - 1] + values[at], spent[:, n - 1] + 1
                better = hit & ((s > best) | ((s == best) & (t < least)))
                best, least = np.where(better, s, best), np.where(better, t, least)
            score = np.concatenate([best[:, None], above[:, : wide - 1]], axis=1)
            tokens = np.concatenate([least[:, None], spent[:, : wide - 1]], axis=1)
            suffix = ends
            over = live[lens[live] == d + 1]
            ended[over] = tokens[node[over], 0]
        out[own] = ended
        return out


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of every whole text."""

    def count(batches):
        from riskloom.llm.tokencount import model

        unigram = model(path)
        for batch in batches:
            for chunk in text_chunks(batch, limit=8 << 20):
                column = chunk.column("text").fill_null("")
                lists = pc.ascii_split_whitespace(column)
                offsets = lists.offsets.to_numpy().astype(np.int64)
                coded = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
                parts = coded.dictionary.to_pylist()
                counts = unigram.count_words([MARK + w if w else "" for w in parts])
                real = np.array([bool(w) for w in parts], np.int64)
                index = coded.indices.to_numpy()
                sums = [np.concatenate([[0], np.cumsum(x[index] if len(index) else np.zeros(0, np.int64))])[offsets - offsets[0]] for x in (real, counts)]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *(pa.array(np.diff(x)) for x in sums)], names=["doc_id", "n_words", "n_tokens"])

    return texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_words long, n_tokens long")
