"""Byte-level BPE by dynamic programming over prefixes (operator 13).

A text is cut as its tokenizer file says: at its added tokens first, then by the byte-level pattern into
pre-tokens.  A pre-token is encoded without replaying its merges:

1. A suffix automaton over the byte strings of all vocabulary tokens reads the pre-token.  After each
   byte its state is the longest suffix read that occurs in some token; the tokens that end there are on
   the state's suffix links, longest first.  (A token's own string cannot be extended to the left, so it
   is the longest string of its state.)
2. The BPE encoding of a prefix ends in one token only, and it is the one token t that ends there and is
   compatible with the last token of the prefix before t.  Two tokens are compatible if BPE leaves them
   apart when they stand side by side: no merge over the border comes up before the pieces that it would
   take are swallowed by their own tokens (:meth:`Merges.compatible`).
3. ``last`` holds that token for every prefix; following it back from the end gives the ids.

So a pre-token of n bytes takes n steps, however long it is; text without spaces is no worse.  Ids equal
those of the tokenizers library for the same file, and decoding gives the bytes back through the file's
byte alphabet, with U+FFFD for what is no UTF-8, as the library does.

Each distinct pre-token is encoded once a worker while its bounded store lasts.  Null texts count as
empty: no ids, the digests of the empty string.  A text of any length is handled in blocks of pre-tokens.
Null ids, repeated rows and rows of one id are encoded like any other, a row for a row; an empty table
gives no row; only doc_id and text are read, so other columns may have any name.  One narrow pass: no
shuffle, nothing is kept between tasks but the store.

Files that the method cannot follow are refused (:class:`UnsupportedTokenizer`): other models or
splitters, merges that make one token in two ways, added tokens that trim or normalise.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from riskloom.llm.common import text_chunks, texts
from riskloom.llm.words import text_bytes

#: Pre-tokens, and their ids, that a worker keeps; beyond either it forgets them all and begins anew.
KEEP_PARTS, KEEP_IDS = 800_000, 8_000_000
#: Compatibility answers that a worker keeps.
KEEP_PAIRS = 1_000_000
#: Bytes of text whose new pre-tokens are encoded in one walk.
WALK_BYTES = 4 << 20
#: Pre-tokens of a long text handled at a time.
BLOCK_PARTS = 1 << 16
#: Characters up to this one are of the same class in every version of Unicode that is in use.
SETTLED = "ԯ"
#: Texts of up to this many bytes, of settled characters only, are cut together, by array operations.
TOGETHER = 1 << 20

#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class UnsupportedTokenizer(ValueError):
    """The tokenizer file asks for something that this encoder does not do."""


def byte_alphabet() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: a printable byte's letter is itself, the
    others have, in order, the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b if b in plain else 256 + others.index(b)): b for b in range(256)}


class SuffixAutomaton:
    """All substrings of a set of byte strings; a whole string's state carries its number."""

    def __init__(self, strings: Iterable[tuple[int, bytes]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        named = []
        for number, string in strings:
            state = 0
            for letter in string:
                state = self._extend(state, letter)
            named.append((number, string))
        self.string = [-1] * len(self.next)
        for number, string in named:
            state = 0
            for letter in string:
                state = self.next[state][letter]
            self.string[state] = number
        # The nearest state up the links that carries a string; links lead to shorter lengths.
        self.up = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.up[state] = above if self.string[above] >= 0 else self.up[above]

    def _state(self, next_: dict[int, int], link: int, length: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, letter: int) -> int:
        """The state of the string of ``state`` and ``letter`` alone, apart from longer ones."""
        found = self.next[state][letter]
        if self.length[found] == self.length[state] + 1:
            return found
        part = self._state(dict(self.next[found]), self.link[found], self.length[state] + 1)
        self.link[found] = part
        while state >= 0 and self.next[state].get(letter) == found:
            self.next[state][letter] = part
            state = self.link[state]
        return part

    def _extend(self, state: int, letter: int) -> int:
        if letter in self.next[state]:
            return self._split(state, letter)
        new = self._state({}, 0, self.length[state] + 1)
        while state >= 0 and letter not in self.next[state]:
            self.next[state][letter] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, letter)
        return new


class Merges:
    """The merges of a vocabulary and which tokens they leave side by side."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        """``merges``: (left, right, merged token) in order of precedence."""
        self.rank = {(left, right): r for r, (left, right, _) in enumerate(merges)}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (left, right, token) in enumerate(merges):
            if token in self.made:
                raise UnsupportedTokenizer(f"token {token} is made by two merges")
            if max(self.made.get(left, (-1,))[0], self.made.get(right, (-1,))[0]) >= r:
                raise UnsupportedTokenizer(f"merge {r} comes before its parts")
            self.made[token] = (r, left, right)
        self.edges: dict[int, tuple[list, list]] = {}
        self.known: dict[int, bool] = {}  # by a << 32 | b

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces at a token's right (2) or left (1) end, smallest first, each with the rank of the
        merge that swallows it (infinity for the token itself)."""
        out, swallowed = [], float("inf")
        while True:
            out.append((token, swallowed))
            if token not in self.made:
                return out[::-1]
            swallowed = self.made[token][0]
            token = self.made[token][side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves ``a`` and ``b`` as they are when they stand side by side.  The pieces at
        the border are followed through time; a merge of two of them comes first unless one is swallowed
        before: on the left at the same rank too, as equal merges go from left to right."""
        left = self.edges.get(a) or self.edges.setdefault(a, (self._edge(a, 2), self._edge(a, 1)))
        right = self.edges.get(b) or self.edges.setdefault(b, (self._edge(b, 2), self._edge(b, 1)))
        answer = self._apart(left[0], right[1])
        if len(self.known) >= KEEP_PAIRS:
            self.known.clear()
        self.known[a << 32 | b] = answer
        return answer

    def _apart(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            merge = self.rank.get((x, y))
            if merge is not None and merge < x_until and merge <= y_until:
                return False
            if x_until <= y_until:
                i += 1
                if i == len(left):
                    return True
            else:
                j += 1


class ByteBpe:
    """Encodes and decodes with one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if model.get("type") != "BPE" or spec.get("normalizer") or {k: cut.get(k) for k in plain} != plain or (spec.get("decoder") or {}).get("type") != "ByteLevel":
            raise UnsupportedTokenizer(f"{path}: not a byte-level BPE with the usual pattern and no normaliser")
        if model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise UnsupportedTokenizer(f"{path}: dropout, prefixes, suffixes, whole words or byte fallback")
        letters = byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        if any(letter not in vocab for letter in letters):
            raise UnsupportedTokenizer(f"{path}: a byte without a token")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        made = {token: bytes(map(letters.__getitem__, token)) for token in vocab if len(token) == 1 or vocab[token] in self.merges.made}
        self.automaton = SuffixAutomaton((vocab[t], s) for t, s in made.items())
        self.bytes_of = {vocab[t]: s for t, s in made.items()}
        self.added = {}
        for token in spec.get("added_tokens", []):
            if token.get("single_word") or token.get("lstrip") or token.get("rstrip") or token.get("normalized"):
                raise UnsupportedTokenizer(f"{path}: added token {token['content']} trims or normalises")
            text = token["content"]
            self.added[text] = token["id"]
            self.bytes_of[token["id"]] = bytes(map(letters.__getitem__, text)) if all(c in letters for c in text) else text.encode()
        self.size_of = {t: len(b) for t, b in self.bytes_of.items()}
        by_length = sorted(self.added, key=len, reverse=True)
        self.stops = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        self.path, self.classes, self._library, self._bytes = path, {}, None, None
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)  # of slot i: ids[at[i]:at[i + 1]]

    def last_tokens(self, part: bytes) -> list[int]:
        """The last token of the encoding of every prefix of ``part`` (of 1, 2, ... bytes)."""
        return self.walk([part], lambda last, _: list(last))[0]

    def walk(self, parts: list[bytes], result: Callable[[list[int], int], list[int]]) -> list[list[int]]:
        """``result`` of the last tokens of each part's prefixes.  Parts that follow each other share what
        they have in common, so sorted ones cost little more than the tree of their prefixes."""
        auto, known, compatible = self.automaton, self.merges.known, self.merges.compatible
        next_, link, length, string, up = auto.next, auto.link, auto.length, auto.string, auto.up
        last: list[int] = []
        stops = [(0, 0)]  # the automaton's state and the length matched after each byte
        before, out = b"", []
        for part in parts:
            shared = 0
            for x, y in zip(before, part, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared:], stops[shared + 1 :]
            state, matched = stops[shared]
            for end in range(shared + 1, len(part) + 1):
                letter = part[end - 1]
                while letter not in next_[state]:
                    state = link[state]
                    matched = length[state]
                state = next_[state][letter]
                matched += 1
                at = state if matched == length[state] and string[state] >= 0 else up[state]
                while (start := end - length[at]) > 0:
                    pair = last[start - 1] << 32 | string[at]
                    if (apart := known.get(pair)) or (apart is None and compatible(last[start - 1], string[at])):
                        break
                    at = up[at]
                last.append(string[at])
                stops.append((state, matched))
            before = part
            out.append(result(last, len(part)))
        return out

    def _back(self, last: list[int], end: int) -> list[int]:
        """The ids, by the back-pointers of the prefixes."""
        size, out = self.size_of, []
        while end:
            token = last[end - 1]
            out.append(token)
            end -= size[token]
        out.reverse()
        return out

    def part_ids(self, part: bytes) -> list[int]:
        """The ids of one pre-token."""
        return self.walk([part], self._back)[0]

    def _library_cut(self, text: str) -> list[str]:
        if self._library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _disputed(self, text: str) -> bool:
        """Whether a character is of another class here than in the library's tables of Unicode."""
        for c in set(text):
            if c > SETTLED and c not in self.classes:
                probe = f"a{c}b {c}1{c}. {c}  {c}"
                self.classes[c] = PATTERN.findall(probe) != self._library_cut(probe)
        return any(c > SETTLED and self.classes[c] for c in set(text))

    def parts(self, text: str) -> Iterator[str | int]:
        """The pre-tokens of a text in order; an added token is its id."""
        for k, piece in enumerate(self.stops.split(text) if self.stops else [text]):
            if k % 2:
                yield self.added[piece]
            elif not piece.isascii() and self._disputed(piece):
                yield from self._library_cut(piece)
            elif len(piece) <= BLOCK_PARTS:
                yield from PATTERN.findall(piece)
            else:
                yield from (m.group() for m in PATTERN.finditer(piece))

    def _ready(self) -> None:
        """Room in the store, made by forgetting everything."""
        if len(self.slot) > KEEP_PARTS or self.at[len(self.slot)] > KEEP_IDS:
            self._forget()

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of parts by slot, in order, and where each part's end)."""
        sizes = self.at[slots + 1] - self.at[slots]
        to = np.cumsum(sizes)
        return self.ids[np.repeat(self.at[slots] - to + sizes, sizes) + np.arange(to[-1])], to

    def _learn(self, new: list[str | int]) -> None:
        words = sorted(p.encode() for p in new if not isinstance(p, int))
        ids = dict(zip(words, self.walk(words, self._back), strict=True))
        found = [[p] if isinstance(p, int) else ids[p.encode()] for p in new]
        n, used = len(self.slot), int(self.at[len(self.slot)])
        ends = used + np.cumsum([len(x) for x in found])
        while n + len(new) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[used : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1]) - used)
        self.at[n + 1 : n + 1 + len(new)] = ends
        self.slot.update(zip(new, range(n, n + len(new)), strict=True))

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, in blocks."""
        parts = self.parts(text)
        while block := list(islice(parts, BLOCK_PARTS)):
            self._ready()
            if new := [p for p in dict.fromkeys(block) if p not in self.slot]:
                self._learn(new)
            yield self._gather(np.fromiter(map(self.slot.__getitem__, block), np.int64, len(block)))[0]

    def encode_together(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offsets of the n + 1 texts) of a column of settled, non-null texts
        without added tokens: pre-tokens are cut by arrays and looked up once each."""
        data, at = text_bytes(column)
        if not data.size:
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        starts = part_starts(data, at)
        ends = np.append(starts, data.size).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())).dictionary_encode()
        parts = coded.dictionary.to_pylist()
        self._ready()
        if new := [p for p in parts if p not in self.slot]:
            self._learn(new)
        slots = np.fromiter(map(self.slot.__getitem__, parts), np.int64, len(parts))
        ids, to = self._gather(slots[coded.indices.to_numpy()])
        return ids, np.append(0, to)[np.searchsorted(starts, at)]

    def apart(self, column: pa.Array) -> np.ndarray:
        """Which texts :meth:`encode_together` must not be given."""
        texts = column.fill_null("") if column.null_count else column
        long = pc.greater(pc.binary_length(texts), TOGETHER).to_numpy(zero_copy_only=False)
        other = pc.match_substring_regex(texts, f"[^\\x00-{SETTLED}]").to_numpy(zero_copy_only=False)
        for token in self.added:
            other = other | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        return long | other

    def token_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes of ids in order, where each one's end)."""
        if self._bytes is None:
            size = max(self.bytes_of) + 1
            all_ = [self.bytes_of.get(t, b"") for t in range(size)]
            self._bytes = np.frombuffer(b"".join(all_), np.uint8), np.append(0, np.cumsum([len(x) for x in all_]))
        data, at = self._bytes
        sizes = at[ids.astype(np.int64) + 1] - at[ids]
        to = np.cumsum(sizes)
        return data[np.repeat(at[ids] - to + sizes, sizes) + np.arange(to[-1] if len(to) else 0)], to

    def decode(self, blocks: Iterable[np.ndarray]) -> Iterator[str]:
        """The text of ids given in blocks, in as many pieces."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in blocks:
            yield reader.decode(b"".join(map(self.bytes_of.__getitem__, ids.tolist())))
        yield reader.decode(b"", True)


_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def _classes() -> np.ndarray:
    """The class of every settled character in the pattern."""
    out = np.full(ord(SETTLED) + 1, _OTHER, np.uint8)
    for name, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        own = regex.compile(pattern)
        out[[c for c in range(len(out)) if own.match(chr(c))]] = name
    return out


_CLASS = _classes()


def part_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts begin, as byte places: ``data`` is their UTF-8, of one or two bytes
    a character, ``at`` their n + 1 offsets.  It is the pattern's cut, read off the classes of characters:
    a run of letters, numbers or others is a part, with the one blank before it; white space before other
    text gives up its last character, which is a part of its own unless it is that blank; an apostrophe
    that begins a part takes s, t, re, ve, m, ll or d with it."""
    place = np.flatnonzero((data & 0xC0) != 0x80)  # of the characters' first bytes
    first = data[place].astype(np.int32)
    second = data[np.minimum(place + 1, data.size - 1)]
    char = np.where(first < 0x80, first, (first & 0x1F) << 6 | (second & 0x3F))
    kind = _CLASS[char]
    n = len(char)
    text_start = np.zeros(n + 1, bool)
    text_start[np.searchsorted(place, at)] = True
    space = kind == _SPACE
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | text_start[1:n]
    # The last white-space character before other text of the same text leaves its run.
    leaves = space.copy()
    leaves[-1] = False
    leaves[:-1] &= ~space[1:] & ~text_start[1:n]
    blank = leaves & (char == 32)
    start = change | leaves
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    start &= ~after_blank
    # Contractions: an apostrophe that begins a part and is followed by letters.
    for quote in np.flatnonzero(start & (char == 39)):
        tail = char[quote + 1 : quote + 3].tolist()
        if not tail or text_start[quote + 1]:
            continue
        size = 1 if chr(tail[0]) in "stmd" else 2 if len(tail) == 2 and not text_start[quote + 2] and chr(tail[0]) + chr(tail[1]) in ("re", "ve", "ll") else 0
        if size:
            start[quote + 1] = False
            end = quote + 1 + size
            if end < n and kind[end] == _LETTER and not text_start[end]:
                start[end] = True
    return place[start]


_ENCODERS: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, tokenizer: str, *, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, ids (array of int) of every row of ``docs``."""

    def run(batches):
        own = encoder(tokenizer)
        for batch in batches:
            for chunk in text_chunks(batch):
                rows = [np.concatenate([np.zeros(0, np.uint32), *own.encode(t or "")]).astype(np.int32) for t in chunk.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(ids: DataFrame, tokenizer: str, *, id_col="doc_id", ids_col="ids") -> DataFrame:
    """doc_id, text of rows of ids (null ids: empty)."""

    def run(batches):
        own = encoder(tokenizer)
        for batch in batches:
            rows = ["".join(own.decode([np.asarray(x or [], np.int64)])) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.string())], names=["doc_id", "text"])

    return ids.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{ids_col}` as ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str, *, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers), decoded_sha256 (of the
    decoded text) and same_text (whether it is the text) of every row, encoded and decoded in one pass
    without the ids leaving their task."""

    def alone(own: ByteBpe, text: str) -> tuple[int, str, str, bool]:
        count, ids_hash, text_hash, size = 0, hashlib.sha256(), hashlib.sha256(), 0

        def counted():
            nonlocal count
            for ids in own.encode(text):
                count += len(ids)
                ids_hash.update(ids.astype("<u4").tobytes())
                yield ids

        same = True
        for piece in own.decode(counted()):
            same = same and text.startswith(piece, size)
            size += len(piece)
            text_hash.update(piece.encode())
        return count, ids_hash.hexdigest(), text_hash.hexdigest(), same and size == len(text)

    def together(own: ByteBpe, column: pa.Array) -> list[tuple[int, str, str, bool]]:
        ids, at = own.encode_together(column)
        raw, ends = own.token_bytes(ids)
        data, data_at = text_bytes(column)
        ids, byte_at = ids.astype("<u4"), np.append(0, ends)[at]
        out = []
        for k in range(len(column)):
            back = raw[byte_at[k] : byte_at[k + 1]].tobytes()
            text = back.decode("utf-8", "replace").encode()
            same = text == data[data_at[k] : data_at[k + 1]].tobytes()
            out.append((int(at[k + 1] - at[k]), hashlib.sha256(ids[at[k] : at[k + 1]]).hexdigest(), hashlib.sha256(text).hexdigest(), same))
        return out

    def run(batches):
        own = encoder(tokenizer)
        for batch in batches:
            for chunk in text_chunks(batch, limit=WALK_BYTES):
                column = chunk.column("text").fill_null("")
                apart = own.apart(column)
                rows = iter(together(own, column.filter(pa.array(~apart))))
                rows = [alone(own, column[k].as_py()) if odd else next(rows) for k, odd in enumerate(apart)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same_text"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same_text boolean")
