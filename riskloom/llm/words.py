"""Word and shingle hashes of whole Arrow text columns, vectorised over the bytes.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; A-Z count as a-z.  A word of up
to ``SHORT`` bytes is hashed by a multilinear hash (each byte times the 64-bit constant of its place,
summed, mixed), longer ones by blake2b: either way the hash depends on the word alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

SHORT = 256
_RNG = np.random.default_rng(20240607)
_PLACE = _RNG.integers(0, 2**63, SHORT, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1 texts) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, offsets of the n + 1 texts into them)."""
    raw, at = text_bytes(column)
    if not raw.size:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    inside = ~_SPACE[raw]
    edge = np.zeros(raw.size + 1, bool)
    edge[at] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not starts.size:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    lens = ends - starts
    low = _LOWER[raw]
    short = np.minimum(lens, SHORT)
    total = int(short.sum())
    seg = np.cumsum(short) - short
    place = np.arange(total) - np.repeat(seg, short)
    value = low[place + np.repeat(starts, short)].astype(np.uint64) + np.uint64(1)
    value *= _PLACE[place]
    out = mix(np.add.reduceat(value, seg) + lens.astype(np.uint64) * _STEP[15])
    for k in np.flatnonzero(lens > SHORT):
        out[k] = int.from_bytes(hashlib.blake2b(low[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out, np.searchsorted(starts, at)


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int, whole_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-word shingle of all texts in order, offsets).  A text of 1 to k - 1 words has
    its whole sequence as its one shingle if ``whole_short``, else none."""
    n = np.diff(at)
    many = np.maximum(n - k + 1, 0)
    if whole_short:
        many = np.where((n > 0) & (n < k), 1, many)
    to = np.concatenate([[0], np.cumsum(many)])
    if not to[-1]:
        return np.zeros(0, np.uint64), to
    first = np.arange(to[-1]) - np.repeat(to[:-1], many) + np.repeat(at[:-1], many)
    size = np.minimum(np.repeat(n, many), k)
    out = size.astype(np.uint64) * _STEP[14]
    for j in range(k):
        use = size > j
        out = out + np.where(use, words[np.where(use, first + j, 0)], np.uint64(0)) * _STEP[j]
    return mix(out), to


def shingle_sets(column: pa.Array, k: int, whole_short: bool) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, at = word_hashes(column)
    hashes, to = shingle_hashes(words, at, k, whole_short)
    return [np.unique(hashes[a:b]) for a, b in zip(to[:-1], to[1:], strict=True)]
