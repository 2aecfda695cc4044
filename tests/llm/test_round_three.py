"""What one task holds: words with stops and capitals, count vectors of a bundle."""

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import jaccard as J


def test_a_run_of_letters_is_merged_once_for_all_its_cases_and_stops():
    tokens = pytest.importorskip("public_tokenizers")
    from riskloom.llm.tokens import WordEncoder

    e = WordEncoder(tokens.path("word_bpe_49k.json"))
    rows = ["Mountain mountain. MOUNTAIN, mountain.,", None, "été Été. mountain"]
    ids, at = e.encode(pa.array(rows))
    for row, a, b in zip(rows, at[:-1], at[1:], strict=True):
        assert list(ids[a:b]) == e.tokenizer.encode(row or "", add_special_tokens=False).ids
    assert len(e.heads) == 2


def test_the_heads_kept_are_bounded(monkeypatch):
    tokens = pytest.importorskip("public_tokenizers")
    from riskloom.llm import tokens as own

    monkeypatch.setattr(own, "KEEP_HEADS", 3)
    e = own.WordEncoder(tokens.path("word_bpe_49k.json"))
    text = "one two three four five six one. two. three."
    assert list(e.encode(pa.array([text]))[0]) == e.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(e.heads) <= 3


def test_a_bundles_count_vectors_are_bounded(monkeypatch):
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64)) for _ in range(12)]
    sets = [np.delete(x, rng.integers(0, len(x), 5)) for x in base for _ in range(5)]
    threshold, part = J.Threshold(80), np.arange(len(sets))
    sizes, plain = [], J.CountTree
    monkeypatch.setattr(J, "CountTree", lambda counts, size: sizes.append(counts.size) or plain(counts, size))
    want = J.spanning_links(part, sets, threshold)
    monkeypatch.setattr(J, "BUNDLE_COUNTS", 20_000)
    got = J.spanning_links(part, sets, threshold)
    assert got == want and len(want) == 48
    assert sizes[0] > 20_000 >= sizes[1]


def test_parts_forgotten_are_learned_again(monkeypatch):
    tokens = pytest.importorskip("public_tokenizers")
    from riskloom.llm import tokens as own

    monkeypatch.setattr(own, "KEEP_PARTS", 4)
    e = own.WordEncoder(tokens.path("word_bpe_49k.json"))
    for text in ("one two three", "two three four", "five six seven one", "a b c d e f a", "one two a $$ 12"):
        ids, at = e.encode(pa.array([text, "two"]))
        assert list(ids[: at[1]]) == e.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(ids[at[1] :]) == e.tokenizer.encode("two", add_special_tokens=False).ids
