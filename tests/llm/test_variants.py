"""Spelling variants: against comparing all words with each other."""

import random
from collections import Counter
from zlib import crc32

import pytest
import regex
from odd import empty, frame, rows

from riskloom.llm.variants import chain_ends, near_pairs, spelling_variants, variant_groups, word_counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def plain_counts(data, min_length, min_count, corrupted):
    found = Counter()
    for key, text in data:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if corrupted and h % corrupted == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_length and n >= min_count}


def words_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def vocabulary(seed, n, letters="abé", low=3, high=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))): rng.randint(1, 40) for _ in range(n)}


@pytest.mark.parametrize("key_pairs", [100_000, 30, 1])
def test_groups_equal_all_pairs_also_when_every_key_is_refined(spark, key_pairs):
    counts = vocabulary(1, 250) | vocabulary(2, 100, "xyzÀÿ÷", 5, 12) | {"nation": 90, "nations": 7, "nation" + "al": 5, "natiom": 90, "mation": 2}
    got = variant_groups(words_frame(spark, counts), key_pairs=key_pairs)
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == plain(counts)


def test_a_common_ending_is_split_and_not_joined_all_with_all(spark):
    """Words of one length with one last half: one key; after the split few candidates are left."""
    rng = random.Random(4)
    counts = {"".join(rng.choice("abcdefghij") for _ in range(6)) + "ations": 3 for _ in range(600)}
    got = {tuple(sorted(r)) for r in near_pairs(words_frame(spark, counts).select("word"), 1000).collect()}
    words = sorted(counts)
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}


def test_ties_and_chains(spark):
    counts = {"abcde": 3, "abcdx": 6, "abcdy": 6, "abczx": 12, "abwzx": 24, "lonely": 9}
    got = {r["word"]: r for r in variant_groups(words_frame(spark, counts)).collect()}
    assert got["abcde"]["form"] == "abcdx" and got["abcde"]["root"] == "abwzx" and got["abcde"]["n_near"] == 2
    assert got["lonely"]["form"] is None and got["lonely"]["root"] == "lonely" and got["lonely"]["n_near"] == 0
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)], "word string, form string")
    assert {r["root"] for r in chain_ends(chain).collect()} == {"w37"}


def test_counts_of_odd_rows(spark):
    data = rows() + [(3, "ABCDE abcde Abcdé x" * 5), (None, "Été été ÉTÉS étés abcde abcde ")] * 2
    for corrupted in (None, 3, 97):
        got = {r["word"]: r["n"] for r in word_counts(frame(spark, data), 2, 1, corrupted=corrupted).collect()}
        assert got == plain_counts(data, 2, 1, corrupted)
    assert spelling_variants(empty(spark)).count() == 0


def test_long_texts_are_read_a_run_at_a_time(spark, monkeypatch):
    text = "wording lettre " * 80_000
    got = {r["word"]: r["n"] for r in word_counts(frame(spark, [(1, text)]), 5, 3, corrupted=97).collect()}
    assert got == plain_counts([(1, text)], 5, 3, 97)


def test_bounds_are_refused(spark):
    with pytest.raises(ValueError):
        variant_groups(words_frame(spark, {"ab": 1}))
    with pytest.raises(ValueError):
        variant_groups(words_frame(spark, {"abcd": 1}), ratio=1)
