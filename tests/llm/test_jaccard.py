import random
import re

import numpy as np
import pyarrow as pa
import pytest
from odd import empty, frame, prose, rows

from riskloom.llm import jaccard as jc
from riskloom.llm.components import components


def sets_of(data, k):
    out = []
    for key, text in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        out.append((key, frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()))
    return out


def brute(data, k, percent):
    """(doc_id, set size, smallest doc_id reachable) of every row."""
    sets = sets_of(data, k)
    parent = {key: key for key, _ in sets if key is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(key, len(s), find(key) if key is not None else None) for key, s in sets]


def near_copies(seed, n, base_words, edits):
    rng = random.Random(seed)
    base = prose(seed, base_words).split()
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        yield " ".join(words)


def corpus():
    texts = [*near_copies(1, 25, 200, 6), *near_copies(2, 25, 60, 2), *near_copies(3, 15, 12, 1), *near_copies(4, 10, 2500, 60), *near_copies(5, 20, 7, 1)]
    shared = prose(99, 60)  # a passage that many documents share
    texts += [prose(1000 + i, 40) + " " + shared + " " + prose(2000 + i, 40) for i in range(40)]
    texts += [prose(5000 + i, 5) for i in range(30)]
    random.Random(0).shuffle(texts)
    return [*rows(), *((500 + i, t) for i, t in enumerate(texts)), (500, "another text of the first id, quite apart from it"), (9, None)]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    data = corpus()
    got = jc.jaccard_components(frame(spark, data), k, percent).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(brute(data, k, percent), key=key)


def chains(seed, n):
    """Texts of which each is linked with the next only, and families that are near but not linked."""
    words = [f"w{seed}x{i}" for i in range(60)]
    for i in range(n):
        yield " ".join(words[3 * i % 30 :] + [f"v{seed}x{i}x{k}" for k in range(3 * i % 30)])
    for i in range(n):
        yield " ".join(words[:40] + [f"u{seed}x{i}x{k}" for k in range(5)])


@pytest.mark.parametrize("points", [1, 4, 4096])
def test_bundles_of_any_size_equal_brute_force(spark, monkeypatch, points):
    monkeypatch.setattr(jc, "BUNDLE_POINTS", points)
    data = [(i, t) for i, t in enumerate([*near_copies(17, 25, 80, 9), *near_copies(18, 20, 40, 5), *chains(1, 12), *chains(2, 9)])]
    got = jc.jaccard_components(frame(spark, data), 5, 80)
    assert sorted(map(tuple, got.collect())) == sorted(brute(data, 5, 80))


def test_a_bundle_puts_out_no_more_links_than_join_its_parts():
    rng = random.Random(3)
    words = [t.split() for t in near_copies(21, 60, 100, 4)] + [t.split() for t in near_copies(22, 60, 100, 4)]
    sets = [np.unique(np.array([hash(tuple(w[i : i + 5])) & (2**64 - 1) for i in range(len(w) - 4)], np.uint64)) for w in words]
    part = np.array([rng.randrange(100) for _ in sets])
    links = jc.spanning_links(part, sets, jc.Threshold(80))
    joined = {p: p for p in set(part.tolist())}

    def root(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for i, j in links:
        assert jc.Threshold(80).linked(np.intersect1d(sets[i], sets[j]).size, len(sets[i]), len(sets[j])) and root(part[i]) != root(part[j])
        joined[root(part[i])] = root(part[j])
    for i in range(len(sets)):
        for j in range(i):
            if jc.Threshold(80).linked(np.intersect1d(sets[i], sets[j]).size, len(sets[i]), len(sets[j])):
                assert root(part[i]) == root(part[j])


def test_split_cells_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(jc, "CELL_POINTS", 3)
    monkeypatch.setattr(jc, "BUNDLE_POINTS", 2)
    data = [(i, t) for i, t in enumerate([*near_copies(7, 14, 30, 3), *near_copies(8, 14, 10, 1)])]
    got = jc.jaccard_components(frame(spark, data), 3, 90).collect()
    assert sorted(map(tuple, got)) == sorted(brute(data, 3, 90))
    assert jc.jaccard_components(empty(spark), 3, 90).count() == 0


def test_stage_keeps_one_of_each(spark):
    data = [r for r in corpus() if r[0] is not None]
    kept = jc.keep_one(frame(spark, data), 5, 80)
    assert kept.columns == frame(spark, data).columns
    dropped = {k for k, _, c in brute(data, 5, 80) if c != k}
    assert sorted(r[0] for r in kept.collect()) == sorted(k for k, _ in data if k not in dropped)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_cell_and_are_found_by_the_tree(percent):
    rng = np.random.default_rng(percent)
    threshold = jc.Threshold(percent)
    sets, links = [], 0
    for _ in range(400):
        size = int(rng.integers(1, 300))
        base = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
        other = base[rng.random(size) > rng.random() * 0.15]
        other = np.concatenate([other, rng.integers(0, 2**63, int(rng.integers(0, max(2, size // 10))), dtype=np.uint64)])
        sets.append((np.unique(base), np.unique(other)))
    vectors = jc.count_vectors(pa.array([jc.count_vector(b).tobytes() for _, b in sets]))
    tree = jc.CountTree(vectors, np.array([b.size for _, b in sets]))
    for i, (a, b) in enumerate(sets):
        if b.size and threshold.linked(np.intersect1d(a, b).size, a.size, b.size):
            links += 1
            assert np.intersect1d(jc.cell_keys(a, threshold), jc.cell_keys(b, threshold)).size
            assert i in tree.search(jc.count_vectors(pa.array([jc.count_vector(a).tobytes()]))[0], a.size, percent)
    assert links > 50


def test_classes_of_linked_sizes_meet():
    for percent in (80, 90):
        t = jc.Threshold(percent)
        for size in range(1, 400):
            assert t.first_of_class(t.class_of(size)) <= size < t.first_of_class(t.class_of(size) + 1)
            assert t.classes(size)[-1] == t.class_of(size)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 199)]
    random.Random(1).shuffle(chain)
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 61)}, **{100 + i: 100 for i in range(50)}, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_full_counts_bound_nothing():
    many = np.arange(60_000, dtype=np.uint64) * np.uint64(2654435761) << np.uint64(20)
    packed = jc.count_vector(many)
    assert packed.max() == jc.FULL and jc.count_vectors(pa.array([packed.tobytes()])).min() >= 255
    tree = jc.CountTree(jc.count_vectors(pa.array([packed.tobytes()])), np.array([len(many)]))
    assert tree.search(jc.count_vectors(pa.array([packed.tobytes()]))[0], len(many), 90).tolist() == [0]
