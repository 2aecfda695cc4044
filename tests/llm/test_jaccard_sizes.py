"""What the near-duplicate search moves: whole sets of linked points only, short names in the cell rows."""

import numpy as np
import pyarrow as pa
import pytest
from odd import frame, prose
from test_jaccard import brute, chains, near_copies

from riskloom.llm import jaccard as jc


def family(n, shared, own):
    """Long texts that share a good part, far from linked."""
    common = prose(70, shared).split()
    return [" ".join(common + [f"o{i}x{k}" for k in range(own)]) for i in range(n)]


def test_large_sets_that_are_not_linked_are_not_moved_whole(spark, monkeypatch):
    far = family(12, 1800, 1200)
    near = list(near_copies(71, 2, 900, 4))
    data = list(enumerate([*far, *near]))
    moved, column = [], jc.Sets.column

    def seen(self, nodes, what, of):
        if what == "hashes":
            moved.extend(r[0] for r in nodes.distinct().collect())
        return column(self, nodes, what, of)

    monkeypatch.setattr(jc.Sets, "column", seen)
    got = jc.jaccard_components(frame(spark, data), 5, 80).collect()
    assert sorted(map(tuple, got)) == sorted(brute(data, 5, 80))
    assert set(moved) == {12, 13}


@pytest.mark.parametrize("points,counts", [(2, 1 << 22), (2, 1 << 10), (4096, 1 << 10)])
def test_sets_of_unlike_sizes_in_one_bundle_equal_brute_force(spark, monkeypatch, points, counts):
    monkeypatch.setattr(jc, "BUNDLE_POINTS", points)
    monkeypatch.setattr(jc, "BUNDLE_COUNTS", counts)
    monkeypatch.setattr(jc, "CELL_POINTS", 5)
    texts = [*near_copies(72, 12, 560, 25), *near_copies(73, 8, 1100, 60), *chains(3, 9), *family(5, 500, 200)]
    texts += [" ".join(t.split()[: 450 + 20 * i]) for i, t in enumerate(near_copies(72, 8, 560, 3))]
    data = list(enumerate(texts))
    got = jc.jaccard_components(frame(spark, data), 5, 80).collect()
    assert sorted(map(tuple, got)) == sorted(brute(data, 5, 80))


@pytest.mark.parametrize("bits", [1, 3])
def test_sets_of_one_short_name_are_still_linked(spark, monkeypatch, bits):
    monkeypatch.setattr(jc, "NAME_BITS", bits)
    data = list(enumerate([*near_copies(74, 15, 90, 5), *near_copies(75, 10, 30, 1), *chains(4, 8), *near_copies(74, 3, 90, 0)]))
    got = jc.jaccard_components(frame(spark, data), 5, 80).collect()
    assert sorted(map(tuple, got)) == sorted(brute(data, 5, 80))


def test_vectors_of_unlike_sizes_fold_to_the_same_counts():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (3, 400, 600, 5000, 300_000)]
    groups = [jc.groups_of(len(s)) for s in sets]
    assert groups == [128, 128, 256, 2048, jc.MOST_GROUPS]
    packed = pa.array([jc.count_vector(s, g).tobytes() for s, g in zip(sets, groups, strict=True)])
    folded = jc.count_vectors(packed)
    assert folded.shape == (5, 128) and all((folded[i] == jc.group_counts(s, 128)).all() for i, s in enumerate(sets))
