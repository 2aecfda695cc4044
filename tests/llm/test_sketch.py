import hashlib

import numpy as np
import pyarrow as pa
from odd import empty, frame, prose, rows

from riskloom.llm import sketch as sk
from riskloom.llm.words import shingle_sets


def own(text, scale=sk.SCALE):
    return sk.sketch(shingle_sets(pa.array([text or ""]), sk.WORDS, True)[0], scale)


def test_rows_equal_brute_force(spark):
    data = [r for r in rows() if r[0] is not None]
    data = [*dict(data).items()]  # one row an id, so that the order is definite
    got = {r["doc_id"]: r for r in sk.fingerprints(frame(spark, data, 5)).collect()}
    order = sorted(data, key=lambda r: -r[0])
    assert len(got) == len(order)
    for (key, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following, r = text or "", following or "", got[key]
        edit = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        assert r["fingerprint"] == sk.as_string(own(text)) and r["edited_fingerprint"] == sk.as_string(own(edit))
        assert (r["near_edited"], r["contained_edited"]) == sk.likeness(own(text), own(edit))
        assert (r["near_next"], r["contained_next"]) == sk.likeness(own(text), own(following))


def test_odd_rows(spark):
    got = sk.fingerprints(frame(spark)).collect()
    assert len(got) == len(rows()) and sum(r["doc_id"] is None for r in got) == 2
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert sk.fingerprints(empty(spark)).count() == 0
    (only,) = sk.fingerprints(frame(spark, [(1, "a b c")], 1)).collect()
    assert only["near_next"] == 1.0


def test_merge_and_estimates():
    a, b = prose(1, 3000), prose(2, 200)
    (x, y, both) = shingle_sets(pa.array([a, b, a + " " + b]), sk.WORDS, True)
    merged = sk.merge(sk.sketch(x), sk.sketch(y))
    assert np.array_equal(merged, sk.sketch(np.union1d(x, y)))
    near, part = sk.likeness(sk.sketch(y), sk.sketch(both))
    assert part > 0.85 and near < 0.2  # a short document inside a long one
    assert np.array_equal(sk.from_string(sk.as_string(merged)), merged)
    assert sk.likeness(sk.sketch(x[:0]), sk.sketch(x)) == (0.0, 0.0)
