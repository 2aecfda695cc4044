import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.knn import knn_join, knn_predict, knn_vote, majority_vote


def _brute(q, r, k, exclude_self=False):
    out = {}
    for qi, qv in q.items():
        ds = []
        for ri, rv in r.items():
            if exclude_self and qi == ri:
                continue
            d2 = 0.0
            for a, b in zip(qv, rv):
                d2 += (a - b) * (a - b)
            ds.append((round(float(np.sqrt(d2)), 9), ri))
        out[qi] = [ri for _, ri in sorted(ds)[:k]]
    return out


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    # integer grid coordinates force many exact distance ties
    pts = {i: [float(x) for x in rng.integers(0, 4, size=3)] for i in range(300)}
    df = spark.createDataFrame([(i, i % 2 + 1, *v) for i, v in pts.items()], "id long, class int, x double, y double, z double")
    return pts, df


@pytest.mark.parametrize("strategy", ["broadcast", "cells"])
def test_knn_matches_brute_force_with_ties(spark, points, strategy):
    pts, df = points
    q = df.where("id < 120")
    r = df.where("id >= 120")
    kw = {} if strategy == "broadcast" else {"broadcast_max_bytes": 0, "block_rows": 40}
    nn = knn_join(q, r, 5, ["x", "y", "z"], "id", "id", **kw).collect()
    got = {}
    for row in sorted(nn, key=lambda x: (x["query_id"], x["rank"])):
        got.setdefault(row["query_id"], []).append(row["ref_id"])
    want = _brute({i: v for i, v in pts.items() if i < 120}, {i: v for i, v in pts.items() if i >= 120}, 5)
    assert got == want


@pytest.mark.parametrize("strategy", ["broadcast", "cells"])
def test_knn_self_join_within_group(spark, points, strategy):
    pts, df = points
    kw = {} if strategy == "broadcast" else {"broadcast_max_bytes": 0, "block_rows": 64}
    nn = knn_join(df, df, 3, ["x", "y", "z"], "id", "id", within="class", exclude_self=True, carry="class", **kw)
    rows = nn.collect()
    assert len(rows) == 300 * 3
    for row in rows:
        assert row["query_id"] != row["ref_id"]
        assert row["class"] == row["query_id"] % 2 + 1
    by_class = {}
    for c in (1, 2):
        sub = {i: v for i, v in pts.items() if i % 2 + 1 == c}
        by_class.update(_brute(sub, sub, 3, exclude_self=True))
    got = {}
    for row in sorted(rows, key=lambda x: (x["query_id"], x["rank"])):
        got.setdefault(row["query_id"], []).append(row["ref_id"])
    assert got == by_class


def test_majority_vote_tie_goes_to_smaller_label(spark):
    nb = spark.createDataFrame(
        [(1, 1, 2), (1, 2, 1), (2, 1, 2), (2, 2, 2), (2, 3, 1), (3, 1, 3)], "query_id long, rank int, class int"
    )
    out = {r["query_id"]: r["prediction"] for r in majority_vote(nb, "class").collect()}
    assert out == {1: 1, 2: 2, 3: 3}


def test_knn_array_features(spark):
    rows = [(i, [float(i), 0.0], i % 2 + 1) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, v array<double>, class int")
    pred = {r["id"]: r["prediction"] for r in knn_predict(df.where("id >= 10"), df.where("id < 10"), 1, ["v"], "id", "class").collect()}
    assert pred == {i: 1 for i in range(10)}  # nearest train row is id 10 (class 1)


def test_topk_block_exclude_self_small_blocks():
    from riskloom.operators.knn import _topk_block

    q_ids = np.array([1, 2])
    Q = np.array([[0.0], [5.0]])
    # block without the query ids: all 2 rows must come back for k=5
    qi, ri, di, rank = _topk_block(q_ids, Q, np.array([10, 11]), np.array([[1.0], [2.0]]), 5, 9, True)
    assert len(qi) == 4
    # block containing query 1 itself: it is skipped, the other row kept
    qi, ri, di, rank = _topk_block(q_ids[:1], Q[:1], np.array([1, 11]), np.array([[0.0], [2.0]]), 5, 9, True)
    assert list(ri) == [1] and list(di) == [2.0]


CELLS = {"broadcast_max_bytes": 0, "block_rows": 30}


@pytest.mark.parametrize("kw", [{}, CELLS])
def test_votes_of_all_k_equal_the_votes_of_the_neighbours(spark, points, kw):
    pts, df = points
    test, train = df.where("id < 120"), df.where("id >= 120")
    got = {r["id"]: r for r in knn_vote(train, test, [1, 3, 5], ["x", "y", "z"], "id", "class", keep=["class", "x"], **kw).collect()}
    nn = knn_join(test, train, 5, ["x", "y", "z"], "id", "id", carry="class")
    for k in (1, 3, 5):
        want = {r["query_id"]: r["prediction"] for r in majority_vote(nn.where(F.col("rank") <= k), "class").collect()}
        assert {i: r[f"prediction_{k}"] for i, r in got.items()} == want
    assert all(r["class"] == i % 2 + 1 and r["x"] == pts[i][0] for i, r in got.items())


def test_cells_of_clustered_and_lonely_points(spark):
    """Clusters far apart, fewer rows than k in some cells, a cell cut into blocks."""
    rng = np.random.default_rng(4)
    pts = {i: [float(x) for x in rng.normal(size=2) + 100 * (i % 4)] for i in range(400)} | {400: [5000.0, 5000.0], 401: [-5000.0, 0.0]}
    df = spark.createDataFrame([(i, *v) for i, v in pts.items()], "id long, x double, y double").repartition(3)
    rows = knn_join(df, df, 6, ["x", "y"], "id", "id", exclude_self=True, **CELLS).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["ref_id"])
    assert got == _brute(pts, pts, 6, exclude_self=True)
    few = knn_join(df.where("id < 3"), df.where("id in (0, 400)"), 6, ["x", "y"], "id", "id", **CELLS)
    assert few.count() == 6


@pytest.mark.parametrize("kw", [{}, CELLS])
def test_missing_features_follow_the_policy(spark, kw):
    df = spark.createDataFrame([(1, 1, 0.0), (2, 2, None), (3, 2, 5.0), (4, 1, float("nan"))], "id long, class int, x double")
    with pytest.raises(ValueError, match="x"):
        knn_predict(df, df, 1, ["x"], "id", "class", **kw)
    with pytest.raises(ValueError, match="x"):
        knn_join(df, df.where("id = 1"), 1, ["x"], "id", "id", **kw)
    assert sorted(r[0] for r in knn_predict(df, df, 1, ["x"], "id", "class", nulls="skip", **kw).collect()) == [1, 3]


@pytest.mark.parametrize("kw", [{}, CELLS])
def test_for_a_query_row_without_a_feature_the_smallest_ids_vote(spark, kw):
    train = spark.createDataFrame([(5, 1, 0.0, 0.0), (2, 2, 9.0, 9.0), (-3, 1, 8.0, 8.0), (7, 2, 1.0, 1.0), (9, 2, 2.0, 2.0)], "id long, class int, x double, y double")
    rows = [(1, 0.4, 0.4, "a"), (2, None, 1.0, "b"), (3, 1.0, float("nan"), None), (4, None, None, "d"), (5, 8.2, 8.2, "e")]
    test = spark.createDataFrame(rows, "id long, x double, y double, t string")
    voted = knn_vote(train, test, [1, 2, 5], ["x", "y"], "id", "class", keep=["t"], query_nulls="keep", **kw)
    assert sorted(map(tuple, voted.collect())) == [
        (1, "a", 1, 1, 2), (2, "b", 1, 1, 2), (3, None, 1, 1, 2), (4, "d", 1, 1, 2), (5, "e", 1, 1, 2)]
    far = train.where("id > 0")  # now the smallest id is of class 2
    assert sorted(map(tuple, knn_predict(far, test, 1, ["x", "y"], "id", "class", query_nulls="keep", **kw).collect())) == [(1, 1), (2, 2), (3, 2), (4, 2), (5, 2)]
    assert knn_predict(train.limit(0), test, 1, ["x", "y"], "id", "class", query_nulls="keep").count() == 0
    with pytest.raises(ValueError, match="x"):  # the training rows have their own policy
        knn_predict(test.withColumn("class", F.lit(1)), test, 1, ["x", "y"], "id", "class", query_nulls="keep", **kw)


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, 1, 0.0)], "id long, class int, x double")
    assert knn_predict(df.limit(0), df, 1, ["x"], "id", "class").count() == 0


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("features", [1, 3, 6])
def test_a_tree_finds_what_all_distances_find(features, exclude_self, monkeypatch):
    from riskloom.operators import knn as K

    rng = np.random.default_rng(features)
    R = np.round(rng.normal(size=(3000, features)) * [3, 1, 1, 1, 1, 1][:features], 1)  # ties and copies
    R[::3] = R[0]  # a thousand copies
    ids = np.sort(rng.choice(5000, 3000))  # some ids repeat
    Q, q_ids = np.vstack([R[::5], rng.normal(size=(400, features)) * 9]), np.r_[ids[::5], np.arange(9000, 9400)]
    tree = K._tree(ids, R, 5)
    met, plain = [], tree._met
    monkeypatch.setattr(tree, "_met", lambda q, *a: met.append(len(q)) or plain(q, *a))
    got = K._topk_block(q_ids, Q, ids, R, 5, 9, exclude_self, tree)
    want = K._topk_block(q_ids, Q, ids, R, 5, 9, exclude_self)
    assert all((a == b).all() for a, b in zip((ids[got[1]], *got[::2], got[3]), (ids[want[1]], *want[::2], want[3]), strict=True))
    assert sum(met) * tree.width < len(Q) * len(R) / 3  # far from all pairs


def test_a_tree_needs_few_finite_features_and_many_rows():
    from riskloom.operators import knn as K

    R = np.random.default_rng(1).normal(size=(K.TREE_ROWS, 2))
    assert K._tree(np.arange(len(R)), R, 3) is not None
    assert K._tree(np.arange(len(R) - 1), R[1:], 3) is None
    assert K._tree(np.arange(len(R)), np.where(R == R[5], np.nan, R), 3) is None
    assert K._tree(np.arange(len(R)), np.zeros((len(R), K.TREE_FEATURES + 1)), 3) is None


def test_rows_are_routed_in_bounded_pieces(spark, monkeypatch):
    """A query row that reaches every cell becomes many rows; a task holds few of them at a time."""
    from riskloom.operators import knn as K

    seen = []
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rng.normal(size=(900, 24)))], "id long, v array<double>")
    monkeypatch.setattr(K, "ROUTED", 64)
    plain = type(df).mapInPandas

    def counted(self, fn, schema, *a, **kw):
        if "_block" not in schema:
            return plain(self, fn, schema, *a, **kw)
        seen.append(max((len(out) for out in fn(iter([self.toPandas()]))), default=0))
        return plain(self, fn, schema, *a, **kw)

    monkeypatch.setattr(type(df), "mapInPandas", counted)
    got = knn_join(df, df, 4, ["v"], "id", "id", exclude_self=True, broadcast_max_bytes=0, block_rows=40)
    want = knn_join(df, df, 4, ["v"], "id", "id", exclude_self=True)
    order = lambda x: sorted(tuple(r) for r in x.select("query_id", "ref_id", "rank", "distance").collect())
    assert order(got) == order(want)
    assert len(seen) == 2 and max(seen) <= 64


def test_cells_keep_of_many_copies_those_of_small_ids(spark):
    df = spark.createDataFrame([(i, 0.0 if i < 500 else float(i)) for i in range(600)], "id long, x double")
    rows = knn_join(df, df, 2, ["x"], "id", "id", exclude_self=True, **CELLS).where("query_id < 500").collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["ref_id"])
    assert got == {i: {0: [1, 2], 1: [0, 2]}.get(i, [0, 1]) for i in range(500)}
