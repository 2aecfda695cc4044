"""The approximate join against the exact one: recall, copies, hot buckets, odd rows."""

import numpy as np
from conftest import SF_SMALL
from pyspark.sql import functions as F

from riskloom.fixtures import vectors
from riskloom.operators import annjoin as A
from riskloom.operators.knn import knn_join


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "k long, v array<double>")


def recall(got, want):
    pairs = lambda df: {(r["query_id"], r["ref_id"]): r["distance"] for r in df.collect()}
    got, want = pairs(got), pairs(want)
    assert all(abs(got[p] - want[p]) < 1e-6 for p in got.keys() & want.keys())
    return len(got.keys() & want.keys()) / len(want)


def test_recall_on_clusters_and_few_candidates(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] * 3 + rng.normal(size=(3000, 16)) * 0.4
    df = frame(spark, x)
    got = A.approximate_knn_join(df, df, 5, "v", "k", "k", exclude_self=True, bucket_rows=100, tables=8).cache()
    assert recall(got, knn_join(df, df, 5, ["v"], "k", "k", exclude_self=True)) >= 0.9
    seen = got.where("rank = 1").agg(F.sum("n_candidates")).first()[0]
    assert seen < 0.6 * 8 * 3000 * 3000 / 2
    again = A.approximate_knn_join(df.repartition(5), df.repartition(3), 5, "v", "k", "k", exclude_self=True, bucket_rows=100, tables=8)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))
    got.unpersist()


def test_recall_on_the_vectors_table(spark):
    v = vectors(spark, SF_SMALL)
    got = A.approximate_knn_join(v, v, 5, "embedding", "vec_id", "vec_id", exclude_self=True)
    assert recall(got, knn_join(v, v, 5, ["embedding"], "vec_id", "vec_id", exclude_self=True)) >= 0.9


def test_copies_and_a_hot_cluster(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 50)
    rng = np.random.default_rng(2)
    tight = rng.normal(size=(600, 8)) * 1e-3 + 5
    x = np.vstack([rng.normal(size=(400, 8)), np.repeat(rng.normal(size=(1, 8)), 700, 0), tight])
    df = frame(spark, x)
    got = A.approximate_knn_join(df, df, 3, "v", "k", "k", exclude_self=True, bucket_rows=40, hot=2).cache()
    want = knn_join(df, df, 3, ["v"], "k", "k", exclude_self=True)
    assert recall(got.where("query_id between 400 and 1099"), want.where("query_id between 400 and 1099")) == 1.0
    assert recall(got, want) >= 0.8
    assert got.where("query_id between 400 and 1099").agg(F.max("n_candidates")).first()[0] < 10 * 7 * 700 / 2
    got.unpersist()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (None, [1.0, 1.0]), (3, [0.0, 2.0]), (3, [0.0, 2.0])], "k long, v array<double>")
    got = A.approximate_knn_join(df, df, 2, "v", "k", "k", exclude_self=True).select("query_id", "ref_id", "rank").collect()
    assert sorted(map(tuple, got)) == [(1, 3, 1), (3, 1, 1)]
    assert A.approximate_knn_join(df, df.limit(0), 2, "v", "k", "k").count() == 0
    assert A.approximate_knn_join(df.limit(0), df, 2, "v", "k", "k").count() == 0


def test_a_task_takes_its_distances_together(spark):
    """Frames made grow with the groups, not with the query rows; vectors that are not finite are near nothing."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    x[7, 2], x[8, 1] = np.nan, np.inf
    df = frame(spark, x)
    got = {(r["query_id"], r["ref_id"], r["rank"]): (r["distance"], r["n_candidates"]) for r in A.approximate_knn_join(df, df, 4, "v", "k", "k", exclude_self=True, bucket_rows=1000, tables=1, probes=0).collect()}
    gap = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2)).round(9)
    gap[~(gap < np.inf)] = np.inf
    np.fill_diagonal(gap, np.inf)
    assert not {q for q, *_ in got} & {7, 8}
    for (q, r, rank), (d, n) in got.items():
        assert d == gap[q, r] and 1 <= n <= 300 and rank in (1, 2, 3, 4)


def test_vectors_of_queries_are_not_written_with_every_code(spark, monkeypatch):
    written, plain = [], A.materialize
    monkeypatch.setattr(A, "materialize", lambda df, name: written.append((name, df.columns)) or plain(df, name))
    df = frame(spark, np.random.default_rng(7).normal(size=(60, 4)))
    A.approximate_knn_join(df, df, 2, "v", "k", "k", exclude_self=True)
    assert "vec" in dict(written)["reference"] and [name for name, columns in written if "vec" in columns and name not in ("reference", "index")] == []
    assert "asked" not in dict(written)
