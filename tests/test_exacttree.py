"""Exact trees and forests: against a plain version, both ways of growing and scoring, any partitioning."""

import numpy as np
import pytest

from riskloom.operators import exacttree as E


def plain(x, y, path=""):
    """Nodes of one tree, every cut tried by itself."""
    n, n1 = len(y), int(y.sum())
    best = None
    if 0 < n1 < n:
        for f in range(x.shape[1]):
            values = sorted(set(x[:, f]))
            for a, b in zip(values, values[1:], strict=False):
                left = x[:, f] <= a
                score = sum((s & (y == c)).sum() ** 2 / s.sum() for s in (left, ~left) for c in (0, 1))
                if best is None or score > best[0] + 1e-9:
                    best = (score, f, (a + b) / 2, left)
    if best is None:
        return {path: (-1, 0.0, n, n1)}
    _, f, cut, left = best
    return {path: (f, cut, n, n1), **plain(x[left], y[left], path + "L"), **plain(x[~left], y[~left], path + "R")}


def table(spark, n=160, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)) * 3)  # many ties
    x[:, 2] = 5.0
    x[:, 3] = x[:, 0]  # equal cuts
    y = ((x[:, 0] * x[:, 1] + rng.normal(size=n)) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t), "x") for i, (r, t) in enumerate(zip(x, y, strict=True))], "k long, a double, b double, c double, d double, y int, path string")
    return x, y, df


def told(nodes):
    return {(r["tree"], r["path"]): tuple(r)[2:] for r in nodes.collect()}


F4 = list("abcd")


@pytest.mark.parametrize("local_rows,range_rows", [(10**6, 10**6), (60, 10**6), (60, 20), (10, 30)])
def test_equals_the_plain_version_both_ways(spark, local_rows, range_rows):
    x, y, df = table(spark)
    got = told(E.grow(df, F4, "k", "y", local_rows=local_rows, range_rows=range_rows))
    assert got == {(0, p): v for p, v in plain(x, y).items()}


def test_values_without_a_number_between(spark):
    a = 1.0
    b = float(np.nextafter(a, 2))
    df = spark.createDataFrame([(1, a, 0), (2, b, 1), (3, b, 1)], "k long, a double, y int")
    for local in (10, 0):
        nodes = E.grow(df, ["a"], "k", "y", local_rows=local)
        assert told(nodes)[(0, "")][:2] == (0, a)
        assert [r["prediction"] for r in E.predict(nodes, df, ["a"]).orderBy("k").collect()] == [0, 1, 1]


def test_a_forest_is_the_same_however_rows_are_dealt_out(spark):
    _, _, df = table(spark, seed=3)
    options = {"trees": 5, "bootstrap": True, "draw": 2}
    one = told(E.grow(df, F4, "k", "y", **options))
    assert told(E.grow(df.repartition(7), F4, "k", "y", local_rows=50, range_rows=25, **options)) == one
    assert len({t for t, _ in one}) == 5 and len({v[:2] for (_, p), v in one.items() if p == ""}) > 1
    assert abs(sum(v[2] for (_, p), v in one.items() if p == "") / (5 * 160) - 1) < 0.15


def test_scoring_both_ways_and_depth(spark):
    x, y, df = table(spark)
    nodes = E.grow(df, F4, "k", "y", trees=3, bootstrap=True, draw=2, max_depth=4)
    assert max(len(p) for _, p in told(nodes)) == 4
    get = lambda d: sorted(map(tuple, d.select("k", "y", "path", "p", "prediction").collect()))
    rows = df.unionAll(df.limit(3))  # repeated rows, and a column of the same name as a node's
    held, walked = (get(E.predict(nodes, rows, F4, held_nodes=m)) for m in (10**6, 1))
    assert held == walked and len(held) == 163
    whole = E.grow(df, ["a", "b"], "k", "y")
    leaf = {tuple(r): [] for r in x[:, :2]}
    for r, t in zip(x, y, strict=True):
        leaf[tuple(r[:2])].append(t)
    want = {i: int(np.mean(leaf[tuple(r[:2])]) > 0.5) for i, r in enumerate(x)}
    assert {r["k"]: r["prediction"] for r in E.predict(whole, df, ["a", "b"]).collect()} == want


def test_what_cannot_be_learned_raises_and_one_class_is_a_leaf(spark):
    _, _, df = table(spark, n=20)
    for bad in (df.limit(0), df.selectExpr("k", "a", "y + 1 as y"), df.selectExpr("k", "cast('nan' as double) as a", "y"), df.selectExpr("k", "a", "cast(null as int) as y")):
        with pytest.raises(ValueError):
            E.grow(bad, ["a"], "k", "y")
    assert told(E.grow(df.selectExpr("k", "a", "1 as y"), ["a"], "k", "y", local_rows=0)) == {(0, ""): (-1, 0.0, 20, 20)}
    assert set(told(E.grow(df, ["c"], "k", "y", local_rows=0))) == {(0, "")}
