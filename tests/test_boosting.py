"""Second-order boosting against a plain version, and its properties."""

import json
import pickle

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from riskloom.operators import boosting as B
from riskloom.operators.boosting import BoostedTrees, BoostedTreesModel


def plain_margins(x, y, rounds, depth, step, penalty, least):
    """Boosting row by row: every distinct value is a cut, sums in floats."""
    margin = np.zeros(len(y))

    def grow(rows, g, h, level):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = None
        for f in range(x.shape[1]) if level < depth else ():
            for v in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= v
                lg, lh = g[rows[left]].sum(), h[rows[left]].sum()
                if min(lh, hs - lh) < least:
                    continue
                gain = lg**2 / (lh + penalty) + (gs - lg) ** 2 / (hs - lh + penalty) - gs**2 / (hs + penalty)
                if gain > (best[0] + 1e-9 if best else 1e-6):
                    best = (gain, rows[left], rows[~left])
        if best is None:
            margin[rows] += -step * gs / (hs + penalty)
        else:
            grow(best[1], g, h, level + 1)
            grow(best[2], g, h, level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), p - y, p * (1 - p), 0)
    return margin


def table(spark, n=300, p=3, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)), 1)
    x[:, -1] = 2.0  # a constant column
    y = ((x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=n)) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "k long, " + ", ".join(f"x{j} double" for j in range(p)) + ", y int")
    return x, y, VectorAssembler(inputCols=[f"x{j}" for j in range(p)], outputCol="features").transform(df)


def probabilities(model, df):
    return {r["k"]: r["q"] for r in model.transform(df).select("k", vector_to_array("probability")[1].alias("q")).collect()}


@pytest.mark.parametrize("rounds,depth", [(1, 0), (1, 1), (3, 3), (12, 2)])
def test_equals_the_plain_version(spark, rounds, depth):
    x, y, df = table(spark)
    got = probabilities(BoostedTrees(labelCol="y", maxIter=rounds, maxDepth=depth).fit(df), df)
    want = 1 / (1 + np.exp(-plain_margins(x, y, rounds, depth, 0.3, 1.0, 1.0)))
    assert np.allclose([got[k] for k in range(len(y))], want, atol=2e-5)


def test_the_model_does_not_depend_on_how_rows_are_dealt_out(spark, monkeypatch):
    _, _, df = table(spark, n=400, seed=3)
    one = BoostedTrees(labelCol="y", maxIter=11, maxDepth=4).fit(df).getOrDefault("trees")
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    assert BoostedTrees(labelCol="y", maxIter=11, maxDepth=4).fit(df.repartition(13)).getOrDefault("trees") == one
    assert len(json.loads(one)) == 11


def test_a_leaf_shrinks_with_the_penalty_and_children_hold_the_least_hessian(spark):
    _, _, df = table(spark)
    free, held = (json.loads(BoostedTrees(labelCol="y", maxIter=1, maxDepth=2, penalty=q).fit(df).getOrDefault("trees"))[0]["value"] for q in (0.0, 1000.0))
    assert max(map(abs, held)) < max(map(abs, free)) / 3
    assert json.loads(BoostedTrees(labelCol="y", maxIter=1, leastHessian=1e9).fit(df).getOrDefault("trees"))[0]["feature"] == [-1]


def test_many_values_are_cut_at_quantiles_and_learned(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 2))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > -0.1)).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "k long, x0 double, x1 double, y int")
    df = VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(df)
    model = BoostedTrees(labelCol="y", maxIter=20, maxDepth=3, maxBins=64).fit(df)
    assert model.transform(df).where("prediction = y").count() > 2900


def test_saved_with_its_pipeline(spark, tmp_path):
    _, _, df = table(spark)
    fitted = Pipeline(stages=[BoostedTrees(labelCol="y", maxIter=2, maxDepth=2)]).fit(df)
    fitted.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], BoostedTreesModel) and probabilities(loaded, df) == probabilities(fitted, df)


def test_what_cannot_be_learned_raises(spark):
    _, _, df = table(spark)
    for bad in (df.limit(0), df.selectExpr("k", "features", "y + 1 as y"), df.selectExpr("k", "features", "cast(null as int) as y")):
        with pytest.raises(ValueError):
            BoostedTrees(labelCol="y", maxIter=1).fit(bad)


def test_splits_are_found_in_tasks_and_no_sums_come_to_the_driver(spark, monkeypatch):
    from pyspark import RDD

    from riskloom.operators import boosting as B

    rng = np.random.default_rng(8)
    x = rng.integers(0, 30, size=(400, 3)).astype(float)
    rows = spark.createDataFrame([([float(c) for c in r], int(r[0] + r[1] > 30)) for r in x], "x array<double>, y int")
    edges = B.bin_edges(rows, 3, 256)
    sizes, shape = [len(e) for e in edges], (3, 4, 0.3, 1.0, 1.0)
    alone = B.boost(B.blocks(rows, edges, 1), sizes, *shape)
    came, plain = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: came.append(plain(self)) or came[-1])
    monkeypatch.setattr(RDD, "treeReduce", lambda *a, **k: pytest.fail("sums of all bins on the driver"))
    apart = B.boost(B.blocks(rows, edges, 4), sizes, *shape)
    assert [t.__dict__ for t in apart] == [t.__dict__ for t in alone]
    assert came and max(len(pickle.dumps(c)) for c in came) < 20_000
