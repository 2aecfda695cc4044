"""The dense net: gradients by differences, a plain training loop, any partitioning, copies."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from riskloom.operators import densenet as N
from riskloom.operators.densenet import DenseNet, DenseNetModel


def frame(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "k long, a double, b double, y int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def weights(model):
    return json.loads(model.getOrDefault("net"))["weights"]


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    widths = [3, 5, 4, 2]
    flat = rng.normal(size=len(N.first_weights(widths, 1)))
    x, y = rng.normal(size=(7, 3)), rng.integers(0, 2, 7)
    loss = lambda f: -np.log(N.forward(f, widths, x)[-1][np.arange(7), y]).sum()
    eps = 1e-6
    steps = np.eye(len(flat)) * eps
    want = [(loss(flat + s) - loss(flat - s)) / (2 * eps) for s in steps]
    assert np.allclose(N.gradient(flat, widths, x, y), want, atol=1e-5)


def test_learns_what_no_line_parts_and_does_not_depend_on_partitions(spark):
    df = frame(spark)
    one = DenseNet(labelCol="y", epochs=40).fit(df)
    assert one.transform(df).where("prediction = y").count() >= 225
    assert weights(DenseNet(labelCol="y", epochs=3).fit(df.repartition(7))) == weights(DenseNet(labelCol="y", epochs=3).fit(df.coalesce(1)))


def test_passes_equal_the_task_that_runs_alone(spark):
    table = N.blocks(frame(spark, 60).selectExpr("array(a, b) as x", "y"), 60)
    widths = [2, *N.HIDDEN, 2]
    both = [N.train(table, widths, 2, 25, 7, alone=a) for a in (True, False)]
    assert (both[0] == both[1]).all()


def test_several_blocks_by_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    df = frame(spark, 100).selectExpr("array(a, b) as x", "y")
    df = df.unionAll(df.limit(1).selectExpr("x", "y", "explode(sequence(1, 50))").select("x", "y"))  # one row 51 times
    table = N.blocks(df, 150)
    made = sorted(table.collect(), key=lambda r: r["block"])
    assert len(made) == 4 and sum(r["n"] for r in made) == 150 and max(r["n"] for r in made) < 75
    widths = [2, *N.HIDDEN, 2]
    flat, adam = N.first_weights(widths, 5), N.Adam(len(N.first_weights(widths, 5)))
    for epoch in range(2):
        for step in range(-(-max(r["n"] for r in made) // 8)):
            total = sum(N.slice_sum(r, flat, widths, 5, epoch, step, 8) for r in made)
            flat = adam.moved(flat, total[:-1] / N.UNIT / total[-1])
    assert (N.train(table, widths, 2, 32, 5) == flat).all()


def test_small_batches_over_several_blocks_hand_the_weights_on(spark, monkeypatch):
    """A job a block and epoch, not a job a step; whole batches of batchRows rows, by a plain loop."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 400)
    df = frame(spark, 1500).selectExpr("array(a, b) as x", "y")
    table = N.blocks(df, 1500)
    made = sorted(table.collect(), key=lambda r: r["block"])
    widths = [2, *N.HIDDEN, 2]
    flat, adam = N.first_weights(widths, 5), N.Adam(len(N.first_weights(widths, 5)))
    for epoch in range(2):
        for i in np.random.default_rng([5, epoch]).permutation(len(made)):
            for step in range(-(-made[i]["n"] // 10)):
                total = N.slice_sum(made[i], flat, widths, 5, epoch, step, 10)
                flat = adam.moved(flat, total[:-1] / N.UNIT / total[-1])
    passes = []
    monkeypatch.setattr(N, "slice_sum", lambda *a: passes.append(a))
    assert len(made) == 4 and (N.train(table, widths, 2, 10, 5) == flat).all()
    assert (N.train(table.repartition(7), widths, 2, 10, 5) == flat).all() and not passes


def test_a_visit_orders_a_block_once(monkeypatch):
    rng, calls = np.random.default_rng(3), []
    block = {"block": 0, "n": 200, "x": rng.normal(size=(200, 2)).tobytes(), "y": rng.integers(0, 2, 200).astype(np.uint8).tobytes()}
    plain = N.in_order
    monkeypatch.setattr(N, "in_order", lambda *a: calls.append(a) or plain(*a))
    widths = [2, *N.HIDDEN, 2]
    N.stepped(block, N.first_weights(widths, 1), N.Adam(len(N.first_weights(widths, 1))), widths, 1, 0, 10)
    assert len(calls) == 1


def test_saved_and_what_cannot_be_learned_raises(spark, tmp_path):
    df = frame(spark, 40)
    fitted = Pipeline(stages=[DenseNet(labelCol="y", epochs=1)]).fit(df)
    fitted.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], DenseNetModel) and loaded.transform(df).select("probability").collect() == fitted.transform(df).select("probability").collect()
    for bad in (df.limit(0), df.selectExpr("features", "y + 1 as y"), df.selectExpr("features", "cast(null as int) as y")):
        with pytest.raises(ValueError):
            DenseNet(labelCol="y", epochs=1).fit(bad)
