"""A dense net of ReLU layers and a softmax for two classes, trained by mini-batches with Adam (ML10).

Layers of 64 and 32 units, cross-entropy, Glorot-uniform starting weights, Adam with step 0.001.  An epoch
visits every row once, ``batchRows`` rows a step, in an order of its own.

* Rows become numpy blocks of about ``BLOCK_ROWS`` rows in a written table.  A row's block and its place come
  from a hash of its values and its number among its copies, so neither depends on how rows are dealt out, and
  copies of one row spread over all blocks.  Copies are counted first and made again in pieces.
* A step takes the next slice of every block: tasks sum the gradients of their slices, and the sums are added
  up on their way to the driver, which sees some thousand numbers.  This works on an RDD as boosting does: a
  partition's state is a numpy block.  Every such step is a pass.
* A table of one block has no other task's sums to wait for: its task runs ``CARRY`` epochs in one go.
* Several blocks and more than ``MOST_PASSES`` steps an epoch (small batches) would be all waiting.  There
  the weights go from block to block, in an order of each epoch's own: a task sees one block, takes its
  steps of ``batchRows`` rows and hands on weights and Adam's sums.  Steps follow each other, as mini-batches
  do, so the time is in proportion to the rows and no shorter with more machines.
* Gradients are added as whole multiples of 2^-32, so their sums are exact and weights do not depend on the
  order in which tasks end, nor on repeated tasks.

An empty table, a label other than 0 and 1 and a missing value raise.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.session import materialize

HIDDEN, CLASSES = (64, 32), 2
BLOCK_ROWS = 100_000
#: Copies of a row that are made in one piece.
COPIES = 10_000
CARRY = 10
#: Passes over a table of several blocks that an epoch may take.
MOST_PASSES = 100
UNIT = float(1 << 32)
STEP, DECAY, DECAY_SQUARE, TINY = 1e-3, 0.9, 0.999, 1e-7


def layers(flat: np.ndarray, widths: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, biases) of each layer, as views of ``flat``."""
    out, at = [], 0
    for a, b in zip(widths, widths[1:], strict=False):
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def first_weights(widths: Sequence[int], seed: int) -> np.ndarray:
    flat = np.zeros(sum(a * b + b for a, b in zip(widths, widths[1:], strict=False)))
    draw = np.random.default_rng(seed)
    for w, _ in layers(flat, widths):
        bound = np.sqrt(6 / sum(w.shape))
        w[:] = draw.uniform(-bound, bound, w.shape)
    return flat


def forward(flat: np.ndarray, widths: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """What each layer puts out; the last are probabilities."""
    return through(layers(flat, widths), x)


def through(told: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    out = [x]
    for w, b in told[:-1]:
        z = out[-1] @ w
        z += b
        out.append(np.maximum(z, 0, out=z))
    z = out[-1] @ told[-1][0]
    z += told[-1][1]
    z -= z.max(1, keepdims=True)
    e = np.exp(z, out=z)
    e /= e.sum(1, keepdims=True)
    return [*out, e]


def gradient(flat: np.ndarray, widths: Sequence[int], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sum over rows of the cross-entropy's gradient."""
    total = np.zeros_like(flat)
    put_gradient(layers(flat, widths), layers(total, widths), x, y)
    return total


def put_gradient(told, total, x: np.ndarray, y: np.ndarray) -> None:
    """The gradient of layers ``told`` into the arrays of ``total``."""
    out = through(told, x)
    back = out[-1]
    back[np.arange(len(y)), y] -= 1
    for k in range(len(told) - 1, -1, -1):
        w, b = total[k]
        np.matmul(out[k].T, back, out=w)
        np.add.reduce(back, 0, out=b)
        if k:
            back = back @ told[k][0].T
            back *= out[k] > 0


class Adam:
    def __init__(self, size: int):
        self.mean, self.square, self.steps = np.zeros(size), np.zeros(size), 0

    def moved(self, flat: np.ndarray, g: np.ndarray) -> np.ndarray:
        flat = flat.copy()
        self.move(flat, g)
        return flat

    def move(self, flat: np.ndarray, g: np.ndarray) -> None:
        """``flat`` itself takes the step."""
        self.steps += 1
        self.mean *= DECAY
        self.mean += (1 - DECAY) * g
        part = (1 - DECAY_SQUARE) * g
        part *= g
        self.square *= DECAY_SQUARE
        self.square += part
        size = STEP * np.sqrt(1 - DECAY_SQUARE**self.steps) / (1 - DECAY**self.steps)
        root = np.sqrt(self.square, out=part)
        root += TINY
        move = size * self.mean
        move /= root
        flat -= move


def in_order(block, widths: Sequence[int], seed: int, epoch: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's rows in ``epoch``'s order."""
    x, y = np.frombuffer(block["x"]).reshape(-1, widths[0]), np.frombuffer(block["y"], np.uint8)
    at = np.random.default_rng([seed, epoch, block["block"]]).permutation(len(y))
    return x[at], y[at]


def units(x: np.ndarray, y: np.ndarray, flat: np.ndarray, widths: Sequence[int]) -> np.ndarray:
    """Gradient units and the row count of some rows."""
    g = gradient(flat, widths, x, y) if len(y) else np.zeros_like(flat)
    return np.append(np.rint(g * UNIT), len(y)).astype(np.int64)


def slice_sum(block, flat: np.ndarray, widths: Sequence[int], seed: int, epoch: int, step: int, rows: int) -> np.ndarray:
    """Gradient units and the row count of a block's ``step``-th ``rows`` rows in ``epoch``'s order."""
    x, y = in_order(block, widths, seed, epoch)
    return units(x[step * rows : (step + 1) * rows], y[step * rows : (step + 1) * rows], flat, widths)


def mean(sums: np.ndarray) -> np.ndarray:
    return sums[:-1] / UNIT / sums[-1]


def stepped(block, flat: np.ndarray, adam: Adam, widths: Sequence[int], seed: int, epoch: int, rows: int) -> np.ndarray:
    """The weights after a visit to a block, ``rows`` rows a step: as by ``slice_sum``, but the rows are put in
    order once and the arrays are kept from step to step."""
    x, y = in_order(block, widths, seed, epoch)
    flat = flat.copy()
    g = np.zeros_like(flat)
    told, total = layers(flat, widths), layers(g, widths)
    for k in range(0, len(y), rows):
        some = y[k : k + rows]
        put_gradient(told, total, x[k : k + rows], some)
        g *= UNIT
        np.rint(g, out=g)
        g /= UNIT
        g /= len(some)
        adam.move(flat, g)
    return flat


def blocks(rows: DataFrame, n: int) -> DataFrame:
    """The written table of blocks of ``rows`` (x, y): block, n, x and y as bytes."""
    n_blocks = -(-n // BLOCK_ROWS)
    counted = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
    pieces = counted.select("x", "y", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / COPIES))).alias("piece"))
    if n_blocks > 1:
        pieces = pieces.repartition(n_blocks)
    copies = F.sequence(F.col("piece") * COPIES, F.least(F.col("c"), (F.col("piece") + 1) * COPIES) - 1)
    single = pieces.select("x", "y", F.explode(copies).alias("copy")).select("x", "y", F.xxhash64("x", "y", "copy").alias("h"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(group["x"].to_numpy()), group["y"].to_numpy()
        order = np.lexsort([y, *x.T, group["h"].to_numpy()])
        return pd.DataFrame({"block": group["block"].iloc[:1], "n": [len(y)], "x": [x[order].tobytes()], "y": [y[order].astype(np.uint8).tobytes()]})

    dealt = single.withColumn("block", F.pmod("h", F.lit(n_blocks)).cast("int"))
    return materialize(dealt.groupBy("block").applyInPandas(pack, "block int, n long, x binary, y binary"), "blocks")


def train(table: DataFrame, widths: Sequence[int], epochs: int, batch_rows: int, seed: int, alone: bool | None = None) -> np.ndarray:
    """The weights after ``epochs``.  ``alone``: one block, whose task may run epochs by itself."""
    n_blocks, longest = table.agg(F.count(F.lit(1)), F.max("n")).first()
    alone = n_blocks == 1 if alone is None else alone
    rows = max(1, batch_rows // n_blocks)
    steps = range(-(-longest // rows))
    flat, adam = first_weights(widths, seed), Adam(len(first_weights(widths, seed)))
    if n_blocks > 1 and len(steps) > MOST_PASSES:
        return handed_on(table, widths, epochs, batch_rows, seed)

    def run_alone(part):
        for block in part:
            at = flat
            for e in range(epoch, min(epoch + CARRY, epochs)):
                at = stepped(block, at, adam, widths, seed, e, rows)
            yield at, adam

    held = table.rdd.persist()
    for epoch in range(0, epochs, CARRY if alone else 1):
        if alone:
            ((flat, adam),) = held.mapPartitions(run_alone).collect()
            continue
        for step in steps:
            sums = held.map(lambda b: slice_sum(b, flat, widths, seed, epoch, step, rows)).treeReduce(np.add)  # noqa: B023
            flat = adam.moved(flat, mean(sums))
    held.unpersist()
    return flat


def handed_on(table: DataFrame, widths: Sequence[int], epochs: int, rows: int, seed: int) -> np.ndarray:
    """The weights after ``epochs`` in which they go from block to block, each in a partition of its own."""
    names = sorted(r["block"] for r in table.select("block").collect())
    place = {b: i for i, b in enumerate(names)}
    held = table.rdd.keyBy(lambda r: r["block"]).partitionBy(len(names), lambda b: place[b]).values().persist()
    flat, adam = first_weights(widths, seed), Adam(len(first_weights(widths, seed)))

    def visit(part):
        for block in part:
            yield stepped(block, flat, adam, widths, seed, epoch, rows), adam

    for epoch in range(epochs):
        for i in np.random.default_rng([seed, epoch]).permutation(len(names)):
            ((flat, adam),) = held.context.runJob(held, visit, [int(i)])
    held.unpersist()
    return flat


class _Net(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    epochs = Param(Params._dummy(), "epochs", "times that every row is visited", typeConverter=TypeConverters.toInt)
    batchRows = Param(Params._dummy(), "batchRows", "rows a step", typeConverter=TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(epochs=50, batchRows=10, seed=42)


class DenseNet(Estimator, _Net, DefaultParamsReadable, DefaultParamsWritable):
    """ML10 estimator; label 0 or 1."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", epochs=50, batchRows=10, seed=42):
        super().__init__()
        if epochs < 1 or batchRows < 1:
            raise ValueError("epochs and batchRows must be 1 or more")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> DenseNetModel:
        rows = materialize(df.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")), "net")
        wrong = ~F.coalesce(F.col("y").isin(0, 1) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)), F.lit(False))
        n, p, bad = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.count_if(wrong)).first()
        if not n or bad:
            raise ValueError("a net needs rows, all of label 0 or 1 and without missing values")
        widths = [p, *HIDDEN, CLASSES]
        flat = train(blocks(rows, n), widths, self.getOrDefault("epochs"), self.getOrDefault("batchRows"), self.getSeed())
        return self._copyValues(DenseNetModel(json.dumps({"widths": widths, "weights": flat.tolist()})))


class DenseNetModel(Model, _Net, DefaultParamsReadable, DefaultParamsWritable):
    """Weights as text in one parameter, so that the model is saved like any stage."""

    net = Param(Params._dummy(), "net", "widths and weights as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, net: str | None = None):
        super().__init__()
        if net is not None:
            self._set(net=net)

    def _transform(self, df: DataFrame) -> DataFrame:
        told = json.loads(self.getOrDefault("net"))
        widths, flat = told["widths"], np.array(told["weights"])

        @pandas_udf("array<double>")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(list(forward(flat, widths, np.stack(x.to_numpy()))[-1])) if len(x) else pd.Series([], dtype=object)

        out = df.withColumn("_p", probability(vector_to_array(F.col(self.getFeaturesCol()))))
        out = out.withColumn(self.getProbabilityCol(), array_to_vector("_p"))
        return out.withColumn(self.getPredictionCol(), (F.col("_p")[1] > 0.5).cast("double")).drop("_p")
