"""Second-order gradient boosting of trees for two classes (ML9).

Each round fits a tree to the gradients g = p - y and hessians h = p (1 - p)
of the log loss at the present margins.  A split's gain is

    GL^2 / (HL + l) + GR^2 / (HR + l) - G^2 / (H + l)

and a leaf's value -G / (H + l), shrunk by the step size, with the L2 penalty
l on leaf values; children below a least hessian sum are not made.

* A feature is cut at its values if it has at most ``maxBins`` of them, else
  at as many quantiles.  Rows become blocks of bin numbers, labels and margins
  in a written table, ``BLOCK_ROWS`` rows each.
* A level of a tree is one pass: every task puts its rows through the tree so
  far and sums g and h by (node, feature, bin); the sums of a node go to one
  task, which adds them up and finds the node's best split.  The driver sees
  a split a node, no sums and no rows.  This is the one place here that works
  on an RDD: a partition's state is a numpy block, and a pass must cost little
  more than its arithmetic.
* g and h are whole multiples of 2^-20, so their sums are exact and the model
  does not depend on how rows are dealt out, nor on repeated tasks.
* Margins are carried in the table and written anew every ``CARRY`` rounds;
  in between tasks add the few trees since.  A lost executor costs its blocks'
  reading.  Nothing is kept on a local disk only.

Two equal gains go to the earlier feature, then to the smaller value.  A table
without rows, a label other than 0 and 1, and a missing value raise.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.session import materialize

BLOCK_ROWS = 100_000
CARRY = 10
#: Gradients and hessians are counted in units of 1 / UNIT.
UNIT = 1 << 20
#: A split must gain more than this.
LEAST_GAIN = 1e-6


class Tree:
    """A binary tree in arrays; a node's rows with bin <= ``cut`` go left.  A leaf has feature -1."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def add(self, value: float) -> int:
        for column, x in zip((self.feature, self.cut, self.left, self.right, self.value), (-1, 0, 0, 0, value), strict=True):
            column.append(x)
        return len(self.feature) - 1

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row (bins: rows x features) comes to."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while (inner := feature[at] >= 0).any():
            f = np.where(inner, feature[at], 0)
            at = np.where(inner, np.where(bins[rows, f] <= cut[at], left[at], right[at]), at)
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(bins)]


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """g and h in whole units."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - label) * UNIT), np.rint(p * (1.0 - p) * UNIT)


def level_sums(bins: np.ndarray, label: np.ndarray, margin: np.ndarray, tree: Tree, nodes: list[int], n_bins: int) -> np.ndarray:
    """(g, h) x node x feature x bin sums of the rows that are at ``nodes``."""
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    node = place[tree.place(bins)]
    at = np.flatnonzero(node >= 0)
    g, h = gradients(margin[at], label[at])
    p = bins.shape[1]
    cell = ((node[at][:, None] * p + np.arange(p)) * n_bins + bins[at]).ravel()
    size = len(nodes) * p * n_bins
    return np.array([np.bincount(cell, np.repeat(x, p), size) for x in (g, h)]).reshape(2, len(nodes), p, n_bins)


def best_splits(sums: np.ndarray, penalty: float, least: float) -> list[tuple | None]:
    """For each node (feature, bin, left G, H, right G, H) of its best split, None without a gain."""
    g, h = sums.cumsum(-1) / UNIT
    total_g, total_h = g[:, :1, -1:], h[:, :1, -1:]
    right_g, right_h = total_g - g, total_h - h
    score = lambda a, b: a * a / (b + penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(g, h) + score(right_g, right_h) - score(total_g, total_h)
    gain = np.where((h >= least) & (right_h >= least), gain, -np.inf)
    out = []
    for k, flat in enumerate(np.nan_to_num(gain, nan=-np.inf, neginf=-np.inf).reshape(len(gain), -1)):
        best = int(flat.argmax())
        f, b = divmod(best, gain.shape[2])
        out.append((f, b, g[k, f, b], h[k, f, b], right_g[k, f, b], right_h[k, f, b]) if flat[best] > LEAST_GAIN else None)
    return out


class _Boosting(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    maxIter = Param(Params._dummy(), "maxIter", "rounds", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree below its root", typeConverter=TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "shrinkage of leaf values", typeConverter=TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "L2 penalty on leaf values", typeConverter=TypeConverters.toFloat)
    leastHessian = Param(Params._dummy(), "leastHessian", "least hessian sum of a child", typeConverter=TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", typeConverter=TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(maxIter=100, maxDepth=6, stepSize=0.3, penalty=1.0, leastHessian=1.0, maxBins=256)


class BoostedTrees(Estimator, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    """ML9 estimator; label 0 or 1."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 maxIter=100, maxDepth=6, stepSize=0.3, penalty=1.0, leastHessian=1.0, maxBins=256):
        super().__init__()
        if not 2 <= maxBins <= 256:
            raise ValueError("maxBins must be from 2 to 256")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        rows = materialize(df.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")), "boost")
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("p"), F.count_if(~F.coalesce(F.col("y").isin(0, 1) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)), F.lit(False))).alias("bad")).first()
        if not size["n"] or size["bad"]:
            raise ValueError("boosting needs rows, all of label 0 or 1 and without missing values")
        edges = bin_edges(rows, size["p"], self.getOrDefault("maxBins"))
        trees = boost(
            blocks(rows, edges, max(1, -(-size["n"] // BLOCK_ROWS))), [len(e) for e in edges], self.getOrDefault("maxIter"), self.getOrDefault("maxDepth"),
            self.getOrDefault("stepSize"), self.getOrDefault("penalty"), self.getOrDefault("leastHessian"),
        )
        told = [{**t.__dict__, "cut": [edges[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut, strict=True)]} for t in trees]
        return self._copyValues(BoostedTreesModel(json.dumps(told)))


def bin_edges(rows: DataFrame, p: int, n_bins: int) -> list[list[float]]:
    """The values that features are cut at, ascending: a bin ends with its edge, and the last is the
    greatest value.  One aggregate for all features, and one for those of few values."""
    x = lambda f: F.col("x")[f]
    grid = ", ".join(f"{q}D" for q in (np.arange(n_bins) + 1) / n_bins)
    stats = rows.agg(*[F.expr(f"percentile_approx(x[{f}], array({grid}), 10000)").alias(f"q{f}") for f in range(p)], *[F.approx_count_distinct(x(f)).alias(f"d{f}") for f in range(p)],
                     *[F.max(x(f)).alias(f"m{f}") for f in range(p)]).first()
    edges = []
    for f in range(p):
        own = sorted({*stats[f"q{f}"], stats[f"m{f}"]})[-n_bins:]
        if stats[f"d{f}"] <= 2 * n_bins:
            values = [r["v"] for r in rows.select(x(f).alias("v")).distinct().limit(n_bins + 1).collect()]
            own = sorted(values) if len(values) <= n_bins else own
        edges.append(own)
    return edges


def blocks(rows: DataFrame, edges: list[list[float]], n_blocks: int) -> DataFrame:
    """A written table of numpy blocks: bins (a byte each, rows x features), labels, margins."""

    def pack(batches):
        cuts = [np.array(e) for e in edges]
        for batch in batches:
            for k in range(0, len(batch), BLOCK_ROWS):
                some = batch.iloc[k : k + BLOCK_ROWS]
                x = np.stack(some["x"].to_numpy())
                bins = np.stack([np.minimum(np.searchsorted(c, x[:, f]), len(c) - 1) for f, c in enumerate(cuts)], 1).astype(np.uint8)
                yield pd.DataFrame({"bins": [bins.tobytes()], "label": [some["y"].to_numpy(np.uint8).tobytes()], "margin": [np.zeros(len(some)).tobytes()]})

    return materialize(rows.repartition(n_blocks).mapInPandas(pack, "bins binary, label binary, margin binary"), "blocks")


def _unpacked(row, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["bins"], np.uint8).reshape(-1, p), np.frombuffer(row["label"], np.uint8), np.frombuffer(row["margin"], np.float64)


def judged(sums: np.ndarray, penalty: float, least: float) -> list[tuple]:
    """For each node (its G, its H, its best split or None)."""
    totals = sums[:, :, 0].sum(-1) / UNIT
    return [(float(g), float(h), split) for g, h, split in zip(*totals, best_splits(sums, penalty, least), strict=True)]


def grow_tree(passed, depth: int, step: float, penalty: float, least: float) -> Tree:
    """One tree, level by level; ``passed(tree, nodes)`` gives what ``judged`` says of the rows at ``nodes``."""
    tree = Tree()
    nodes = [tree.add(0.0)]
    for level in range(max(depth, 1)):
        told = passed(tree, nodes)
        if level == 0:
            g, h, _ = told[0]
            tree.value[0] = -step * g / (h + penalty) if h + penalty else 0.0
        if depth == 0:
            break
        after = []
        for node, (_, _, split) in zip(nodes, told, strict=True):
            if split is None:
                continue
            f, b, lg, lh, rg, rh = split
            children = [tree.add(float(-step * g / (h + penalty))) for g, h in ((lg, lh), (rg, rh))]
            tree.feature[node], tree.cut[node] = f, b
            tree.left[node], tree.right[node] = children
            after += children
        nodes = after
        if not nodes:
            break
    return tree


def boost(table: DataFrame, sizes: list[int], rounds: int, depth: int, step: float, penalty: float, least: float) -> list[Tree]:
    """The trees, cut by bin number.  Where all rows are one block there are no sums of other tasks to
    wait for, so its task grows the next ``CARRY`` trees in one go; sums being exact, they are the same."""
    p, n_bins = len(sizes), max(sizes)
    shape = (depth, step, penalty, least)
    alone = table.count() == 1
    trees: list[Tree] = []

    def in_one_task(part):
        for row in part:
            bins, label, margin = _unpacked(row, p)
            for _ in range(min(CARRY, rounds - len(trees))):
                tree = grow_tree(lambda t, nodes: judged(level_sums(bins, label, margin, t, nodes, n_bins), penalty, least), *shape)  # noqa: B023
                margin = margin + tree.margins(bins)
                yield tree

    def by_passes(held, recent: list[Tree]):
        tasks = held.getNumPartitions()

        def passed(tree: Tree, nodes: list[int]) -> list[tuple]:
            def sums(part):
                out = np.zeros((2, len(nodes), p, n_bins))
                for row in part:
                    bins, label, margin = _unpacked(row, p)
                    out += level_sums(bins, label, sum((t.margins(bins) for t in recent), margin), tree, nodes, n_bins)
                yield from ((k, out[:, k : k + 1]) for k in range(len(nodes)))

            added = held.mapPartitions(sums).reduceByKey(np.add, min(len(nodes), tasks))
            told = added.mapValues(lambda x: judged(x, penalty, least)[0]).collectAsMap()
            return [told[k] for k in range(len(nodes))]

        for _ in range(min(CARRY, rounds - len(trees))):
            recent.append(grow_tree(passed, *shape))
        return recent

    while len(trees) < rounds:
        held = table.rdd.persist()
        recent = held.mapPartitions(in_one_task).collect() if alone else by_passes(held, [])
        held.unpersist()
        trees = [*trees, *recent]
        if len(trees) < rounds:
            table = carried(table, recent, p)
    return trees


def carried(table: DataFrame, trees: list[Tree], p: int) -> DataFrame:
    """The blocks with the values of ``trees`` in their margins, as a new written table."""

    def add(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                bins, _, margin = _unpacked(row, p)
                yield pd.DataFrame({"bins": [row["bins"]], "label": [row["label"]], "margin": [sum((t.margins(bins) for t in trees), margin).tobytes()]})

    return materialize(table.mapInPandas(add, table.schema), "blocks")


class BoostedTreesModel(Model, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as text in one parameter, so that the model is saved like any stage."""

    trees = Param(Params._dummy(), "trees", "the trees as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, trees: str | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        told = json.loads(self.getOrDefault("trees"))

        @pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            own = []
            for t in told:
                tree = Tree()
                tree.__dict__.update(t)
                own.append(tree)
            values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            return pd.Series(reduce(np.add, (t.margins(values) for t in own), np.zeros(len(values))))

        p = 1.0 / (1.0 + F.exp(-F.col("_margin")))
        out = df.withColumn("_margin", margin(vector_to_array(F.col(self.getFeaturesCol()))))
        out = out.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1.0 - p, p)))
        return out.withColumn(self.getPredictionCol(), (F.col("_margin") > 0).cast("double")).drop("_margin")
