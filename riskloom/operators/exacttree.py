"""Decision trees and forests with exact splits and no depth limit (ML7, ML8).

A node is split while it holds both classes and some feature has two values in
it (or up to ``max_depth``).  Its cut is the one of least weighted Gini
impurity among all places between two neighbouring distinct values, at their
mid-point; equal cuts go to the earlier feature, then to the smaller value.

* A node of more than ``local_rows`` rows is split on the cluster, all such
  nodes of a level and all trees together: counts by (tree, node, feature,
  value) with partial aggregation, running sums of them, the best cut by an
  aggregate.  Running sums are taken within value ranges of a feature, about
  ``RANGE_ROWS`` rows each, on top of the sums of the ranges before; no window
  sees a whole feature.
* A smaller node is finished with everything below it in one task.  Counts are
  whole numbers and scores the same arithmetic, so both ways give one tree.
* A forest weighs each row of a tree with a Poisson(1) draw and offers each
  node ``draw`` of the features that vary in it.  Draws are md5 hashes of
  (seed, tree, key) and (seed, tree, node, feature): the forest does not depend
  on how rows are dealt out nor on repeated tasks.

The model is a written table of nodes (:data:`NODE`); a node is named by its
path from the root, L or R a level.  A level costs a few passes, so a tree that
takes single rows off a large node takes as many passes.  A forest's rows are
written once a tree that drew them.

An empty table, a label other than 0 and 1 and a missing value raise.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.session import materialize

#: feature -1: a leaf; n, n1: (weighted) rows and those of label 1.
NODE = "tree int, path string, feature int, threshold double, n long, n1 long"
LOCAL_ROWS = 100_000
RANGE_ROWS, MAX_RANGES = 100_000, 4_096
#: Nodes of a model that every task may hold (32 bytes each).
HELD_NODES = 1_000_000
#: Leaf probabilities are summed in units of 1 / UNIT.
UNIT = 1 << 20
NODE_KEY = ["tree", "path"]


def poisson_thresholds() -> list[int]:
    """A 32-bit draw is worth as many as it reaches of these: Poisson of mean 1."""
    terms = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)])
    return [int(t * 2**32) for t in terms if int(t * 2**32) < 2**32]


def weight(key: Column, tree: Column, seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), F.lit("weight"), tree.cast("string"), key.cast("string"))
    drawn = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return reduce(lambda a, b: a + b, [(drawn >= F.lit(t)).cast("int") for t in poisson_thresholds()])


def vectors(rows: DataFrame, features: Sequence[str], key: str, label: str) -> DataFrame:
    """key, x, y; raises where nothing can be learned."""
    own = rows.select(F.col(key).alias("key"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"), F.col(label).cast("int").alias("y"))
    bad = ~F.coalesce(F.col("y").isin(0, 1), F.lit(False)) | F.exists("x", lambda v: v.isNull() | F.isnan(v))
    n, wrong = own.agg(F.count(F.lit(1)), F.count_if(bad)).first()
    if not n or wrong:
        raise ValueError("a tree needs rows, all of label 0 or 1 and without missing values")
    return own


def value_ranges(own: DataFrame, p: int, range_rows: int = RANGE_ROWS) -> list[list[float]]:
    """For each feature the ends of its value ranges, but for the last: approximate quantiles.  They
    decide how work is dealt out, not what comes out."""
    parts = min(MAX_RANGES, -(-own.count() // range_rows))
    if parts < 2:
        return [[] for _ in range(p)]
    grid = ", ".join(f"{k / parts}D" for k in range(1, parts))
    found = own.agg(*[F.expr(f"percentile_approx(x[{f}], array({grid}), 10000)").alias(f"q{f}") for f in range(p)]).first()
    return [sorted(set(q)) for q in found]


def in_range(f: Column, v: Column, edges: list[list[float]]) -> Column:
    """The number of the range that a value of feature ``f`` lies in."""
    if not any(edges):
        return F.lit(0)

    @pandas_udf("int")
    def place(f: pd.Series, v: pd.Series) -> pd.Series:
        out, f, v = np.zeros(len(f), np.int32), f.to_numpy(), v.to_numpy()
        for k, own in enumerate(edges):
            at = f == k
            out[at] = np.searchsorted(own, v[at])
        return pd.Series(out)

    return place(f, v)


def cuts_of_features(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """The best cut of every feature in every node of ``rows`` (tree, path, x, w, y): tree, path, f and
    best: cost (least is best), v and next (the values it lies between), ln and l1 (rows left of it, of
    label 1), n and n1.  A feature of one value has none."""
    by = [*NODE_KEY, "f"]
    long = rows.select(*NODE_KEY, "w", "y", F.posexplode("x").alias("f", "v"))
    cells = long.groupBy(*by, "v").agg(F.sum("w").alias("c"), F.sum(F.col("w") * F.col("y")).alias("c1"))
    cells = materialize(cells.withColumn("part", in_range(F.col("f"), F.col("v"), edges)), "cells")
    order, whole = Window.partitionBy(*by).orderBy("part"), Window.partitionBy(*by)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = cells.groupBy(*by, "part").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1"), F.min("v").alias("least"))
    parts = parts.select(
        *by, "part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.sum("c1").over(earlier), F.lit(0)).alias("before1"),
        F.lead("least").over(order).alias("after"), F.sum("c").over(whole).alias("n"), F.sum("c1").over(whole).alias("n1"),
    )
    inside = Window.partitionBy(*by, "part").orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    cuts = cells.join(parts, [*by, "part"]).select(
        *by, "v", "n", "n1", F.coalesce(F.lead("v").over(inside), "after").alias("next"),
        (F.col("before") + F.sum("c").over(upto)).alias("ln"), (F.col("before1") + F.sum("c1").over(upto)).alias("l1"),
    )
    num = lambda e: F.expr(e).cast("double")
    l0, l1, ln, r0, r1, rn = (num(e) for e in ("ln - l1", "l1", "ln", "(n - ln) - (n1 - l1)", "n1 - l1", "n - ln"))
    cost = -((l0 * l0 + l1 * l1) / ln + (r0 * r0 + r1 * r1) / rn)
    best = F.min(F.struct(cost.alias("cost"), "v", "next", "ln", "l1", "n", "n1")).alias("best")
    return cuts.where(F.col("next").isNotNull()).groupBy(*by).agg(best)


def chosen_cuts(cuts: DataFrame, draw: int | None, seed: int) -> DataFrame:
    """tree, path, feature, threshold: of each node the best cut of the features it draws."""
    if draw is not None:
        lot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("draw"), F.col("tree").cast("string"), "path", F.col("f").cast("string")))
        cuts = cuts.withColumn("lot", F.row_number().over(Window.partitionBy(*NODE_KEY).orderBy(lot, "f"))).where(F.col("lot") <= draw)
    best = cuts.groupBy(*NODE_KEY).agg(F.min(F.struct("best.cost", "f", "best.v", "best.next")).alias("b"))
    return best.select(*NODE_KEY, F.col("b.f").alias("feature"), between(F.col("b.v"), F.col("b.next")).alias("threshold"))


def between(v: Column, after: Column) -> Column:
    """The mid-point; ``v`` where no number lies between."""
    mid = v / 2 + after / 2
    return F.when(mid < after, mid).otherwise(v)


def best_cut(x: np.ndarray, w: np.ndarray, y: np.ndarray, rank) -> tuple[int, float] | None:
    """(feature, threshold) of one node's rows; ``rank`` picks from its varying features."""
    best = None
    for f in rank([f for f in range(x.shape[1]) if (x[:, f] != x[0, f]).any()]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        ends = np.flatnonzero(v[:-1] < v[1:])
        n, n1 = np.cumsum(w[order]), np.cumsum((w * y)[order])
        ln, l1 = n[ends].astype(float), n1[ends].astype(float)
        rn, r1 = n[-1] - ln, n1[-1] - l1
        l0, r0 = ln - l1, rn - r1
        cost = -((l0 * l0 + l1 * l1) / ln + (r0 * r0 + r1 * r1) / rn)
        k = int(cost.argmin())
        if best is None or cost[k] < best[0]:
            a, b = v[ends[k]], v[ends[k] + 1]
            mid = a / 2 + b / 2
            best = (cost[k], f, float(mid if mid < b else a))
    return best and best[1:]


def grown(tree: int, path: str, x: np.ndarray, w: np.ndarray, y: np.ndarray, draw: int | None, max_depth: int | None, seed: int) -> pd.DataFrame:
    """All nodes from ``path`` down, of the rows that come to it."""

    def rank(node: str):
        lot = lambda f: hashlib.md5(f"{seed}:draw:{tree}:{node}:{f}".encode()).hexdigest()
        return lambda some: some if draw is None else sorted(sorted(some, key=lot)[:draw])

    out, left = [], [(path, np.arange(len(y)))]
    while left:
        node, at = left.pop()
        n, n1 = int(w[at].sum()), int((w[at] * y[at]).sum())
        ends = n1 in (0, n) or (max_depth is not None and len(node) >= max_depth)
        cut = None if ends else best_cut(x[at], w[at], y[at], rank(node))
        out.append((tree, node, *(cut or (-1, 0.0)), n, n1))
        if cut:
            goes = x[at, cut[0]] <= cut[1]
            left += [(node + "L", at[goes]), (node + "R", at[~goes])]
    return pd.DataFrame(out, columns=[c.split()[0] for c in NODE.split(", ")])


def grow(
    rows: DataFrame, features: Sequence[str], key: str, label: str, *, trees: int = 1, bootstrap: bool = False, draw: int | None = None,
    max_depth: int | None = None, seed: int = 42, local_rows: int = LOCAL_ROWS, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The written table of nodes of ``trees`` trees over ``rows``; ``label`` is 0 or 1.  A tree that
    drew no row has no node."""
    own = materialize(vectors(rows, features, key, label), "vectors")
    edges = value_ranges(own, len(features), range_rows)
    held = own.withColumns({"tree": F.explode(F.sequence(F.lit(0), F.lit(trees - 1))), "path": F.lit("")})
    held = held.withColumn("w", weight(F.col("key"), F.col("tree"), seed) if bootstrap else F.lit(1)).where("w > 0")
    held = materialize(held.select(*NODE_KEY, "x", F.col("w").cast("long").alias("w"), F.col("y").cast("long").alias("y")), "held")

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        tree, path = int(group["tree"].iloc[0]), group["path"].iloc[0]
        return grown(tree, path, np.stack(group["x"].to_numpy()), group["w"].to_numpy(), group["y"].to_numpy(), draw, max_depth, seed)

    leaf = (*NODE_KEY, F.lit(-1).alias("feature"), F.lit(0.0).alias("threshold"), "n", "n1")
    made: list[DataFrame] = []
    while True:
        sizes = materialize(held.groupBy(*NODE_KEY).agg(F.count(F.lit(1)).alias("rows"), F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("n1")), "sizes")
        ends = (F.col("n1") == 0) | (F.col("n1") == F.col("n"))
        if max_depth is not None:
            ends = ends | (F.length("path") >= max_depth)
        small, large = (sizes.where(~ends & c) for c in (F.col("rows") <= local_rows, F.col("rows") > local_rows))
        made += [sizes.where(ends).select(*leaf), held.join(small, NODE_KEY, "left_semi").groupBy(*NODE_KEY).applyInPandas(finish, NODE)]
        if large.isEmpty():
            return materialize(reduce(DataFrame.unionByName, made), "nodes")
        held = held.join(large, NODE_KEY, "left_semi")
        cut = materialize(chosen_cuts(cuts_of_features(held, edges), draw, seed), "cuts")
        made.append(large.join(cut, NODE_KEY, "left").select(*NODE_KEY, F.coalesce("feature", F.lit(-1)).alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"), "n", "n1"))
        held = materialize(held.join(cut, NODE_KEY).select("tree", _down().alias("path"), "x", "w", "y"), "held")


def _down() -> Column:
    """The path of the child that a row goes to."""
    return F.concat("path", F.when(F.get("x", F.col("feature")) <= F.col("threshold"), "L").otherwise("R"))


def _units(n1: Column, n: Column) -> Column:
    return F.rint(n1 / n * UNIT).cast("long")


def predict(nodes: DataFrame, rows: DataFrame, features: Sequence[str], *, held_nodes: int = HELD_NODES) -> DataFrame:
    """``rows`` with p (mean share of label 1 in the leaves they come to) and prediction (1 if p is over
    a half).  A model of up to ``held_nodes`` nodes goes to every task and rows stay where they are; beyond,
    rows walk down it a level a join."""
    rows = rows.withColumn("__x", F.array(*[F.col(f).cast("double") for f in features]))
    n_trees = nodes.select("tree").distinct().count()
    if nodes.limit(held_nodes + 1).count() <= held_nodes:
        told = nodes.toPandas()
        at = {node: i for i, node in enumerate(zip(told["tree"], told["path"], strict=True))}
        child = [np.array([at.get((t, p + side), 0) for t, p in at], np.int64) for side in "LR"]
        feature, threshold = told["feature"].to_numpy(), told["threshold"].to_numpy()
        value = np.rint(told["n1"].to_numpy() / told["n"].to_numpy() * UNIT).astype(np.int64)
        roots = [i for (_, path), i in at.items() if path == ""]

        @pandas_udf("long")
        def leaves(x: pd.Series) -> pd.Series:
            total = np.zeros(len(x), np.int64)
            if len(x):
                x, each = np.stack(x.to_numpy()), np.arange(len(x))
                for root in roots:
                    node = np.full(len(x), root)
                    while (inner := feature[node] >= 0).any():
                        f = np.where(inner, feature[node], 0)
                        node = np.where(inner, np.where(x[each, f] <= threshold[node], child[0][node], child[1][node]), node)
                    total += value[node]
            return pd.Series(total)

        scored = rows.withColumn("__sum", leaves("__x"))
    else:
        rows = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
        walk = rows.select("__row", F.col("__x").alias("x"), F.lit("").alias("path")).join(nodes.where("path = ''").select("tree"))
        votes, level = [], 0
        while True:
            walk = materialize(walk.join(nodes.where(F.length("path") == level), NODE_KEY), "walk")
            votes.append(walk.where("feature < 0").select("__row", _units(F.col("n1"), F.col("n")).alias("u")))
            walk, level = walk.where("feature >= 0").select("__row", "tree", "x", _down().alias("path")), level + 1
            if walk.isEmpty():
                break
        total = reduce(DataFrame.unionByName, votes).groupBy("__row").agg(F.sum("u").alias("__sum"))
        scored = rows.join(total, "__row").drop("__row")
    over = F.col("__sum") * 2 > n_trees * UNIT
    return scored.withColumns({"p": F.col("__sum") / (n_trees * UNIT), "prediction": over.cast("int")}).drop("__x", "__sum")
