"""Exact k-nearest-neighbour join and classifier (JON1, JON2, WIN2, ML6).

Two physical strategies, same exact result:

* **broadcast** — when the reference side measured at fit time is at most
  ``broadcast_max_bytes``, it is shipped once to every executor and each
  query partition computes distances in numpy batches (``mapInPandas``).
  All neighbours of a query row are then at hand, so ``knn_vote`` votes there
  and returns one row per query row: no shuffle.
* **pivot cells** — otherwise reference rows belong to the cell of their
  nearest pivot, and a cell knows its radius.  A query row first meets the
  nearest cells that hold k rows; its k-th distance then bounds the rest:
  a cell whose pivot is farther than radius + bound cannot improve it, so
  the row goes on to the other cells only (triangle inequality, exact).
  Cells and the query rows that meet them are cut into blocks of bounded
  rows; a task sees one block of each.

Cost: both are exact, so at worst (data without structure, where no cell can
be ruled out) every row is still compared with every row, in bounded tasks;
with structure a query row is compared with the few cells near it.

A task compares blocks of few features by a tree of boxes (:class:`BoxTree`):
a query row meets the leaves whose boxes its k-th distance so far reaches, so
a task's time grows with its query rows, not with their product with the
reference.  Of equal reference rows only those of the k + 1 smallest ids can
be among k neighbours; the others are left out first.

Missing features follow ``checked_features``: raise (default), skip or keep.
In the vote a query row that is kept is as far from one reference row as from
any other, its distances being unknown: the ``k`` smallest ids vote for it, as
in SQL, where they tie.
Ties: distances are rounded to ``decimals`` places and ties broken by the
smaller reference id, so results are deterministic and repeatable in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_int
from riskloom.operators.prepare import any_missing, checked_features
from riskloom.session import materialize

DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
DEFAULT_BLOCK_ROWS = 20_000
#: Pivots of the cells: about a cell for each block of reference rows, within these bounds.
LEAST_PIVOTS, MOST_PIVOTS = 8, 2048
_CHUNK_CELLS = 2_000_000  # distance-matrix cells per numpy chunk
#: Reference rows from which a tree is worth it, rows of its leaves, and the most features it is used for.
TREE_ROWS, LEAF_ROWS, TREE_FEATURES = 2_048, 32, 16
#: Query rows that search a tree together.
TOGETHER = 2_048
#: Rows that a task sends to cells at a time: a query row counts once for each block of all cells.
ROUTED = 50_000


def _first_copies(r_ids: np.ndarray, R: np.ndarray, n: int) -> np.ndarray:
    """Places, ascending, of the rows of the ``n`` smallest ids among those of equal features."""
    order = np.lexsort((r_ids, *R.T))
    ids, rows = r_ids[order], R[order]
    other = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]
    seen = np.cumsum(other | np.r_[True, ids[1:] != ids[:-1]])
    return np.sort(order[seen - np.maximum.accumulate(np.where(other, seen, 0)) < n])


def _exact_distances(Q: np.ndarray, R: np.ndarray, decimals: int) -> np.ndarray:
    """Rounded distances of paired rows, accumulated left to right as in SQL."""
    d2 = np.zeros(np.broadcast_shapes(Q.shape, R.shape)[:-1])
    for j in range(Q.shape[-1]):
        diff = Q[..., j] - R[..., j]
        d2 += diff * diff
    return np.round(np.sqrt(d2), decimals)


class BoxTree:
    """A balanced k-d tree over reference rows: halved at the median of the widest feature down to leaves
    of about ``LEAF_ROWS`` rows; every node has the box of its rows."""

    def __init__(self, r_ids: np.ndarray, R: np.ndarray, copies: int):
        self.at = _first_copies(r_ids, R, copies)  # place in the caller's arrays, in tree order at the end
        R = R[self.at]
        self.depth = max(0, math.ceil(math.log2(max(1, len(R)) / max(LEAF_ROWS, 2 * copies))))
        order, edges = np.arange(len(R)), np.array([0, len(R)])
        for _ in range(self.depth):
            cuts = (edges[:-1] + edges[1:]) // 2
            for a, cut, b in zip(edges[:-1], cuts, edges[1:], strict=True):
                own = R[order[a:b]]
                widest = int((own.max(axis=0) - own.min(axis=0)).argmax())
                order[a:b] = order[a:b][np.argpartition(own[:, widest], cut - a)]
            edges = np.sort(np.r_[edges, cuts])
        self.at, self.R, self.ids, self.edges = self.at[order], R[order], r_ids[self.at[order]], edges
        self.width = int(np.diff(edges).max())
        low, high = np.minimum.reduceat(self.R, edges[:-1]), np.maximum.reduceat(self.R, edges[:-1])
        self.boxes = [(low, high)]  # from the root down
        while len(low) > 1:
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.boxes.insert(0, (low, high))

    def _away(self, level: int, node: np.ndarray, Q: np.ndarray) -> np.ndarray:
        """Distances of paired rows and nodes' boxes."""
        low, high = self.boxes[level]
        gap = np.maximum(np.maximum(low[node] - Q, Q - high[node]), 0.0)
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _met(self, q_ids, Q, leaf, decimals, exclude_self) -> tuple[np.ndarray, np.ndarray]:
        """(rows of paired leaves, their distances); places beyond a leaf and the row itself are infinitely far."""
        rows = self.edges[leaf][:, None] + np.arange(self.width)
        none = rows >= self.edges[leaf + 1][:, None]
        rows[none] = 0
        dist = _exact_distances(Q[:, None, :], self.R[rows], decimals)
        if exclude_self:
            none |= self.ids[rows] == q_ids[:, None]
        dist[none] = np.inf
        return rows, dist

    def search(self, q_ids: np.ndarray, Q: np.ndarray, k: int, decimals: int, exclude_self: bool):
        """(query_index, ref_index, distance) of all that may be among the k nearest."""
        step, unit = max(1, _CHUNK_CELLS // (self.width * Q.shape[1])), 10.0 ** (-decimals)
        leaf = np.zeros(len(Q), np.int64)
        for level in range(1, self.depth + 1):
            leaf = 2 * leaf
            leaf += self._away(level, leaf + 1, Q) < self._away(level, leaf, Q)
        bound = np.full(len(Q), np.inf)
        if self.width >= k:
            for s in range(0, len(Q), step):
                own = slice(s, s + step)
                bound[own] = np.partition(self._met(q_ids[own], Q[own], leaf[own], decimals, exclude_self)[1], k - 1, axis=1)[:, k - 1]
        out = []
        for s in range(0, len(Q), TOGETHER):
            q = np.arange(s, min(s + TOGETHER, len(Q)))
            node = np.zeros(len(q), np.int64)
            for level in range(1, self.depth + 1):
                q, node = np.repeat(q, 2), (2 * node[:, None] + np.arange(2)).ravel()
                near = self._away(level, node, Q[q]) <= bound[q] * (1 + 1e-12) + unit
                q, node = q[near], node[near]
            for t in range(0, len(q), step):
                some = q[t : t + step]
                rows, dist = self._met(q_ids[some], Q[some], node[t : t + step], decimals, exclude_self)
                i, j = np.nonzero((dist <= bound[some][:, None]) & (dist < np.inf))
                out.append((some[i], self.at[rows[i, j]], dist[i, j]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _tree(r_ids: np.ndarray, R: np.ndarray, k: int) -> BoxTree | None:
    """The tree of a reference block, where it is of use."""
    if len(r_ids) < TREE_ROWS or R.shape[1] > TREE_FEATURES or not np.isfinite(R).all():
        return None
    return BoxTree(r_ids, R, k + 1)


def _ranked(qi: np.ndarray, ri: np.ndarray, di: np.ndarray, r_ids: np.ndarray, k: int):
    """The first k of every query by distance, id and place, with their ranks."""
    order = np.lexsort((ri, r_ids[ri], di, qi))
    qi, ri, di = qi[order], ri[order], di[order]
    if len(qi) == 0:
        return qi, ri, di, qi
    starts = np.r_[0, np.flatnonzero(np.diff(qi)) + 1]
    rank = np.arange(len(qi)) - np.repeat(starts, np.diff(np.r_[starts, len(qi)])) + 1
    keep = rank <= k
    return qi[keep], ri[keep], di[keep], rank[keep]


def _topk_block(
    q_ids: np.ndarray,
    Q: np.ndarray,
    r_ids: np.ndarray,
    R: np.ndarray,
    k: int,
    decimals: int,
    exclude_self: bool,
    tree: BoxTree | None = None,
):
    """Exact top-k of one query block against one reference block (sorted by id).

    Returns (query_index, ref_index, distance, rank) arrays.  ``tree``: the reference block's, if it has one.
    """
    m = len(r_ids)
    if m == 0 or len(q_ids) == 0:
        e = np.empty(0, dtype=np.int64)
        return e, e, np.empty(0), e
    if tree is not None and np.isfinite(Q).all():
        return _ranked(*tree.search(q_ids, Q, k, decimals, exclude_self), r_ids, k)
    out_q, out_r, out_d = [], [], []
    step = max(1, _CHUNK_CELLS // m)
    half = 0.5 * 10.0 ** (-decimals)
    r_norm = np.einsum("ij,ij->i", R, R)
    r_max = float(r_norm.max())
    kk = min(k, m)
    for s in range(0, len(q_ids), step):
        Qc = Q[s : s + step]
        q_norm = np.einsum("ij,ij->i", Qc, Qc)
        # 1) candidates from one BLAS product, with a margin that covers its
        #    rounding error, so no true neighbour can be missed
        approx = q_norm[:, None] + r_norm[None, :] - 2.0 * (Qc @ R.T)
        tol = 1e-12 * (q_norm + r_max + 1.0) * (Q.shape[1] + 2)
        if exclude_self:
            approx[q_ids[s : s + step, None] == r_ids[None, :]] = np.inf
        kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1] + tol
        kth_round = np.round(np.sqrt(np.maximum(kth, 0.0)), decimals)
        bound = np.square(kth_round + half) * (1 + 1e-9) + tol
        sel = approx <= bound[:, None]
        if exclude_self:
            sel &= np.isfinite(approx)
        rows, cols = np.nonzero(sel)
        # 2) exact distances for the candidates only; then rounded and ordered by (distance, id)
        rows, cols, dist, _ = _ranked(rows, cols, _exact_distances(Qc[rows], R[cols], decimals), r_ids, kk)
        out_q.append(rows + s)
        out_r.append(cols)
        out_d.append(dist)
    return _ranked(np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_d), r_ids, kk)


def _out_schema(carry: str | None) -> str:
    s = "query_id long, ref_id long, rank int, distance double"
    return s + (f", {carry} int" if carry else "")


def _frame(q_ids, r_ids, r_carry, qi, ri, di, rank, carry) -> pd.DataFrame:
    data = {
        "query_id": q_ids[qi].astype("int64"),
        "ref_id": r_ids[ri].astype("int64"),
        "rank": rank.astype("int32"),
        "distance": di.astype("float64"),
    }
    if carry:
        data[carry] = r_carry[ri].astype("int32")
    return pd.DataFrame(data)


def _matrix(df_or_pdf, features: Sequence[str]) -> np.ndarray:
    cols = list(features)
    if len(cols) == 1 and df_or_pdf[cols[0]].dtype == object:
        return np.stack(df_or_pdf[cols[0]].to_numpy()).astype("float64")
    return df_or_pdf[cols].to_numpy(dtype="float64")


def _inputs(query, reference, features, query_id, ref_id, within, carry, keep, nulls, query_nulls=None):
    """(query, reference, feature columns) under internal names, checked."""
    fcols = list(features)
    extra = lambda name, c: [F.col(c).alias(name)] if c else []
    ref = checked_features(reference, fcols, nulls).select(F.col(ref_id).alias("_rid"), *extra("_w", within), *extra("_c", carry), *fcols)
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    qry = checked_features(query, fcols, query_nulls or nulls).select(F.col(query_id).alias("_qid"), *extra("_w", within), *fcols, *kept)
    return qry, ref, fcols


def _bounded_reference(ref: DataFrame, fcols: list[str], max_bytes: int) -> pd.DataFrame | None:
    """The reference rows if they fit, read in one pass that stops at the
    bound: at most that many rows ever reach the driver."""
    if len(fcols) == 1 and dict(ref.dtypes)[fcols[0]].startswith("array"):
        width = ref.agg(F.max(F.size(fcols[0]))).first()[0] or 1
    else:
        width = len(fcols)
    max_rows = max_bytes // ((width + 3) * 8)
    pdf = ref.limit(max_rows + 1).toPandas() if max_rows > 0 else None
    return pdf if pdf is not None and len(pdf) <= max_rows else None


def knn_join(
    query: DataFrame,
    reference: DataFrame,
    k: int,
    features: Sequence[str],
    query_id: str,
    ref_id: str,
    within: str | None = None,
    exclude_self: bool = False,
    carry: str | None = None,
    decimals: int = 9,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    nulls: str = "raise",
) -> DataFrame:
    """(query_id, ref_id, rank, distance[, carry]) for the k nearest reference
    rows of every query row (Euclidean; same ``within`` value only when
    given; the row itself excluded when ``exclude_self``).

    ``features`` is a list of numeric columns, or one array<double> column.
    """
    qry, ref, fcols = _inputs(query, reference, features, query_id, ref_id, within, carry, (), nulls)
    pdf = _bounded_reference(ref, fcols, broadcast_max_bytes)
    if pdf is not None:
        return _knn_broadcast(qry, pdf, k, fcols, within, exclude_self, carry, decimals)
    return _knn_cells(qry, ref, k, fcols, within, exclude_self, carry, decimals, block_rows)


def _reference_groups(pdf: pd.DataFrame, fcols, within, carry, k: int) -> dict:
    """{group: (ids, carried values, features, tree)}"""
    groups = {}
    keyed = pdf.groupby("_w", sort=False) if within else [(None, pdf)]
    for w, g in keyed:
        g = g.sort_values("_rid", kind="stable")
        ids, R = g["_rid"].to_numpy(dtype="int64"), _matrix(g, fcols) if len(g) else np.zeros((0, 1))
        groups[w] = (ids, g["_c"].to_numpy() if carry else None, R, _tree(ids, R, k))
    return groups


def _knn_broadcast(qry, pdf, k, fcols, within, exclude_self, carry, decimals) -> DataFrame:
    # ``pdf`` was collected under a row limit: the broadcast side is bounded.
    bc = qry.sparkSession.sparkContext.broadcast(_reference_groups(pdf, fcols, within, carry, k))

    def run(batches):
        table = bc.value
        for b in batches:
            parts = b.groupby("_w", sort=False) if within else [(None, b)]
            outs = []
            for w, g in parts:
                if w not in table or not len(g):
                    continue
                r_ids, r_carry, R, tree = table[w]
                q_ids = g["_qid"].to_numpy(dtype="int64")
                qi, ri, di, rank = _topk_block(q_ids, _matrix(g, fcols), r_ids, R, k, decimals, exclude_self, tree)
                outs.append(_frame(q_ids, r_ids, r_carry, qi, ri, di, rank, carry))
            if outs:
                yield pd.concat(outs, ignore_index=True)

    return qry.mapInPandas(run, _out_schema(carry))


# ------------------------------------------------------------------ pivot cells
def _pivots(ref: DataFrame, fcols: list[str], n: int) -> np.ndarray:
    """``n`` reference rows as pivots: those with the smallest hash of their id."""
    pdf = ref.select("_rid", *fcols).orderBy(hash_int("pivot", F.col("_rid")), "_rid").limit(n).toPandas()
    return _matrix(pdf, fcols)


def _distances(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    d2 = np.einsum("ij,ij->i", X, X)[:, None] + np.einsum("ij,ij->i", P, P)[None, :] - 2.0 * (X @ P.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _knn_cells(qry, ref, k, fcols, within, exclude_self, carry, decimals, block_rows) -> DataFrame:
    spark = qry.sparkSession
    by_id = Window.partitionBy(*(["_w"] if within else []), *fcols).orderBy("_rid")
    ref = materialize(ref.withColumn("_i", F.dense_rank().over(by_id)).where(F.col("_i") <= k + 1).drop("_i"), "reference")
    n_ref = ref.count()
    P = _pivots(ref, fcols, min(max(LEAST_PIVOTS, math.ceil(n_ref / block_rows)), MOST_PIVOTS))
    w = ["_w"] if within else []
    w_type = f"_w {dict(qry.dtypes)['_w']}, " if within else ""
    need = k + (1 if exclude_self else 0)

    def place(batches):
        for b in batches:
            if len(b):
                d = _distances(_matrix(b, fcols), P)
                cell = d.argmin(axis=1)
                yield b.assign(_cell=cell.astype("int32"), _d=d[np.arange(len(b)), cell])

    ref_schema = ", ".join(f"{c} {t}" for c, t in ref.dtypes)
    placed = materialize(ref.mapInPandas(place, ref_schema + ", _cell int, _d double"), "cells")
    # One row a cell (and group): at most MOST_PIVOTS for each group value.
    found = placed.groupBy(*w, "_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_d").alias("r")).toPandas()
    cells: dict = {}
    for row in found.to_dict("records"):
        cells.setdefault(row.get("_w"), []).append((row["_cell"], row["n"], row["r"]))
    cells = {g: tuple(np.array(c) for c in zip(*sorted(v))) for g, v in cells.items()}
    blocks = {(g, int(c)): max(1, math.ceil(n / block_rows)) for g, (ids, ns, _) in cells.items() for c, n in zip(ids, ns)}
    most = max(blocks.values(), default=1)
    sized = spark.createDataFrame([(*((g,) if within else ()), c, n) for (g, c), n in blocks.items()], f"{w_type}_cell int, _n int")
    rf = [f"_r{j}" for j in range(len(fcols))]  # a self-join's sides need names of their own
    targets = placed.select("_rid", *w, *(["_c"] if carry else []), *[F.col(c).alias(n) for c, n in zip(fcols, rf)], "_cell")
    targets = targets.join(F.broadcast(sized), [*w, "_cell"]).withColumn("_block", F.pmod(hash_int("block", F.col("_rid")), F.col("_n")).cast("int"))

    def route(first: bool):
        """Query rows to (cell, block): to the nearest cells that hold enough
        rows, or, with the k-th distance known, to all others in reach."""

        def run(batches):
            for b in batches:
                for g, group in b.groupby("_w", sort=False, dropna=False) if within else [(None, b)]:
                    if g not in cells or not len(group):
                        continue
                    ids, ns, rs = cells[g]
                    ids, cuts = ids.astype("int64"), np.array([blocks[g, c] for c in ids])
                    # So many rows at a time that those they become, and the distances to the pivots, are bounded.
                    few = max(1, ROUTED // int(cuts.sum()))
                    for s in range(0, len(group), few):
                        part = group.iloc[s : s + few]
                        d = _distances(_matrix(part, fcols), P[ids])
                        order = np.argsort(d, axis=1, kind="stable")
                        before = np.cumsum(ns[order], axis=1) - ns[order]
                        near = np.zeros(d.shape, bool)
                        np.put_along_axis(near, order, before < need, axis=1)
                        if first:
                            go = near
                        else:
                            bound = part["_bound"].to_numpy(dtype="float64")[:, None]
                            slack = 2.0 * 10.0 ** (-decimals) + 1e-7 * (1.0 + d)
                            go = ~near & (d - rs[None, :] <= bound + slack)
                        rows, cols = np.nonzero(go)
                        n = cuts[cols]
                        rows, cols, block = np.repeat(rows, n), np.repeat(cols, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        out = part.iloc[rows][["_qid", *w, *fcols]].reset_index(drop=True)
                        yield out.assign(_cell=ids[cols].astype("int32"), _block=block.astype("int32"))

        return run

    q_schema = "_qid long, " + w_type + ", ".join(f"{c} {dict(qry.dtypes)[c]}" for c in fcols)
    qry = materialize(qry.select(F.col("_qid").cast("long"), *w, *fcols), "queries")

    def search(routed: DataFrame) -> DataFrame:
        """The k nearest of each query row in each block it is routed to.  Query
        rows of a block beyond ``block_rows`` are cut by their hash."""
        routed = materialize(routed, "routed")
        counts = routed.groupBy(*w, "_cell", "_block").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("_cuts"))
        sides = [*w, "_cell", "_block"]
        q = routed.join(counts, sides).withColumn("_cut", F.pmod(hash_int("cut", F.col("_qid")), F.col("_cuts")).cast("int")).drop("_cuts")
        r = targets.join(counts, sides).withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))).drop("_cuts", "_n")

        def cell(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
            if not len(qp) or not len(rp):
                return pd.DataFrame({c: [] for c in ["query_id", "ref_id", "rank", "distance"] + ([carry] if carry else [])})
            rp = rp.sort_values("_rid", kind="stable")
            r_ids, q_ids = rp["_rid"].to_numpy(dtype="int64"), qp["_qid"].to_numpy(dtype="int64")
            R = _matrix(rp, rf)
            qi, ri, di, rank = _topk_block(q_ids, _matrix(qp, fcols), r_ids, R, k, decimals, exclude_self, _tree(r_ids, R, k))
            return _frame(q_ids, r_ids, rp["_c"].to_numpy() if carry else None, qi, ri, di, rank, carry)

        keys = [*sides, "_cut"]
        return q.groupBy(*keys).cogroup(r.groupBy(*keys)).applyInPandas(cell, _out_schema(carry))

    nearest = materialize(search(qry.mapInPandas(route(True), q_schema + ", _cell int, _block int")), "nearest")
    # The k-th of the first cells bounds the answer; with fewer than k rows everything is in reach.
    # Several blocks of a cell each give up to k, so the k-th of all is taken, not the largest.
    order = Window.partitionBy("query_id").orderBy("distance", "ref_id")
    kth = nearest.select("query_id", "distance", F.row_number().over(order).alias("_i")).where(F.col("_i") == k)
    bounded = qry.join(kth.select(F.col("query_id").alias("_qid"), F.col("distance").alias("_b")), "_qid", "left")
    bounded = bounded.select(*qry.columns, F.coalesce("_b", F.lit(float("inf"))).alias("_bound"))
    others = search(bounded.mapInPandas(route(False), q_schema + ", _cell int, _block int"))
    ranked = nearest.unionByName(others).withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= k)
    return ranked.withColumn("rank", F.col("_i").cast("int")).drop("_i")


def votes(neighbours: DataFrame, label: str, ks: Sequence[int]) -> DataFrame:
    """(query_id, prediction_<k> for every k): the most frequent label among
    the k nearest, ties → smallest label.  One aggregate over at most
    max(ks) rows per query row, then array functions (JVM-side)."""
    near = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(label).alias("l")))), lambda x: x["l"])
    per_q = neighbours.groupBy("query_id").agg(near.alias("_labels"))

    def vote(k: int):
        some = F.slice("_labels", 1, k)
        counted = F.transform(F.array_distinct(some), lambda l: F.struct(F.size(F.filter(some, lambda x: x == l)).alias("n"), (-l).alias("neg")))
        return (-F.array_max(counted)["neg"]).cast("int").alias(f"prediction_{k}")

    return per_q.select("query_id", *[vote(k) for k in ks])


def majority_vote(neighbours: DataFrame, label: str, out: str = "prediction") -> DataFrame:
    """(query_id, prediction) from all the neighbours of each query row."""
    k = 2**31 - 1
    return votes(neighbours, label, [k]).select("query_id", F.col(f"prediction_{k}").alias(out))


def _vote_block(labels: np.ndarray, qi: np.ndarray, rank: np.ndarray, n: int, k: int) -> np.ndarray:
    """The vote of the first k neighbours of each of n query rows."""
    kinds, code = np.unique(labels, return_inverse=True)
    use = rank <= k
    counts = np.zeros((n, max(1, len(kinds))), np.int64)
    np.add.at(counts, (qi[use], code[use]), 1)
    return kinds[counts.argmax(axis=1)]  # the first of equal counts is the smallest label


def knn_vote(
    train: DataFrame,
    test: DataFrame,
    ks: Sequence[int],
    features: Sequence[str],
    id_col: str,
    label: str,
    keep: Sequence[str] = (),
    decimals: int = 9,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    nulls: str = "raise",
    query_nulls: str | None = None,
) -> DataFrame:
    """ML6: (id, *keep, prediction_<k> for every k) for every test row, all k
    from one pass over the distances.  In the broadcast form the vote is
    taken where the distances are, and the kept columns travel along: one
    row in, one row out, no shuffle.  Without training rows there is no vote
    and no row.  ``query_nulls``: the policy of the test rows, where it is
    another than that of the training rows."""
    query_nulls = nulls if query_nulls is None else query_nulls
    qry, ref, fcols = _inputs(test, train, features, id_col, id_col, None, label, keep, nulls, query_nulls)
    pdf = _bounded_reference(ref, fcols, broadcast_max_bytes)
    out = [F.col("_qid").alias(id_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)]]
    named = [f"prediction_{k}" for k in ks]
    if query_nulls == "keep":
        lost = _without_distances(qry, ref, pdf, ks, fcols).select(*out, *named)
        qry = checked_features(qry, fcols, "skip")
        return _voted(qry, ref, pdf, ks, fcols, keep, decimals, block_rows).select(*out, *named).unionByName(lost)
    return _voted(qry, ref, pdf, ks, fcols, keep, decimals, block_rows).select(*out, *named)


def _without_distances(qry: DataFrame, ref: DataFrame, pdf: pd.DataFrame | None, ks: Sequence[int], fcols: list[str]) -> DataFrame:
    """The query rows with a missing feature and their votes, those of the smallest reference ids."""
    near = ref.select("_rid", "_c").orderBy("_rid", "_c").limit(max(ks)).toPandas() if pdf is None else pdf.sort_values(["_rid", "_c"]).head(max(ks))
    rows = qry.where(any_missing(qry, fcols)).where(F.lit(len(near) > 0))
    labels, rank, one = near["_c"].to_numpy(), np.arange(1, len(near) + 1), np.zeros(len(near), np.int64)
    vote = lambda k: int(_vote_block(labels, one, rank, 1, k)[0]) if len(near) else None
    return rows.withColumns({f"prediction_{k}": F.lit(vote(k)).cast("int") for k in ks})


def _voted(qry, ref, pdf, ks, fcols, keep, decimals, block_rows) -> DataFrame:
    """The query rows and their votes from the distances."""
    named = [f"prediction_{k}" for k in ks]
    if pdf is None:
        near = _knn_cells(qry.drop(*[f"_k{i}" for i in range(len(keep))]), ref, max(ks), fcols, None, False, "_label", decimals, block_rows)
        return qry.join(votes(near, "_label", ks).withColumnRenamed("query_id", "_qid"), "_qid") if keep else votes(near, "_label", ks).withColumnRenamed("query_id", "_qid")
    bc = qry.sparkSession.sparkContext.broadcast(_reference_groups(pdf, fcols, None, "_c", max(ks)))
    types = dict(qry.dtypes)
    carried = ["_qid", *[f"_k{i}" for i in range(len(keep))]]
    schema = ", ".join([f"{c} {types[c]}" for c in carried] + [f"{n} int" for n in named])

    def run(batches):
        r_ids, labels, R, tree = bc.value[None]
        for b in batches:
            if not len(b) or not len(r_ids):
                continue
            q_ids = b["_qid"].to_numpy(dtype="int64")
            qi, ri, _, rank = _topk_block(q_ids, _matrix(b, fcols), r_ids, R, max(ks), decimals, False, tree)
            rows = b[carried].copy()
            for k, name in zip(ks, named):
                rows[name] = _vote_block(labels[ri], qi, rank, len(b), k).astype("int32")
            yield rows

    return qry.mapInPandas(run, schema)


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    k: int,
    features: Sequence[str],
    id_col: str,
    label: str,
    **kw,
) -> DataFrame:
    """ML6: (id, prediction) for every test row by majority of its k nearest
    training rows."""
    return knn_vote(train, test, [k], features, id_col, label, **kw).select(id_col, F.col(f"prediction_{k}").alias("prediction"))
