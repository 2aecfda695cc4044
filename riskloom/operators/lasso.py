"""L1 feature selection (AGG9, ML4, ML5, AGG8).

Cross-validation needs, per fold, only the sufficient statistics
(n, Σx, Σy, XᵀX, Xᵀy, yᵀy).  They are computed for all folds in **one**
Spark aggregate (partial per task, then merged), which is O(rows · p²) work
and O(folds · p²) output whatever the table size.  The penalty path on
those p×p matrices is tiny and runs on the driver, and so does the final
full-data fit (the same objective, solved exactly from the summed
statistics).  MLlib's ``LinearRegression`` with a pure L1 penalty is kept as
``final_fit="mllib"``; it needs one Spark job per optimiser iteration.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_bucket
from riskloom.operators.prepare import checked_features


def _pair(a: str, b: str) -> str:
    return f"s_{a}__{b}"


#: A smaller coefficient is zero but for rounding (the first penalty is the one at which all vanish).
ZERO = 1e-9

WIDE_FEATURES = 50  # above this, statistics are summed as numpy blocks


def gram_by_fold(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    folds: int = 5,
    seed: int = 42,
    nulls: str = "raise",
) -> DataFrame:
    """AGG9: one row per fold with n, s_<f>, s_y, s_<f>__<g> (f ≤ g),
    s_<f>__y and s_yy.  Folds are md5 buckets of the key.  One aggregate
    column per statistic: for up to ``WIDE_FEATURES`` features (see
    ``gram_blocks`` for wider inputs).  Missing values as in
    ``checked_features``, so n counts just the rows that are summed."""
    fcols = list(features)
    df = checked_features(df, fcols, nulls)
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("s_y"), F.sum(y * y).alias("s_yy")]
    for i, a in enumerate(fcols):
        aggs.append(F.sum(a).alias(f"s_{a}"))
        aggs.append(F.sum(F.col(a) * y).alias(_pair(a, "y")))
        for b in fcols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(_pair(a, b)))
    return df.groupBy(hash_bucket(folds, seed, "fold", F.col(key)).cast("int").alias("fold")).agg(*aggs)


def gram_blocks(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    folds: int = 5,
    seed: int = 42,
    nulls: str = "raise",
) -> DataFrame:
    """AGG9 for wide inputs: (fold, stat, value) with the statistic names of
    ``gram_by_fold``.  Each task accumulates n, Σx, Σy, XᵀX, Xᵀy, yᵀy per
    fold with numpy over its Arrow batches and emits them once; a grouped
    sum (partial, then final) adds the tasks up.  Output: folds·O(p²) rows,
    whatever the table size."""
    import pandas as pd

    fcols = list(features)
    df = checked_features(df, fcols, nulls)
    p = len(fcols)
    iu = np.triu_indices(p)
    names = (
        ["n", "s_y", "s_yy"]
        + [f"s_{a}" for a in fcols]
        + [_pair(a, "y") for a in fcols]
        + [_pair(fcols[i], fcols[j]) for i, j in zip(*iu)]
    )

    def stats(batches):
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            X = b[fcols].to_numpy(dtype="float64")
            yv = b[label].to_numpy(dtype="float64")
            fv = b["_fold"].to_numpy()
            for fold in np.unique(fv):
                m = fv == fold
                Xf, yf = X[m], yv[m]
                v = np.concatenate(
                    [[len(yf), yf.sum(), yf @ yf], Xf.sum(axis=0), Xf.T @ yf, (Xf.T @ Xf)[iu]]
                )
                acc[int(fold)] = acc.get(int(fold), 0) + v
        for fold, v in acc.items():
            yield pd.DataFrame({"fold": fold, "stat": names, "value": v})

    keyed = df.select(
        *fcols, F.col(label).cast("double").alias(label), hash_bucket(folds, seed, "fold", F.col(key)).cast("int").alias("_fold")
    )
    partial = keyed.mapInPandas(stats, "fold int, stat string, value double")
    return partial.groupBy("fold", "stat").agg(F.sum("value").alias("value"))


def _fold_rows(df: DataFrame, fcols, label, key, folds, seed) -> list:
    """Fold statistics collected as one mapping per fold (folds × O(p²) numbers)."""
    if len(fcols) <= WIDE_FEATURES:
        return gram_by_fold(df, fcols, label, key, folds, seed).collect()
    rows: dict[int, dict] = {}
    for r in gram_blocks(df, fcols, label, key, folds, seed).collect():
        rows.setdefault(r["fold"], {"fold": r["fold"]})[r["stat"]] = r["value"]
    return list(rows.values())


def _unpack(row, fcols):
    p = len(fcols)
    sx = np.array([row[f"s_{a}"] for a in fcols], dtype=float)
    sxy = np.array([row[_pair(a, "y")] for a in fcols], dtype=float)
    sxx = np.zeros((p, p))
    for i, a in enumerate(fcols):
        for j in range(i, p):
            sxx[i, j] = sxx[j, i] = row[_pair(a, fcols[j])]
    return float(row["n"]), sx, float(row["s_y"]), sxx, sxy, float(row["s_yy"])


def _centered(st):
    n, sx, sy, sxx, sxy, _ = st
    mx, my = sx / n, sy / n
    return sxx / n - np.outer(mx, mx), sxy / n - mx * my, mx, my


def _cd(G, c, alpha, w, tol=1e-7, max_iter=10_000):
    """Coordinate descent for ½ wᵀGw − cᵀw + α‖w‖₁ (warm start ``w``)."""
    p = len(c)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(p):
            if G[j, j] <= 0:
                w[j] = 0.0
                continue
            rho = c[j] - G[j] @ w + G[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / G[j, j]
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta <= tol * max(1.0, np.abs(w).max()):
            break
    return w


def _path(G, c, alphas):
    """Lasso solutions of ½wᵀGw − cᵀw + α‖w‖₁ at the decreasing ``alphas``
    by the homotopy method: the solution is piecewise linear in α, and
    between breakpoints (a coordinate joins or leaves the active set) the
    active part solves G_AA w_A = c_A − α·sign_A.  Costs one small solve per
    breakpoint or requested α, instead of CD sweeps from a warm start.
    Coordinates with G_jj ≤ 0 (constant columns) stay at zero, as in ``_cd``."""
    p = len(c)
    usable = np.diag(G) > 0
    out = np.zeros((len(alphas), p))
    w = np.zeros(p)
    sign = np.zeros(p)
    active: list[int] = []
    cur = float(np.abs(c[usable]).max()) if usable.any() else 0.0
    r = c.copy()
    for t, target in enumerate(alphas):
        while cur > target:
            if not active:
                j = int(np.argmax(np.where(usable, np.abs(r), -np.inf)))
                active, sign[j] = [j], np.sign(r[j])
            A = np.array(active)
            d = np.linalg.solve(G[np.ix_(A, A)], sign[A])
            a = G[:, A] @ d
            gamma, event = cur - target, None
            for j in np.flatnonzero(usable):
                if j in active:
                    continue
                for num, den, sg in ((cur - r[j], 1.0 - a[j], 1.0), (cur + r[j], 1.0 + a[j], -1.0)):
                    if den > 1e-12 and 1e-15 < num / den < gamma:
                        gamma, event = num / den, ("join", j, sg)
            for i, j in enumerate(A):
                if d[i] != 0 and 1e-15 < -w[j] / d[i] < gamma:
                    gamma, event = -w[j] / d[i], ("drop", j, 0.0)
            w[A] += gamma * d
            cur -= gamma
            if event is not None and event[0] == "join":
                active.append(event[1])
                sign[event[1]] = event[2]
            elif event is not None:
                active.remove(event[1])
                w[event[1]], sign[event[1]] = 0.0, 0.0
            r = c - G @ w
        out[t] = w
    return out


def lasso_cv_from_stats(fold_rows, features: Sequence[str], n_alphas: int = 100, eps: float = 1e-3):
    """ML4: (best_alpha, alphas, mean held-out MSE per alpha) from fold stats."""
    fcols = list(features)
    stats = {r["fold"]: _unpack(r, fcols) for r in fold_rows}
    total = [sum(s[i] for s in stats.values()) for i in range(6)]
    G, c, _, _ = _centered(total)
    alpha_max = float(np.abs(c).max())
    if alpha_max <= 0:
        return 0.0, np.array([0.0]), np.array([0.0])
    alphas = np.logspace(np.log10(alpha_max), np.log10(alpha_max * eps), n_alphas)
    mse = np.zeros((n_alphas, len(stats)))
    for k, (fold, held) in enumerate(sorted(stats.items())):
        tr = [total[i] - held[i] for i in range(6)]
        Gt, ct, mx, my = _centered(tr)
        path = _path(Gt, ct, alphas)
        n_h, sx_h, sy_h, sxx_h, sxy_h, syy_h = held
        for a, alpha in enumerate(alphas):
            w = _cd(Gt, ct, alpha, path[a].copy())  # converges in a sweep from the path point
            b = my - mx @ w
            rss = syy_h - 2 * b * sy_h - 2 * w @ sxy_h + n_h * b * b + 2 * b * (w @ sx_h) + w @ sxx_h @ w
            mse[a, k] = rss / n_h
    mean = mse.mean(axis=1)
    return float(alphas[int(np.argmin(mean))]), alphas, mean


def lasso_select(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    folds: int = 5,
    seed: int = 42,
    final_fit: str = "gram",
) -> tuple[float, DataFrame]:
    """ML4 + ML5: best penalty by CV, then the L1 fit on all rows.

    ``final_fit="gram"`` solves the full-data problem exactly from the fold
    statistics already aggregated (no further pass over the data);
    ``"mllib"`` refits with MLlib ``LinearRegression`` (one Spark job per
    optimiser iteration).  Returns (alpha, DataFrame(feature, coefficient,
    selected)).
    """
    fcols = list(features)
    rows = _fold_rows(df, fcols, label, key, folds, seed)  # folds × O(p²) numbers
    alpha, _, _ = lasso_cv_from_stats(rows, fcols)
    spark = df.sparkSession
    if final_fit == "gram":
        stats = [_unpack(r, fcols) for r in rows]
        total = [sum(s[i] for s in stats) for i in range(6)]
        G, c, _, _ = _centered(total)
        coef = _cd(G, c, alpha, _path(G, c, np.array([alpha]))[0], tol=1e-12).tolist()
        out = spark.createDataFrame(
            [(f, float(w), bool(abs(w) > ZERO)) for f, w in zip(fcols, coef)],
            "feature string, coefficient double, selected boolean",
        )
        return alpha, out
    vec = VectorAssembler(inputCols=fcols, outputCol="_features").transform(df.withColumn("_y", F.col(label).cast("double")))
    lr = LinearRegression(
        featuresCol="_features",
        labelCol="_y",
        regParam=alpha,
        elasticNetParam=1.0,
        standardization=False,
        fitIntercept=True,
        maxIter=1000,
        tol=1e-9,
    )
    coef = lr.fit(vec).coefficients.toArray().tolist()
    out = spark.createDataFrame(
        [(f, float(w), bool(abs(w) > ZERO)) for f, w in zip(fcols, coef)],
        "feature string, coefficient double, selected boolean",
    )
    return alpha, out


class NoFeaturesSelected(ValueError):
    """Raised once when the L1 step keeps no feature (nothing to train on)."""


def selected_features(selection: DataFrame) -> list[str]:
    """The kept feature names (p rows at most) — raises when none is kept."""
    names = [r["feature"] for r in selection.where("selected").select("feature").collect()]
    if not names:
        raise NoFeaturesSelected("the L1 fit kept no feature")
    return names


def selection_summary(selection: DataFrame) -> DataFrame:
    """AGG8: (n_selected, n_total)."""
    return selection.agg(
        F.sum(F.col("selected").cast("long")).alias("n_selected"), F.count(F.lit(1)).alias("n_total")
    )
