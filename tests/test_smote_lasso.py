import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.lasso import _cd, _path, gram_blocks, gram_by_fold, lasso_cv_from_stats, lasso_select, selected_features, NoFeaturesSelected
from riskloom.operators.smote import oversample, smote


@pytest.fixture(scope="module")
def imbalanced(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 1 if i < 12 else 2, *map(float, rng.normal(size=2) + (3 if i < 12 else 0))) for i in range(60)]
    return spark.createDataFrame(rows, "tx_id long, class int, a double, b double")


def test_smote_balances_and_interpolates(spark, imbalanced):
    out = oversample(imbalanced, ["a", "b"], k=5, seed=42, decimals=-1)
    counts = {r["class"]: r["count"] for r in out.groupBy("class").count().collect()}
    assert counts == {1: 48, 2: 48}
    mino = imbalanced.where("class = 1").toPandas()[["a", "b"]].to_numpy()
    syn = out.where("is_synthetic").toPandas()
    assert (syn["tx_id"] < 0).all() and syn["tx_id"].is_unique
    for x in syn[["a", "b"]].to_numpy():
        # x lies on a segment between two minority points
        ok = False
        for i in range(len(mino)):
            for j in range(len(mino)):
                if i == j:
                    continue
                d = mino[j] - mino[i]
                t = np.dot(x - mino[i], d) / np.dot(d, d)
                if -1e-9 <= t <= 1 + 1e-9 and np.allclose(mino[i] + t * d, x, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok


def test_smote_deterministic_under_repartition(spark, imbalanced):
    a = smote(imbalanced, ["a", "b"])
    b = smote(imbalanced.repartition(5), ["a", "b"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_smote_single_minority_row_adds_nothing(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (2, 2, 1.0), (3, 2, 2.0)], "tx_id long, class int, a double")
    assert smote(df, ["a"]).count() == 0


def test_cd_satisfies_kkt():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 5))
    y = X @ np.array([1.0, 0, -2.0, 0, 0.5]) + rng.normal(size=200) * 0.1
    Xc, yc = X - X.mean(0), y - y.mean()
    G, c = Xc.T @ Xc / 200, Xc.T @ yc / 200
    alpha = 0.1
    w = _cd(G, c, alpha, np.zeros(5), tol=1e-12)
    grad = c - G @ w
    for j in range(5):
        if w[j] != 0:
            assert abs(grad[j] - alpha * np.sign(w[j])) < 1e-8
        else:
            assert abs(grad[j]) <= alpha + 1e-8


def test_homotopy_path_equals_coordinate_descent():
    rng = np.random.default_rng(11)
    base = rng.normal(size=(300, 3))
    # correlated columns, a near copy and a constant column
    X = np.column_stack([base, base[:, 0] * 0.9 + rng.normal(size=300) * 0.1, base[:, 1] + base[:, 2], np.ones(300)])
    y = X[:, 0] - 0.5 * X[:, 3] + 0.3 * X[:, 4] + rng.normal(size=300) * 0.3
    Xc, yc = X - X.mean(0), y - y.mean()
    G, c = Xc.T @ Xc / 300, Xc.T @ yc / 300
    alphas = np.logspace(np.log10(np.abs(c).max()), np.log10(np.abs(c).max() * 1e-3), 100)
    path = _path(G, c, alphas)
    assert np.all(path[0] == 0) and np.all(path[:, 5] == 0)
    for a in (0, 10, 40, 70, 99):
        w = _cd(G, c, alphas[a], np.zeros(6), tol=1e-13, max_iter=200_000)
        assert np.allclose(path[a], w, atol=1e-7)


def test_lasso_selection_and_cv(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(400, 4))
    y = 2.0 * X[:, 0] - 1.0 * X[:, 2] + rng.normal(size=400) * 0.5
    rows = [(i, float(y[i]), *map(float, X[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, y double, x0 double, x1 double, x2 double, x3 double")
    feats = ["x0", "x1", "x2", "x3"]
    g = gram_by_fold(df, feats, "y", "k")
    assert g.agg(F.sum("n")).first()[0] == 400
    alpha, alphas, mse = lasso_cv_from_stats(g.collect(), feats)
    assert alphas[0] > alphas[-1] and alpha in alphas
    a, sel = lasso_select(df, feats, "y", "k", final_fit="mllib")
    a2, sel2 = lasso_select(df, feats, "y", "k")
    assert a2 == a
    assert np.allclose([r["coefficient"] for r in sel2.collect()], [r["coefficient"] for r in sel.collect()], atol=1e-4)
    kept = selected_features(sel)
    assert "x0" in kept and "x2" in kept
    # MLlib's L1 fit agrees with the driver-side solver on the full data
    Xc, yc = X - X.mean(0), y - y.mean()
    w = _cd(Xc.T @ Xc / 400, Xc.T @ yc / 400, a, np.zeros(4), tol=1e-12)
    coef = {r["feature"]: r["coefficient"] for r in sel.collect()}
    assert np.allclose([coef[f] for f in feats], w, atol=1e-4)


def test_no_feature_selected_raises(spark):
    sel = spark.createDataFrame([("a", 0.0, False)], "feature string, coefficient double, selected boolean")
    with pytest.raises(NoFeaturesSelected):
        selected_features(sel)


def test_gram_blocks_equal_gram_columns(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(500, 7))
    rows = [(i, float(X[i] @ np.arange(7)), *map(float, X[i])) for i in range(500)]
    feats = [f"x{j}" for j in range(7)]
    df = spark.createDataFrame(rows, "k long, y double, " + ", ".join(f"{f} double" for f in feats)).repartition(4)
    wide = {r["fold"]: r.asDict() for r in gram_by_fold(df, feats, "y", "k").collect()}
    long = gram_blocks(df, feats, "y", "k").collect()
    assert len(long) == 5 * (3 + 2 * 7 + 7 * 8 // 2)
    for r in long:
        assert np.isclose(wide[r["fold"]][r["stat"]], r["value"], rtol=1e-12, atol=1e-9), r
