"""E1 — the training run as one Spark job graph.

The reference re-reads, re-scales, re-splits and re-oversamples the data in
each of its trainers.  Here the labelled table is prepared once and cut from
its lineage by writing it as a table in the shared checkpoint folder (so a
lost executor does not force recomputing the text features); every trainer
reads that copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.fixtures import FEATURES, KEY, LABEL, transactions
from riskloom.operators.knn import knn_join, knn_predict, knn_vote
from riskloom.operators.prepare import PopulationScaler, PopulationScalerModel, filter_classes, hash_split
from riskloom.operators.smote import oversample
from riskloom.session import materialize

TRAIN_CLASSES = (1, 2)
SCORE_CLASSES = (3,)
DECIMALS = 6


@dataclass
class Prepared:
    """Scaled labelled rows with their split, the fitted scaler, and the
    scaled rows to score."""

    scaler: PopulationScalerModel
    split: DataFrame  # tx_id, class, f_*, split
    features: list[str]
    _oversampled: dict | None = None

    @property
    def train(self) -> DataFrame:
        return self.split.where(F.col("split") == "train").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.split.where(F.col("split") == "test").drop("split")


def prepare(
    spark: SparkSession,
    sf_dir: str,
    features: Sequence[str] = FEATURES,
    test_fraction: float = 0.8,
    seed: int = 42,
    fit_on: str = "all",
    checkpoint: bool = True,
    labelled_only: bool = False,
) -> tuple[Prepared, DataFrame]:
    """Label filter → scaler fit → scale → deterministic split.

    ``fit_on="all"`` fits the scaler on every labelled row before the split
    (the reference's order); ``"train"`` fits on the training side only.
    Returns the prepared labelled data and the full transaction table.
    ``labelled_only`` is for callers that score no class-3 rows: documents
    without a label are dropped before the text features, and the returned
    table holds the labelled rows only (the prepared data is the same).
    """
    tx = transactions(spark, sf_dir, labelled_only=labelled_only)
    if checkpoint:
        tx = materialize(tx, "transactions")
    labelled = filter_classes(tx, TRAIN_CLASSES)
    scaler_in = labelled
    if fit_on == "train":
        scaler_in = hash_split(labelled, KEY, test_fraction, seed).where(F.col("split") == "train")
    scaler = PopulationScaler(inputCols=list(features), decimals=DECIMALS).fit(scaler_in)
    split = hash_split(scaler.transform(labelled.select(KEY, LABEL, *features)), KEY, test_fraction, seed)
    return Prepared(scaler, split, list(features)), tx


def oversampled_train(p: Prepared, k: int = 5, seed: int = 42, checkpoint: bool = True) -> DataFrame:
    """Training side plus SMOTE rows (classes balanced), computed once per
    prepared run and checkpointed to the shared folder: every trainer and
    the k-NN reads the same copy instead of re-running SMOTE."""
    if p._oversampled is None:
        p._oversampled = {}
    key = (k, seed, checkpoint)
    if key not in p._oversampled:
        df = oversample(p.train, p.features, KEY, LABEL, k=k, seed=seed, decimals=DECIMALS)
        p._oversampled[key] = materialize(df, "oversampled-train") if checkpoint else df
    return p._oversampled[key]


def knn_neighbours(p: Prepared, k: int = 5) -> DataFrame:
    """JON1/WIN2: the k nearest (oversampled) training rows of every test row."""
    train = oversampled_train(p)
    return knn_join(p.test, train, k, p.features, KEY, KEY, carry=LABEL)


def knn_accuracy(p: Prepared, ks: Sequence[int] = (5,)) -> DataFrame:
    """ML6 + ML11: one metric row per k: (model, k, accuracy, n_test).

    One pass over the distances: each test row is returned once, with its
    truth and the vote of every k, and one aggregate counts the hits.
    """
    voted = knn_vote(oversampled_train(p), p.test, ks, p.features, KEY, LABEL, keep=[LABEL])
    hit = lambda k: F.avg((F.col(f"prediction_{k}") == F.col(LABEL)).cast("double"))
    wide = voted.agg(*[hit(k).alias(f"a{k}") for k in ks], F.count(F.lit(1)).alias("n_test"))
    row = lambda k: F.struct(F.lit(f"knn_k{k}").alias("model"), F.lit(k).alias("k"), F.col(f"a{k}").alias("accuracy"), F.col("n_test"))
    return wide.select(F.inline(F.array(*[row(k) for k in ks])))


def score_unlabelled(p: Prepared, tx: DataFrame, k: int = 5) -> DataFrame:
    """ML14 with k-NN: (tx_id, prediction) for the rows to score (class 3),
    scaled with the fitted scaler; every row is scored, those with missing
    features too."""
    to_score = p.scaler.transform(filter_classes(tx, SCORE_CLASSES).select(KEY, LABEL, *p.features))
    return knn_predict(oversampled_train(p), to_score, k, p.features, KEY, LABEL, query_nulls="keep")


# ---------------------------------------------------------------- selection and trainers
def select_features(p: Prepared, k: int = 5, seed: int = 42):
    """ML4/ML5 on the oversampled training side: (alpha, selection frame)."""
    from riskloom.operators.lasso import lasso_select

    return lasso_select(oversampled_train(p, k, seed), p.features, LABEL, KEY, folds=5, seed=seed)


def train_model(p: Prepared, train: DataFrame, name: str, features: Sequence[str], **params):
    """Fit one MLlib pipeline and its metric row on the test side."""
    from riskloom.operators.models import evaluate, fit_pipeline

    model = fit_pipeline(train, features, name, scaler=p.scaler, **params)
    return model, evaluate(name, model, p.test)


def training_run(
    p: Prepared,
    models: Sequence[str] = ("decision_tree", "random_forest", "gbt", "mlp"),
    params: dict | None = None,
    model_path: str | None = None,
    k: int = 5,
    seed: int = 42,
):
    """E1: oversample → L1 selection → k-NN + MLlib trainers (fitted from a
    small driver thread pool, so Spark runs their jobs side by side) →
    metrics → best model saved.  Returns (metrics DataFrame, best name)."""
    from concurrent.futures import ThreadPoolExecutor

    from riskloom.operators.evaluate import best_model, union_metrics
    from riskloom.operators.lasso import selected_features
    from riskloom.operators.models import MODEL_ORDINAL, save_model

    params = params or {}
    train = oversampled_train(p, k, seed)
    from riskloom.operators.lasso import lasso_select

    _, selection = lasso_select(train, p.features, LABEL, KEY, folds=5, seed=seed)
    feats = selected_features(selection)
    with ThreadPoolExecutor(max_workers=max(1, len(models))) as pool:
        futures = {m: pool.submit(train_model, p, train, m, feats, **params.get(m, {})) for m in models}
        fitted = {m: f.result() for m, f in futures.items()}
    voted = knn_vote(train, p.test, [k], feats, KEY, LABEL, keep=[LABEL])
    knn_metric = voted.agg(
        F.avg((F.col(f"prediction_{k}") == F.col(LABEL)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test"),
    ).select(F.lit("knn").alias("model"), F.lit(MODEL_ORDINAL["knn"]).alias("ordinal"), "accuracy", "n_test")
    metrics = materialize(union_metrics([knn_metric] + [fitted[m][1] for m in models]), "metrics")
    best = best_model(metrics).first()["model"]
    if model_path is not None:
        if best in fitted:
            save_model(fitted[best][0], model_path, best, feats, KEY, LABEL)
        else:
            from riskloom.operators.models import save_knn

            save_knn(model_path, p.scaler, train, feats, k)
    return metrics, best, {m: v[0] for m, v in fitted.items()}
