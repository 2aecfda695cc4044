"""Classifiers (MLlib's tree and forest, own boosting and dense net), full-pipeline persistence and batch scoring
(ML7-ML10, ML13, ML14, FN20, PRJ12, SNK3, JON3).

Labels are trained as ``class - 1`` for every model and predictions are
always returned as class codes (``prediction + 1``), whichever model wins.
The persisted pipeline holds the fitted scaler too, so scoring raw rows
applies the same standardisation as training.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.boosting import BoostedTrees
from riskloom.operators.densenet import DenseNet
from riskloom.operators.prepare import PopulationScalerModel
from riskloom.sources.tables import require_columns

FEATURES_VEC = "features"
LABEL_IDX = "label_idx"
PREDICTION_CODE = "fraud_prediction"

# Model names in tie-break order (the reference compares in this order).
MODEL_ORDINAL = {"knn": 0, "decision_tree": 1, "random_forest": 2, "gbt": 3, "mlp": 4}


#: Models of cuts.  Where one meets a missing value it takes the side of the larger values; any other model raises.
CUTS = ("decision_tree", "random_forest", "gbt")

#: Hyper-parameters a caller may set, with their defaults.
PARAMETERS = {
    "decision_tree": {"maxDepth": 30, "maxBins": 256},
    "random_forest": {"numTrees": 100, "maxDepth": 30, "maxBins": 128},
    "gbt": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "penalty": 1.0, "leastHessian": 1.0, "maxBins": 256},
    "mlp": {"epochs": 50, "batchRows": 10},
}


def make_classifier(name: str, seed: int = 42, **params):
    """ML7-ML10 estimators with the reference's intent as defaults; a
    parameter that the model does not have raises."""
    if name not in PARAMETERS:
        raise ValueError(f"unknown model {name}: one of {sorted(PARAMETERS)}")
    unknown = sorted(set(params) - set(PARAMETERS[name]))
    if unknown:
        raise ValueError(f"unknown parameters of {name}: {unknown}")
    settings = {**PARAMETERS[name], **params, "featuresCol": FEATURES_VEC, "labelCol": LABEL_IDX, "seed": seed}
    if name == "decision_tree":
        return DecisionTreeClassifier(impurity="gini", **settings)
    if name == "random_forest":
        return RandomForestClassifier(featureSubsetStrategy="sqrt", **settings)
    if name == "gbt":
        settings.pop("seed")  # it draws nothing
        return BoostedTrees(**settings)
    return DenseNet(**settings)


def training_frame(df: DataFrame, label: str = "class") -> DataFrame:
    """PRJ4: 0-based label for MLlib."""
    return df.withColumn(LABEL_IDX, (F.col(label) - 1).cast("double"))


def separate_xy(df: DataFrame, features: Sequence[str], key: str, label: str = "class") -> DataFrame:
    """PRJ12: key, the feature vector in the order of ``features`` and the
    0-based label.  A missing value raises when it is read."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES_VEC, handleInvalid="error")
    return assembler.transform(training_frame(df, label)).select(key, FEATURES_VEC, LABEL_IDX)


def fit_pipeline(
    train: DataFrame,
    features: Sequence[str],
    model: str,
    scaler: PopulationScalerModel | None = None,
    label: str = "class",
    seed: int = 42,
    **params,
) -> PipelineModel:
    """PRJ12 + ML7-10: [scaler] → assembler → classifier → class code.

    ``train`` holds already-scaled rows; the fitted scaler, limited to the
    features the model uses, is prepended to the returned model so it can
    score raw rows that have just those columns.  A missing value in ``train``
    raises; the returned model scores every row if it is one of ``CUTS``.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES_VEC, handleInvalid="error")
    clf = make_classifier(model, seed, **params)
    to_code = SQLTransformer(statement=f"SELECT *, CAST(prediction + 1 AS INT) AS {PREDICTION_CODE} FROM __THIS__")
    fitted = Pipeline(stages=[assembler, clf, to_code]).fit(training_frame(train, label))
    scoring = assembler.copy({assembler.handleInvalid: "keep"}) if model in CUTS else assembler
    stages = ([scaler.restricted(features)] if scaler is not None else []) + [scoring, *fitted.stages[1:]]
    return PipelineModel(stages=stages)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """ML14: rows plus the predicted class code.  The key stays on every row,
    so no positional re-attachment is needed (JON3)."""
    out = model.transform(df)
    cols = list(keep) if keep is not None else [c for c in df.columns]
    return out.select(*cols, PREDICTION_CODE)


def evaluate(model_name: str, model: PipelineModel, test_scaled: DataFrame, label: str = "class") -> DataFrame:
    """ML11/SNK4 row: (model, ordinal, accuracy, n_test) on scaled test rows."""
    stages = model.stages[1:] if isinstance(model.stages[0], PopulationScalerModel) else model.stages
    pred = PipelineModel(stages=stages).transform(test_scaled)
    return pred.agg(
        F.avg((F.col(PREDICTION_CODE) == F.col(label)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test"),
    ).select(F.lit(model_name).alias("model"), F.lit(MODEL_ORDINAL[model_name]).alias("ordinal"), "accuracy", "n_test")


def probability_to_code(col: str = "probability", threshold: float = 0.5):
    """FN20: P(class index 1) > threshold → 1, then +1 → class code."""
    from pyspark.ml.functions import vector_to_array

    return ((vector_to_array(F.col(col))[1] > F.lit(threshold)).cast("int") + 1).alias("code")


# ------------------------------------------------------------------ one artefact for any winner
_CURRENT = "version string, kind string, features array<string>, key string, label string, k int"


def _publish(spark, path: str, version: str, kind: str, features: Sequence[str], key: str, label: str, k: int) -> str:
    """Name the version that is the model from now on.  A version is a folder
    of its own, written before it is named, so a reader sees one model
    whole and nothing of an earlier one."""
    row = [(version, kind, list(features), key, label, int(k))]
    spark.createDataFrame(row, _CURRENT).coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return path


def save_model(model: PipelineModel, path: str, kind: str, features: Sequence[str], key: str = "tx_id", label: str = "class") -> str:
    """SNK3: persist a fitted pipeline as the model under ``path``, replacing
    whatever kind was there."""
    from pyspark.sql import SparkSession

    version = uuid.uuid4().hex
    model.write().save(f"{path}/{version}/pipeline")
    return _publish(SparkSession.active(), path, version, kind, features, key, label, 0)


def save_knn(
    path: str, scaler: PopulationScalerModel, reference: DataFrame, features: Sequence[str], k: int, key: str = "tx_id", label: str = "class"
) -> str:
    """SNK3 for a k-NN winner: the scaler limited to its features and the
    scaled reference rows, as the model under ``path``."""
    version = uuid.uuid4().hex
    scaler.restricted(features).write().save(f"{path}/{version}/scaler")
    reference.select(key, label, *features).write.parquet(f"{path}/{version}/reference")
    return _publish(reference.sparkSession, path, version, "knn", features, key, label, k)


@dataclass
class LoadedModel:
    """ML13: what a model path holds, whichever model won."""

    path: str
    kind: str
    features: list[str]
    key: str
    label: str
    k: int

    @property
    def pipeline(self) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/pipeline")

    def score(self, rows: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """ML14: ``rows`` (their columns ``keep``, or all) + the predicted
        class code.  The columns it needs are the model's own (PRJ6).  Rows
        with missing features are scored too, but by a net, which raises."""
        from riskloom.operators.knn import knn_vote

        keep = list(rows.columns if keep is None else keep)
        rows = require_columns(rows, [self.key, *self.features] if self.kind == "knn" else self.features)
        if self.kind != "knn":
            return score(self.pipeline, rows, keep)
        reference = rows.sparkSession.read.parquet(f"{self.path}/reference")
        scaler = PopulationScalerModel.load(f"{self.path}/scaler")
        raw = {c: f"_raw_{c}" for c in keep}
        scaled = scaler.transform(rows.select(F.col(self.key), *self.features, *[F.col(c).alias(raw[c]) for c in keep if c != self.key]))
        voted = knn_vote(
            reference, scaled, [self.k], self.features, self.key, self.label, keep=[raw[c] for c in keep if c != self.key], query_nulls="keep"
        )
        return voted.select(*[F.col(c if c == self.key else raw[c]).alias(c) for c in keep], F.col(f"prediction_{self.k}").alias(PREDICTION_CODE))


def load_model(path: str) -> LoadedModel:
    """ML13: the model under ``path``; a missing path raises."""
    from pyspark.sql import SparkSession

    row = SparkSession.active().read.schema(_CURRENT).json(f"{path}/current").first()
    return LoadedModel(f"{path}/{row['version']}", row["kind"], list(row["features"]), row["key"], row["label"], row["k"])


def load_and_score(path: str, rows: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """ML13 + ML14 for batch and stream alike."""
    return load_model(path).score(rows, keep)
