"""Evaluation and selection: accuracy, label mapping, histogram, best model
(AGG1, AGG2, AGG6, PRJ8, ML11, ML12, JON5/SET2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Display names of prediction codes.  Fixed values.
LICIT_CODE = 1
LICIT = "Licit"
ILLICIT = "Illicit"


def accuracy(pred: DataFrame, prediction: str = "prediction", label: str = "class") -> DataFrame:
    """AGG2: one row (accuracy, n_test) — fraction of equal predictions."""
    return pred.agg(
        F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test"),
    )


def label_names(col: str = "prediction"):
    """PRJ8: code 1 → 'Licit', anything else → 'Illicit'."""
    return F.when(F.col(col) == LICIT_CODE, F.lit(LICIT)).otherwise(F.lit(ILLICIT))


def prediction_histogram(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """AGG1 + PRJ8 + SRT1: counts per predicted code, sorted by code."""
    return (
        pred.groupBy(prediction)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("prediction_label", label_names(prediction))
        .orderBy(prediction)
    )


def union_metrics(frames: Sequence[DataFrame]) -> DataFrame:
    """SET2/JON5: fan-in of metric rows."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def best_model(metrics: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """AGG6/ML12: highest accuracy; ties → lowest ordinal (TakeOrdered, one row)."""
    return metrics.orderBy(F.desc("accuracy"), F.asc(ordinal)).limit(1)
