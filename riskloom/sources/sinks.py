"""Sinks: CSV, dynamic partition overwrite, metric rows and stored marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK1: header CSV without an index column, written in parallel (one
    file per task; no coalesce to a single writer).  Quotes inside a field
    are doubled and line breaks stay inside their quotes (RFC 4180)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> str:
    """SNK2: dynamic partition overwrite — only partitions present in ``df``
    are replaced; every other partition under ``path`` is left as it is."""
    (
        clustered(df, partition_cols).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    return path


def clustered(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of a partition value brought together before a partitioned write,
    so tasks x partitions small files do not arise; AQE splits a value of
    more bytes than a task should hold and joins small ones."""
    return df.hint("rebalance", *[F.col(c) for c in partition_cols])


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> str:
    """SNK4: publish a run's metric rows (run_id, model, ..., accuracy,
    n_test).  A run published again replaces its own rows only."""
    overwrite_partitions(metrics.withColumn("run_id", F.lit(run_id)), path, ["run_id"])
    return path


def save_marks(marks: DataFrame, path: str, partition_col: str = "partition") -> str:
    """SNK5: stored high-water marks, replaced per partition."""
    return overwrite_partitions(marks, path, [partition_col])
