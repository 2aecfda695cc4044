"""Lake SQL helpers (SRC4, AGG7): a guarded statement returning one count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.text import is_leading_drop_alter


def lake_count(spark: SparkSession, query: str) -> DataFrame:
    """Run ``query`` (refused when it starts with drop/alter) and return its
    first column as a one-row DataFrame ``(n long)``.  The count stays a
    distributed aggregate; only the caller decides whether to collect it."""
    if is_leading_drop_alter(query):
        raise ValueError(f"refused: a statement that drops or alters: {query}")
    df = spark.sql(query)
    first = df.columns[0]
    return df.select(F.col(first).cast("long").alias("n")).limit(1)


def lake_count_value(spark: SparkSession, query: str) -> int:
    """Scalar form: the count as an int, or -1 when the statement fails."""
    try:
        row = lake_count(spark, query).first()
    except ValueError:
        raise
    except Exception:  # noqa: BLE001 — the reference returns -1 on any failure
        return -1
    return int(row["n"]) if row is not None and row["n"] is not None else -1
