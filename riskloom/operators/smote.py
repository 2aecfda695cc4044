"""Synthetic minority oversampling (ML3, JON2, SET1).

Every class smaller than the largest is topped up to the largest count.
Synthetic row i of class c takes base row ``h(seed,base,c,i) mod n_c`` (by
key order), its neighbour of rank ``h(seed,nn,c,i) mod k_c + 1`` among the
k_c = min(k, n_c - 1) nearest rows of the same class, and a gap
``u = h(seed,gap,c,i)`` in [0, 1): ``x = base + u * (neighbour - base)``.
All draws are md5 hashes, so the result does not depend on partitioning and
can be repeated in SQL.

Plan: the minority side is indexed (exact dense index) and joined with its
k-NN table once, giving (class, base index, rank) → (base, neighbour) pairs
of size n_c·k_c; the synthetic rows (``spark.range``) then need a single
equi-join with that table (a broadcast when it is measured small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_int, hash_unit
from riskloom.operators.indexing import dense_index
from riskloom.operators.joins import broadcast_if_small
from riskloom.operators.knn import knn_join
from riskloom.operators.prepare import checked_features

SYNTHETIC_ID_STRIDE = 1_000_000_000_000


def smote(
    train: DataFrame,
    features: Sequence[str],
    key: str = "tx_id",
    label: str = "class",
    k: int = 5,
    seed: int = 42,
    decimals: int = 6,
    nulls: str = "raise",
    **knn_kw,
) -> DataFrame:
    """Synthetic rows only: (key, label, *features, is_synthetic=true).

    Synthetic keys are negative: -(c·10^12 + i + 1).  Missing features as in
    ``checked_features``; the k-NN under it then need not check again.
    """
    spark = train.sparkSession
    train = checked_features(train, features, nulls)
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    fcols = list(features)
    empty = train.select(key, label, *fcols).where(F.lit(False)).withColumn("is_synthetic", F.lit(True))
    if not counts:
        return empty
    n_maj = max(counts.values())
    todo = {c: n for c, n in counts.items() if n < n_maj and n >= 2}
    if not todo:
        return empty
    minority = train.where(F.col(label).isin(list(todo))).select(key, label, *fcols)
    indexed = dense_index(minority, key, group_col=label, out="_idx", group_counts=todo)
    nn = knn_join(minority, minority, k, fcols, key, key, within=label, exclude_self=True, nulls="keep", **knn_kw)
    feats_b = indexed.select(
        F.col(label), F.col("_idx"), F.col(key).alias("_base"), *[F.col(f).alias(f"b_{f}") for f in fcols]
    )
    feats_n = minority.select(F.col(key).alias("_nbr"), *[F.col(f).alias(f"n_{f}") for f in fcols])
    pairs = (
        feats_b.join(nn.select(F.col("query_id").alias("_base"), F.col("rank").alias("_rank"), F.col("ref_id").alias("_nbr")), "_base")
        .join(feats_n, "_nbr")
    )
    draws = None
    for c, n_c in sorted(todo.items()):
        k_c = min(k, n_c - 1)
        i = F.col("id")
        d = spark.range(n_maj - n_c).select(
            F.lit(c).cast(dict(train.dtypes)[label]).alias(label),
            i.alias("_i"),
            F.pmod(hash_int(seed, "base", c, i), F.lit(n_c)).alias("_idx"),
            (F.pmod(hash_int(seed, "nn", c, i), F.lit(k_c)) + 1).cast("int").alias("_rank"),
            hash_unit(seed, "gap", c, i).alias("_u"),
        )
        draws = d if draws is None else draws.unionByName(d)
    # pairs has n_c·k rows; with a tiny minority each pair key meets many
    # draws, so it is broadcast when measured small (no skewed shuffle), and
    # otherwise shuffle-joined (keys then spread over many pairs)
    joined = draws.join(broadcast_if_small(pairs), [label, "_idx", "_rank"])
    u = F.col("_u")
    out = [
        (-(F.col(label).cast("long") * F.lit(SYNTHETIC_ID_STRIDE) + F.col("_i") + 1)).alias(key),
        F.col(label),
    ]
    for f in fcols:
        e = F.col(f"b_{f}") + u * (F.col(f"n_{f}") - F.col(f"b_{f}"))
        out.append((F.round(e, decimals) if decimals >= 0 else e).alias(f))
    return joined.select(*out, F.lit(True).alias("is_synthetic"))


def oversample(train: DataFrame, features: Sequence[str], key: str = "tx_id", label: str = "class", **kw) -> DataFrame:
    """SET1: real training rows plus synthetic ones, flagged by ``is_synthetic``."""
    real = train.select(key, label, *features).withColumn("is_synthetic", F.lit(False))
    return real.unionByName(smote(train, features, key, label, **kw))
