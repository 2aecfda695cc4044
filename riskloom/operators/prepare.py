"""Feature preparation: class filter, label shift, population scaler,
deterministic split, one-hot label (PRJ3, PRJ4, AGG3, FN18, ML1, ML2, FN19,
AGG10)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_bucket, hash_int


NULL_POLICIES = ("raise", "skip", "keep")


def checked_features(df: DataFrame, features: Sequence[str], nulls: str = "raise") -> DataFrame:
    """The missing-value policy (D11) of everything that computes with features:
    ``raise`` names the columns with NULL or NaN values, ``skip`` leaves out
    the rows that have one, ``keep`` passes them on."""
    if nulls not in NULL_POLICIES:
        raise ValueError(f"unknown policy {nulls!r}: one of {NULL_POLICIES}")
    if nulls == "keep" or not features:
        return df
    missing = [_missing(df, f) for f in features]
    if nulls == "skip":
        return df.where(~any_missing(df, features))
    row = df.agg(*[F.coalesce(F.bool_or(m), F.lit(False)).alias(f"m{i}") for i, m in enumerate(missing)]).first()
    bad = [f for i, f in enumerate(features) if row[f"m{i}"]]
    if bad:
        raise ValueError(f"features with missing values: {bad}")
    return df


def any_missing(df: DataFrame, features: Sequence[str]):
    """Whether a row has a NULL or NaN value in one of ``features``; never NULL itself."""
    return reduce(or_, [_missing(df, f) for f in features])


def _missing(df: DataFrame, feature: str):
    c = F.col(f"`{feature}`")
    if dict(df.dtypes)[feature].startswith("array"):
        return c.isNull() | F.coalesce(F.exists(c, lambda x: x.isNull() | F.isnan(x)), F.lit(False))
    return c.isNull() | F.coalesce(F.isnan(c.cast("double")), F.lit(False))


def filter_classes(df: DataFrame, classes: Sequence[int], label: str = "class") -> DataFrame:
    """PRJ3: keep rows whose label is in ``classes`` (IN-list, pushed to the scan)."""
    return df.where(F.col(label).isin(list(classes)))


def shift_label(df: DataFrame, label: str = "class", out: str = "label", by: int = -1) -> DataFrame:
    """PRJ4: class codes {1,2,..} ↔ 0-based labels."""
    return df.withColumn(out, (F.col(label) + F.lit(by)).cast("int"))


def one_hot_label(df: DataFrame, label: str = "label", n_classes: int = 2, out: str = "one_hot") -> DataFrame:
    """FN19: 0-based label → array of n_classes 0/1 integers."""
    return df.withColumn(out, F.array(*[(F.col(label) == i).cast("int") for i in range(n_classes)]))


def class_counts(df: DataFrame, label: str = "class") -> DataFrame:
    """AGG10: rows per class (partial + final hash aggregate)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def hash_split(
    df: DataFrame, key: str, test_fraction: float = 0.8, seed: int = 42, out: str = "split"
) -> DataFrame:
    """ML2: deterministic train/test assignment from md5(seed:key).

    Independent of partitioning and of row order, so a rerun after executor
    loss assigns every row identically (unlike randomSplit).
    """
    pct = int(round(test_fraction * 100))
    side = F.when(hash_bucket(100, seed, F.col(key)) < pct, F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn(out, side)


#: Buckets counted at a time, and hashes of a bucket ordered at the end, in :func:`exact_split`.
SPLIT_BITS, SPLIT_ORDERED = 16, 10_000
HASH_BITS = 60


def exact_split(
    df: DataFrame, key: str, test_fraction: float = 0.8, seed: int = 42, out: str = "split", ordered: int = SPLIT_ORDERED
) -> DataFrame:
    """ML2 with a test part of exactly ceil(test_fraction * n) rows: those of
    the smallest md5(seed:key), ties by the key.

    The row at that rank is found by selection: rows are counted by the first
    bits of the hash, the bucket that holds the rank is counted by the next,
    until it has no more than ``ordered`` hashes to put in order.  Only the
    key column is read, counts (2^16 a round) are all that moves, and nothing
    is sorted as a whole; the split itself is a comparison in place.  Keys
    that are null belong to the train part and are not counted; rows that
    share a key share a side, so repeats of the border key move the size."""
    h = hash_int(seed, F.col(key))
    rows = df.where(F.col(key).isNotNull()).select(h.alias("h"), F.col(key).alias("k"))
    bits, below = HASH_BITS, 0
    n = None
    while True:
        shift = max(bits - SPLIT_BITS, 0)
        counts = rows.groupBy(F.shiftright("h", shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        if n is None:
            n = sum(r["n"] for r in counts)
            rank = math.ceil(round(test_fraction * n, 6))
        if rank == 0:
            return df.withColumn(out, F.lit("train"))
        for r in sorted(counts):
            if below + r["n"] >= rank:
                break
            below += r["n"]
        rows = rows.where(F.shiftright("h", shift) == r["b"])
        bits = shift
        if r["n"] <= ordered or not shift:
            break
    # at most ``ordered`` rows, or the few keys of one 60-bit hash
    for border in rows.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "k").limit(rank - below).collect():
        below += border["n"]
        if below >= rank:
            break
    test = F.col(key).isNotNull() & ((h < border["h"]) | ((h == border["h"]) & (F.col(key) <= F.lit(border["k"]))))
    return df.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train")))


class _ScalerParams(HasInputCols):
    decimals = Param(Params._dummy(), "decimals", "round outputs to this many decimals (-1: no rounding)",
                     typeConverter=TypeConverters.toInt)
    nulls = Param(Params._dummy(), "nulls", "missing values at fit: raise, skip or keep", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(decimals=-1, nulls="raise")


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """ML1: standardise with the mean and the *population* standard deviation;
    zero-variance columns divide by 1.

    ``fit`` runs one aggregate (avg + stddev_pop for all columns, partial then
    final) and returns a model holding 2·p numbers; ``transform`` is a pure
    projection of literals, so it stays inside whole-stage codegen and needs
    no join with the statistics.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, decimals=-1, nulls="raise"):
        super().__init__()
        kwargs = self._input_kwargs
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        policy = self.getOrDefault("nulls")
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"), F.coalesce(F.bool_or(_missing(dataset, c)), F.lit(False)).alias(f"x_{c}")]
        if policy == "skip":
            dataset = checked_features(dataset, cols, policy)
        row = dataset.agg(*aggs).first()
        if policy == "raise" and (bad := [c for c in cols if row[f"x_{c}"]]):
            raise ValueError(f"features with missing values: {bad}")
        means = [float(row[f"m_{c}"]) for c in cols]
        stds = [float(row[f"s_{c}"]) for c in cols]
        model = PopulationScalerModel(inputCols=cols, means=means, stds=stds, decimals=self.getOrDefault("decimals"))
        return self._copyValues(model)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviations", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, means=None, stds=None, decimals=-1):
        super().__init__()
        kwargs = self._input_kwargs
        self._set(**kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        means = self.getOrDefault("means")
        stds = self.getOrDefault("stds")
        dec = self.getOrDefault("decimals")
        out = {}
        for c, m, s in zip(cols, means, stds):
            e = (F.col(c) - F.lit(m)) / F.lit(s if s != 0.0 else 1.0)
            out[c] = F.round(e, dec) if dec >= 0 else e
        return dataset.withColumns(out)

    def restricted(self, features: Sequence[str]) -> "PopulationScalerModel":
        """The same scaling for a subset of the columns, in the given order."""
        at = [self.getInputCols().index(f) for f in features]
        pick = lambda p: [self.getOrDefault(p)[i] for i in at]
        return PopulationScalerModel(inputCols=list(features), means=pick("means"), stds=pick("stds"), decimals=self.getOrDefault("decimals"))


def scaler_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """AGG3 as a query: one row of mean/population std per feature, computed
    in a single aggregate and unpivoted to (feature, mean, std)."""
    aggs = []
    for c in features:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    wide = df.agg(*aggs)
    stacked = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std"))
                  for c in features])
    ).alias("r")
    return wide.select(stacked).select("r.feature", "r.mean", "r.std")
