"""Approximate k-nearest-neighbour join by random projections (the approximate form of JON1).

Each of ``tables`` hash tables gives a vector a code: a bit for each of its projections, set above a
threshold.  A row's bucket is its code's first bits, as many as leave about ``bucket_rows`` rows a bucket.
A query looks into its own bucket and into the ``probes`` that follow from turning over the bits whose
projections lie nearest to their thresholds; distances to what it finds there are exact.

* Thresholds are quantiles (from a quarter to three quarters) of the projections of ``SAMPLE_ROWS`` reference
  rows, those of the smallest id hash; every reference row is indexed.
* Of equal reference vectors only the k + 1 smallest ids can be among k neighbours, so only they are indexed;
  a large group of copies makes no bucket of all pairs.
* A bucket over ``hot`` times its due is split by further bits of the code, until its parts are small or the
  bits run out.  Buckets are searched in tasks of a block of queries and a block of rows; both blocks are
  bounded whatever the bucket.
* A task takes the distances of its blocks together, by one matrix product and then exactly for the nearest.
* Only the k best of a task leave it; a query's lists are merged by id.

Empty tables give no row; a query with no candidate has none.  Null vectors and ids are left out; query rows
that share an id share a list.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_int
from riskloom.operators.joins import broadcast_if_small
from riskloom.operators.knn import _topk_block
from riskloom.session import materialize

SAMPLE_ROWS = 10_000
CODE_BITS = 48
BLOCK = 4_096
PAIR = "query_id long, ref_id long, distance double"


class Planes:
    """The projections and thresholds of all tables."""

    def __init__(self, sample: np.ndarray, tables: int, seed: int):
        draw = np.random.default_rng(seed)
        self.planes = draw.normal(size=(tables, CODE_BITS, sample.shape[1]))
        where = draw.uniform(0.25, 0.75, size=(tables, CODE_BITS))
        where[:, : CODE_BITS // 2] = 0.5
        self.at = np.array([[np.quantile(sample @ a, q) for a, q in zip(own, qs, strict=True)] for own, qs in zip(self.planes, where, strict=True)])

    def margins(self, table: int, x: np.ndarray) -> np.ndarray:
        return x @ self.planes[table].T - self.at[table]


def _code(bits: np.ndarray) -> np.ndarray:
    return bits.astype(np.int64) @ (1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64))


def codes(rows: DataFrame, planes: Planes, tables: int, bits: int, probes: int, vec: bool = True) -> DataFrame:
    """id, vec (if asked for), table, code: the code of every row in every table, and of ``probes`` turned bits."""
    held = rows.sparkSession.sparkContext.broadcast(planes)

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            x = np.stack(b["vec"].to_numpy())
            for t in range(tables):
                m = held.value.margins(t, x)
                own = _code(m > 0)
                near = np.argsort(np.abs(m[:, :bits]), axis=1, kind="stable")[:, : min(probes, bits)]
                turned = [own, *[own ^ (np.int64(1) << (CODE_BITS - 1 - near[:, j]).astype(np.int64)) for j in range(near.shape[1])]]
                for code in turned:
                    yield pd.DataFrame({"id": b["id"], **({"vec": b["vec"]} if vec else {}), "table": t, "code": code})

    return rows.mapInPandas(run, f"id long, {'vec array<double>, ' if vec else ''}table int, code long")


def _first(code, n):
    """The first ``n`` bits of a code, with their number, so that buckets of different depths differ."""
    return F.call_function("shiftright", code, (F.lit(CODE_BITS) - n).cast("int"))


def depths(ref: DataFrame, bits: int, most: int) -> DataFrame:
    """table, top, depth: the bits by which the rows of a hot bucket are told apart."""
    counted = materialize(ref.groupBy("table", "code").count(), "codes").withColumn("top", _first(F.col("code"), F.lit(bits)))
    hot = counted.groupBy("table", "top").agg(F.sum("count").alias("n")).where(F.col("n") > most)
    depth = hot.select("table", "top", F.least(F.lit(CODE_BITS), F.lit(bits) + F.ceil(F.log2(F.col("n") / most)).cast("int")).alias("depth"))
    depth = materialize(depth, "depths")
    while True:
        parts = counted.join(depth, ["table", "top"]).groupBy("table", "top", "depth", _first(F.col("code"), F.col("depth")).alias("part")).agg(F.sum("count").alias("n"))
        over = materialize(parts.groupBy("table", "top", "depth").agg(F.max("n").alias("n")), "over")
        if over.where((F.col("n") > most) & (F.col("depth") < CODE_BITS)).isEmpty():
            return depth
        deeper = F.when(F.col("n") > most, F.least(F.lit(CODE_BITS), F.col("depth") + 2)).otherwise(F.col("depth"))
        depth = materialize(over.select("table", "top", deeper.alias("depth")), "depths")


def approximate_knn_join(
    query: DataFrame, reference: DataFrame, k: int, vector: str, query_id: str, ref_id: str, *, exclude_self: bool = False, tables: int = 10,
    probes: int = 6, bucket_rows: int = 256, hot: int = 4, seed: int = 42, decimals: int = 9,
) -> DataFrame:
    """query_id, ref_id, rank, distance of up to k near reference rows of every query row, ties by id, and
    n_candidates (the distances computed for the query, over all tables)."""
    rows = lambda df, key: df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).dropna()
    own = rows(reference, ref_id).distinct().withColumn("copy", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
    own = materialize(own.where(F.col("copy") <= k + 1).drop("copy"), "reference")
    sample = own.orderBy(hash_int("sample", F.col("id")), "id").limit(SAMPLE_ROWS).toPandas()
    if not len(sample):
        return query.sparkSession.createDataFrame([], "query_id long, ref_id long, rank int, distance double, n_candidates long")
    planes = Planes(np.stack(sample["vec"].to_numpy()), tables, seed)
    bits = int(min(CODE_BITS // 2, max(1, np.ceil(np.log2(max(own.count() / bucket_rows, 2))))))
    ref = materialize(codes(own, planes, tables, bits, 0), "index")
    depth = depths(ref, bits, hot * bucket_rows)

    def placed(df: DataFrame) -> DataFrame:
        df = df.withColumn("top", _first(F.col("code"), F.lit(bits))).join(depth, ["table", "top"], "left")
        df = df.withColumn("depth", F.coalesce("depth", F.lit(bits)))
        return df.withColumn("bucket", _first(F.col("code"), F.col("depth"))).drop("top", "code")

    by = ["table", "depth", "bucket"]
    # A query row has many codes: they are counted without its vector and made again with it, never written.
    ask = lambda vec: placed(codes(rows(query, query_id), planes, tables, bits, probes, vec))
    ref, asked = placed(ref), ask(True)
    size = lambda df, name: df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    blocks = broadcast_if_small(size(ref, "r_blocks").join(size(ask(False), "q_blocks"), by))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    key = [*by, "q", "r"]
    left = asked.join(blocks, by).withColumn("q", mine("q_blocks")).withColumn("r", every("r_blocks")).select(*key, "id", "vec")
    right = ref.join(blocks, by).withColumn("r", mine("r_blocks")).withColumn("q", every("q_blocks")).select(*key, "id", "vec")
    right = right.toDF(*right.columns)  # columns of its own: both sides come from ``blocks``

    def near(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": [], "ref_id": [], "distance": [], "seen": []})
        seen = len(r)
        r = r.sort_values("id", kind="stable")
        q_ids, asks, ids, there = q["id"].to_numpy(), np.stack(q["vec"].to_numpy()), r["id"].to_numpy(), np.stack(r["vec"].to_numpy())
        told, known = np.isfinite(asks).all(1), np.isfinite(there).all(1)  # others are near nothing
        q_ids, asks, ids, there = q_ids[told], asks[told], ids[known], there[known]
        qi, ri, gap, rank = _topk_block(q_ids, asks, ids, there, k, decimals, exclude_self)
        return pd.DataFrame({"query_id": q_ids[qi], "ref_id": ids[ri], "distance": gap, "seen": np.where(rank == 1, seen, 0)})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(near, PAIR + ", seen long")
    found = found.groupBy("query_id", "ref_id").agg(F.min("distance").alias("distance"), F.sum("seen").alias("seen"))
    over = Window.partitionBy("query_id")
    ranked = found.withColumn("rank", F.row_number().over(over.orderBy("distance", "ref_id"))).withColumn("n_candidates", F.sum("seen").over(over))
    return ranked.where(F.col("rank") <= k).select("query_id", "ref_id", "rank", "distance", "n_candidates")
