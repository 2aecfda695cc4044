import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators.indexing import dense_index
from riskloom.operators.prepare import PopulationScaler, hash_split, one_hot_label, shift_label


def test_population_scaler_mean_zero_std_one(spark):
    rows = [(i, float(i), float(i * i), 5.0) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out = PopulationScaler(inputCols=["a", "b", "c"]).fit(df).transform(df).toPandas()
    for c in ("a", "b"):
        assert abs(out[c].mean()) < 1e-12
        assert abs(out[c].std(ddof=0) - 1) < 1e-12
    assert (out["c"] == 0).all()  # zero variance divides by 1


def test_scaler_persists(spark, tmp_path):
    from riskloom.operators.prepare import PopulationScalerModel

    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    m = PopulationScaler(inputCols=["a"], decimals=3).fit(df)
    m.write().overwrite().save(str(tmp_path / "s"))
    m2 = PopulationScalerModel.load(str(tmp_path / "s"))
    assert m2.getOrDefault("means") == [2.0] and m2.getOrDefault("stds") == [1.0]
    assert [r["a"] for r in m2.transform(df).collect()] == [-1.0, 1.0]


def test_hash_split_deterministic_and_fraction(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = hash_split(df, "k", 0.8, 42)
    b = hash_split(df.repartition(13), "k", 0.8, 42)
    assert a.exceptAll(b).count() == 0
    frac = a.where("split = 'test'").count() / 20000
    assert 0.78 < frac < 0.82


def test_label_shift_and_one_hot(spark):
    df = spark.createDataFrame([(1,), (2,)], "class int")
    out = one_hot_label(shift_label(df), "label").collect()
    assert [(r["label"], r["one_hot"]) for r in out] == [(0, [1, 0]), (1, [0, 1])]


def test_dense_index_exact_with_many_buckets(spark):
    rng = np.random.default_rng(0)
    keys = rng.choice(10**9, size=5000, replace=False).tolist()
    df = spark.createDataFrame([(int(k), int(k) % 3) for k in keys], "k long, g int").repartition(5)
    got = dense_index(df, "k", group_col="g", rows_per_bucket=300)
    want = df.withColumn("_want", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    j = got.join(want, ["k", "g"])
    assert j.count() == 5000
    assert j.where(F.col("_idx") != F.col("_want")).count() == 0


def test_labelled_transactions_same_on_both_label_paths(spark):
    from riskloom.fixtures import transactions

    sf = "/root/testdata/sf0.001"
    small = transactions(spark, sf, labelled_only=True)  # broadcast semi-join before the text work
    large = transactions(spark, sf, labelled_only=True, broadcast_bytes=0)  # features first, then the join
    assert "BroadcastHashJoin LeftSemi" not in large._jdf.queryExecution().executedPlan().toString()
    every = transactions(spark, sf).where("class in (1, 2)")
    assert small.count() == large.count() == every.count() > 0
    assert small.exceptAll(large).count() == 0 and every.exceptAll(small).count() == 0


def test_dense_index_with_known_group_counts(spark):
    df = spark.createDataFrame([(k, k % 3) for k in range(0, 3000, 7)], "k long, g int").repartition(4)
    counts = {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}
    a = dense_index(df, "k", group_col="g", group_counts=counts)
    b = dense_index(df, "k", group_col="g")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_missing_value_policy(spark):
    import pytest

    from riskloom.operators.lasso import gram_blocks, gram_by_fold
    from riskloom.operators.prepare import checked_features
    from riskloom.operators.smote import smote

    df = spark.createDataFrame([(i, 1 + (i > 9), float(i) if i % 3 else None) for i in range(30)], "tx_id long, class int, a double")
    for run in (
        lambda: PopulationScaler(inputCols=["a"]).fit(df), lambda: gram_by_fold(df, ["a"], "class", "tx_id"),
        lambda: gram_blocks(df, ["a"], "class", "tx_id"), lambda: smote(df, ["a"]), lambda: checked_features(df, ["a"]),
    ):
        with pytest.raises(ValueError, match="a"):
            run()
    assert checked_features(df, ["a"], "skip").count() == 20 and checked_features(df, ["a"], "keep").count() == 30
    assert gram_by_fold(df, ["a"], "class", "tx_id", nulls="skip").agg(F.sum("n")).first()[0] == 20
    skipped = PopulationScaler(inputCols=["a"], nulls="skip").fit(df).getOrDefault("means")
    assert skipped == PopulationScaler(inputCols=["a"], nulls="keep").fit(df).getOrDefault("means")


def test_restricted_scaler_needs_only_its_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 9.0)], "a double, b double")
    m = PopulationScaler(inputCols=["a", "b"]).fit(df).restricted(["b"])
    assert [r["b"] for r in m.transform(df.select("b")).collect()] == [-1.0, 1.0]


def test_broadcast_sides_are_bounded_in_bytes(spark):
    from riskloom.operators.joins import broadcast_if_small, fits

    narrow = spark.range(1000)
    assert fits(narrow, 1000 * 40) and not fits(narrow, 1000 * 40 - 41)
    wide = spark.range(10).selectExpr("id", "repeat('x', 10000) as text", "array(id, id) as a")
    assert not fits(wide, 90_000) and fits(wide, 110_000)
    plan = lambda side: spark.range(5).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(broadcast_if_small(wide)) and "broadcast" not in plan(broadcast_if_small(wide, 1000))


def test_a_cluster_session_must_name_a_shared_folder():
    import pytest

    from riskloom.session import SharedFolderMissing, ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(SharedFolderMissing, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
