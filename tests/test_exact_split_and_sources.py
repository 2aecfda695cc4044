"""Exact-size split, CSV in splits, listing by prefixes, feature matrix, hidden keys."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_int, hidden, salted_sha256
from riskloom.operators.models import separate_xy
from riskloom.operators.prepare import exact_split
from riskloom.sources.sinks import write_csv
from riskloom.sources.tables import list_prefixes, read_csv_table


@pytest.mark.parametrize("ordered", [1, 50, 10_000])
@pytest.mark.parametrize("n,fraction", [(0, 0.8), (1, 0.8), (7, 0.8), (5000, 0.8), (5000, 0.3), (1000, 0.0), (1000, 1.0)])
def test_exact_split_takes_the_smallest_hashes(spark, n, fraction, ordered):
    df = spark.range(n).withColumnRenamed("id", "k")
    want = [r["k"] for r in df.orderBy(hash_int(42, F.col("k")), "k").limit(math.ceil(round(fraction * n, 6))).collect()] if n else []
    got = exact_split(df.repartition(7), "k", fraction, ordered=ordered).where("split = 'test'")
    assert sorted(r["k"] for r in got.collect()) == sorted(want)


def test_exact_split_of_repeated_and_null_keys(spark):
    rows = [(k % 50,) for k in range(1000)] + [(None,)] * 300
    out = exact_split(spark.createDataFrame(rows, "k long"), "k", 0.8, ordered=5)
    sides = out.groupBy("k").agg(F.countDistinct("split").alias("n"), F.first("split").alias("s")).collect()
    assert all(r["n"] == 1 for r in sides) and [r["s"] for r in sides if r["k"] is None] == ["train"]
    assert out.where("split = 'test'").count() == 800


def test_exact_split_sorts_nothing_as_a_whole(spark):
    plan = exact_split(spark.range(100_000).toDF("k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_csv_without_line_breaks_is_read_in_splits(spark, tmp_path):
    path = write_csv(spark.range(20_000).select("id", F.concat(F.lit('a "b", '), "id").alias("t")).coalesce(1), str(tmp_path / "c"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        whole = read_csv_table(spark, path, "id long, t string")
        cut = read_csv_table(spark, path, "id long, t string", lines_in_fields=False)
        assert whole.rdd.getNumPartitions() == 1 and cut.rdd.getNumPartitions() > 5
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    broken = write_csv(spark.createDataFrame([(1, "two\nlines")], "id long, t string"), str(tmp_path / "b"))
    assert read_csv_table(spark, broken, "id long, t string").count() == 1
    with pytest.raises(Exception):  # noqa: B017 - the reader's own error for a malformed row
        read_csv_table(spark, broken, "id long, t string", lines_in_fields=False).collect()


def test_prefixes_are_listed_in_tasks(spark, tmp_path):
    for name, text in {"a/x.txt": "12345", "a/deep/y.txt": "", "b/z.txt": "é"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "empty").mkdir()
    prefixes = [(f"file://{tmp_path}/a",), (f"file:{tmp_path}/b",), (f"file://{tmp_path}/empty",), (f"file://{tmp_path}/gone",), (None,), (f"file://{tmp_path}/a",)]
    rows = list_prefixes(spark.createDataFrame(prefixes, "prefix string")).collect()
    assert sorted((r["name"], r["length"]) for r in rows) == [("x.txt", 5), ("y.txt", 0), ("z.txt", 2)]
    for r in rows:
        assert r["path"].endswith(r["name"]) and abs(r["mtime"].timestamp() - (tmp_path / r["path"]).stat().st_mtime) < 86_400


def test_feature_matrix_keeps_order_and_refuses_missing_values(spark):
    df = spark.createDataFrame([(1, 2, 0.5, 7.0), (2, 1, 1.5, 8.0)], "k long, class int, x double, y double")
    assert [(r["k"], r["features"].toArray().tolist(), r["label_idx"]) for r in separate_xy(df, ["y", "x"], "k").orderBy("k").collect()] == [(1, [7.0, 0.5], 1.0), (2, [8.0, 1.5], 0.0)]
    with pytest.raises(Exception):  # noqa: B017
        separate_xy(df.withColumn("x", F.lit(None).cast("double")), ["x"], "k").collect()


def test_hidden_values_show_in_no_plan_and_need_no_job(spark):
    out = spark.range(3).select(salted_sha256(F.col("id"), hidden(spark, "very secret")).alias("h"))
    query = out._jdf.queryExecution()
    assert "very secret" not in query.toString() and "Scan ExistingRDD" not in query.executedPlan().toString()
    assert out.first()["h"] == spark.sql("select sha2('very secret0', 256)").first()[0]
