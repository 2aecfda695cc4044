"""Physical-plan properties the design relies on (checked on executed plans)."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run it, so AQE's final plan is shown
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_partition_is_pruned(spark):
    plan = _plan(E.queries()["partition_scan"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(year" in plan and "(day#" in plan


def test_key_filter_reaches_the_scan(spark):
    plan = _plan(E.queries()["state_key_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,2-HIGH)]" in plan


def test_knn_has_no_pair_join(spark):
    for name in ("knn_vectors", "knn_neighbours"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_one_pass_votes_for_every_k_without_a_shuffle(spark):
    from riskloom.plans.registry import REGISTRY

    plan = _plan(REGISTRY["knn_accuracy"](spark, SF_SMALL))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("MapInPandas") == 1
    assert "hashpartitioning" not in final.split("MapInPandas")[0]  # only the single-row aggregate above it


def test_partitioned_writes_cluster_by_bytes(spark, tmp_path):
    from riskloom.sources.sinks import clustered, overwrite_partitions

    df = spark.range(0, 4000, 1, 40).selectExpr("id", "id % 4 as day")
    plan = _plan(clustered(df, ["day"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    overwrite_partitions(df, str(tmp_path / "t"), ["day"])
    assert len(list((tmp_path / "t").glob("day=*/*.parquet"))) <= 8  # not 40 tasks x 4 days


def test_key_and_salt_stay_out_of_the_plan(spark):
    from riskloom.operators.tokenize import tokenize

    df = spark.createDataFrame([("Ann",)], "name string")
    key, salt = "0123456789abcdef" * 2, "some-salt-text"
    t = tokenize(df, ["name"], salt, key, ("wk", "kid"))
    t.collect()
    for mode in ("extended", "formatted"):
        text = t._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
        assert key not in text and salt not in text and key.upper() not in text


def test_alert_fold_orders_counts_of_blocks_and_no_lines(spark):
    """The one window of the alert fold runs over (log, block) sums that are partially made in the scan."""
    from riskloom.operators.logscan import leading_parts

    parts = spark.createDataFrame([("a", 1, "x")], "log_id string, part_no long, part string")
    lines = leading_parts(parts, 301)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    plan = _plan(E.queries()["log_alerts"](spark, SF_SMALL))
    assert "row_number" not in plan and "WindowGroupLimit" not in plan
    windows = [i for i, text in enumerate(lines) if "Window" in text]
    assert all("Aggregate" in lines[i + 1] for i in windows)


def test_settled_check_aggregates_partially(spark):
    plan = _plan(E.queries()["input_settled"](spark, SF_SMALL))
    assert "partial_count" in plan and "partial_max" in plan
