import datetime as dt

from pyspark.sql import functions as F

from riskloom.operators.lakeops import (
    remaining_items,
    retention_candidates,
    settled_check,
    state_attributes,
    state_ranges,
)
from riskloom.operators.timeslots import parse_timestr, time_slots


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_settled_rules(spark):
    inv = spark.createDataFrame(
        [("p1", "a", _ts("2024-01-01 10:00:00")), ("p1", "b", _ts("2024-01-01 11:00:00")), ("p2", "c", _ts("2024-01-02 09:00:00"))],
        "partition string, path string, mtime timestamp",
    )
    marks = spark.createDataFrame(
        [("p1", _ts("2024-01-01 11:00:00")), ("p2", _ts("2024-01-02 08:00:00")), ("p3", _ts("2024-01-03 00:00:00"))],
        "partition string, stored_mark timestamp",
    )
    out = {r["partition"]: r for r in settled_check(inv, marks).collect()}
    assert out["p1"]["settled"] and out["p1"]["new_mark"] == _ts("2024-01-01 11:00:00")
    assert not out["p2"]["settled"] and out["p2"]["new_mark"] == _ts("2024-01-02 09:00:00")
    assert not out["p3"]["settled"] and out["p3"]["n_objects"] == 0  # empty → not settled


def test_state_ranges_and_attributes(spark):
    items = spark.createDataFrame(
        [
            ("k", 1, "2024-01-02", "2024-01-03", "x1", None),
            ("k", 2, "2024-01-01", "", "x2", "y2"),
            ("k", 3, "2024-01-05", "2024-01-09", None, "y3"),
            ("j", 4, None, "2024-01-01", "z", None),
            (None, 5, "a", "b", "n", None),
        ],
        "pk string, seq long, min_ts string, max_ts string, u string, v string",
    )
    r = {row["pk"]: (row["min_ts"], row["max_ts"]) for row in state_ranges(items).collect()}
    assert r["k"] == ("2024-01-02", "2024-01-09") and r["j"] == (None, None)
    a = {(row["pk"], row["attribute"]): row["value"] for row in state_attributes(items, ["u", "v", "w"]).collect()}
    assert a[("k", "u")] == "x2" and a[("k", "v")] == "y3" and ("j", "v") not in a
    left = remaining_items(items, ["k"]).collect()
    assert sorted((row["pk"] or "") for row in left) == ["", "j"]


def test_time_slot_counts(spark):
    def n_slots(start, end, hours):
        b = spark.createDataFrame([(start, end)], "s string, e string").select(
            parse_timestr("s").alias("s"), parse_timestr("e").alias("e")
        )
        return [r["slot"] for r in time_slots(b, "s", "e", "%Y%m%d/%H", hours, auto_encode=True).orderBy(F.col("idx").cast("int")).collect()]

    assert n_slots("20240101/00", "20240101/03", 1) == ["20240101_00", "20240101_01", "20240101_02", "20240101_03"]
    assert n_slots("20240101/00", "20240101/05", 2) == ["20240101_00", "20240101_02", "20240101_04"]
    assert n_slots("20240101/05", "20240101/04", 2) == ["20240101_05"]  # less than one interval before
    assert n_slots("20240101/05", "20240101/01", 2) == []  # earlier by more than an interval


def test_retention_excludes_directories(spark):
    inv = spark.createDataFrame(
        [("a/keep/f1", _ts("2024-01-01 00:00:00")), ("a/skip/f2", _ts("2024-01-01 00:00:00")), ("a/b/new", _ts("2024-02-10 00:00:00"))],
        "path string, mtime timestamp",
    )
    got = {r["path"]: r["age_days"] for r in retention_candidates(inv, "2024-02-15 00:00:00", 30, ["skip"]).collect()}
    assert got == {"a/keep/f1": 45}


def test_log_lines_positions_over_split_plain_and_gzip_files(spark, tmp_path):
    import gzip

    from riskloom.sources.tables import log_lines

    big = "".join(f"line {i} {'x' * (i % 50)}\n" if i % 97 else "\n" for i in range(20000))
    texts = {
        "plain.log": big,  # several blocks under a small split size
        "crlf.log": "first\r\nsecond\r\n\r\nlast",
        "z.log.gz": "a\n\nb\nTraceback\n",
    }
    for name, text in texts.items():
        data = text.encode("utf-8")
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        rows = log_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {}
    for r in rows:
        got.setdefault(r["log_path"].rsplit("/", 1)[-1], {})[r["line_no"]] = r["line"]
    for name, text in texts.items():
        lines = text.split("\n")
        if lines[-1] == "":
            lines = lines[:-1]
        want = {i: l.removesuffix("\r") for i, l in enumerate(lines)}
        assert got[name] == want, name


def test_latest_object_ties_go_to_the_first_listed(spark):
    from riskloom.operators.lakeops import latest_objects

    inv = spark.createDataFrame([("p", "b", _ts("2024-01-01")), ("p", "a", _ts("2024-01-01")), ("p", "0", _ts("2023-12-31")), ("q", "z", None)], "partition string, path string, mtime timestamp")
    got = {r["partition"]: (r["n_objects"], r["latest_path"]) for r in latest_objects(inv).collect()}
    assert got == {"p": (3, "a"), "q": (1, None)}


def test_retention_excludes_below_the_root_only(spark):
    old = _ts("2024-01-01")
    inv = spark.createDataFrame([("/data/tmp/x/f", old), ("/data/tmp/x/tmp/f", old)], "path string, mtime timestamp")
    got = [r["path"] for r in retention_candidates(inv, "2024-02-15 00:00:00", 30, ["tmp"], root="/data/tmp").collect()]
    assert got == ["/data/tmp/x/f"]


def test_consume_steps_return_and_write_the_remainder(spark, tmp_path):
    from riskloom.operators.lakeops import consume_attributes, consume_range

    items = spark.createDataFrame([("k", 1, "1", "2", "u1"), ("k", 2, "0", "3", None), ("j", 3, "5", "6", "u3"), (None, 4, "7", "8", "u4")], "pk string, seq long, min_ts string, max_ts string, u string")
    keys = spark.createDataFrame([("k",), ("k",), ("absent",)], "pk string")
    ranges, left = consume_range(str(tmp_path / "a"), items, keys)
    assert [tuple(r) for r in ranges.collect()] == [("k", "0", "3")]
    values, rest = consume_attributes(str(tmp_path / "b"), left, spark.createDataFrame([(None,)], "pk string"), ["u"])
    assert [tuple(r) for r in values.collect()] == [(None, "u", "u4")]
    assert [r["pk"] for r in rest.collect()] == ["j"] and left.count() == 2


def test_line_numbers_do_not_depend_on_how_a_later_scan_is_split(spark, tmp_path):
    from riskloom.sources.tables import log_lines

    for k in range(12):
        (tmp_path / f"f{k}.log").write_text("".join(f"{k}:{i}\n" for i in range(500)))
    (tmp_path / "big.log").write_text("".join(f"big:{i}\n" for i in range(30_000)))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = log_lines(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
        rows = lines.collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(rows) == 36_000 and all(r["line"].endswith(f":{r['line_no']}") for r in rows)


def test_csv_is_read_by_name_with_rfc_quoting(spark, tmp_path):
    import pytest

    from riskloom.sources.sinks import write_csv
    from riskloom.sources.tables import read_csv_table

    (tmp_path / "in.csv").write_text('class,note,txId\n2,"say ""hi""\nthere, you",7\n')
    df = read_csv_table(spark, str(tmp_path / "in.csv"), "txId long, class int")
    assert [tuple(r) for r in df.collect()] == [(7, 2)] and df.columns == ["txId", "class"]
    texts = ['a "quoted" one', "two\nlines", "comma, and \\ backslash", "plain"]
    source = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    back = read_csv_table(spark, write_csv(source, str(tmp_path / "out")), "text string, id long")
    assert {r["id"]: r["text"] for r in back.collect()} == dict(enumerate(texts))
    with pytest.raises(ValueError, match="absent"):
        read_csv_table(spark, str(tmp_path / "in.csv"), "txId long, absent int")
    (tmp_path / "bad.csv").write_text("a,b\nx,1\n")
    with pytest.raises(Exception):  # noqa: B017
        read_csv_table(spark, str(tmp_path / "bad.csv"), "a int, b int").collect()


def test_database_guard_refuses_before_anything_is_sent(spark):
    import pytest

    from riskloom.sources.tables import jdbc_query

    for text in ("DROP TABLE x", "select 1; Delete from x", "select dropped from t"):
        with pytest.raises(ValueError, match="refused"):
            jdbc_query(spark, "jdbc:none:", query=text)
    with pytest.raises(ValueError, match="refused"):
        jdbc_query(spark, "jdbc:none:", table="deleted_rows")
    with pytest.raises(ValueError, match="table"):
        jdbc_query(spark, "jdbc:none:", query="select 1", partition_column="id")


def test_metrics_of_a_run_are_published_once(spark, tmp_path):
    from riskloom.sources.sinks import append_metrics

    path = str(tmp_path / "m")
    rows = spark.createDataFrame([("knn", 0.5), ("gbt", 0.6)], "model string, accuracy double")
    for run in ("a", "b", "a"):
        append_metrics(rows, path, run)
    assert spark.read.parquet(path).groupBy("run_id").count().orderBy("run_id").collect() == [("a", 2), ("b", 2)]
