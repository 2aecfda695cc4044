import pytest
from pyspark.sql import functions as F

from riskloom.operators.logscan import alerts, log_alerts, log_exceptions

# Sample logs and, stated by hand, the (name, message) each must give.
LOGS = {
    "usual": (
        [
            "INFO start", "a.b.Err: before the trace", "Traceback (most recent call last):", '  File "x.py", line 1, in f',
            "KeyError:  'k'  ", "    indented, left out", "next line", "INFO py4j.clientserver: Closing down clientserver connection",
            "Traceback (most recent call last):", "\tafter a tab, left out", "ValueError: second",
        ],
        ("KeyError", "'k' next line Traceback (most recent call last): ValueError: second"),
    ),
    "only frames": (["INFO nothing here", "Traceback (most recent call last):", "  only frames"], None),
    "no trace": (["ValueError: without a trace", ""], None),
    "dotted names": (["Traceback (most recent call last):", "pkg.Mod.Error: not a plain name", "Plain: taken"], ("Plain", "taken")),
    "non-ASCII": (["Traceback (most recent call last):", "ÉchecDonnées: panne", "für Größe"], ("ÉchecDonnées", "panne für Größe")),
    "blank lines": (["Traceback (most recent call last):", "E:", "", "  ", "first", "", "\r", "last", "", "\x0b"], ("E", "first  last")),
    "empty message": (["Traceback (most recent call last):", "E:", ""], ("E", "")),
    "colon in text": (["Traceback (most recent call last):", "E: a: b", "c: d"], ("E", "a: b c: d")),
    "long": (["Traceback (most recent call last):", "E: " + "x" * 290, *["tail"] * 5], ("E", "x" * 290 + " tail tail tail tail tail")),
}
TRUNCATED = "x" * 290 + " tail tail" + "... truncated ..."


def _lines(spark):
    rows = [(name, i * 10, line) for name, (log, _) in LOGS.items() for i, line in enumerate(log)]
    return spark.createDataFrame(rows, "log_id string, line_no long, line string")


def test_messages_are_the_parts_in_order(spark):
    got = {}
    for r in sorted(log_exceptions(_lines(spark)).collect(), key=lambda r: (r["log_id"], r["part_no"])):
        name, message = got.get(r["log_id"], (r["exception_name"], None))
        got[r["log_id"]] = (name, r["part"] if message is None else message + " " + r["part"])
    assert {k: (n, m.strip()) for k, (n, m) in got.items()} == {k: want for k, (_, want) in LOGS.items() if want}


def test_default_alerts(spark):
    got = {r["log_id"]: r for r in log_alerts(_lines(spark)).collect()}
    want = {k: w for k, (_, w) in LOGS.items() if w}
    assert set(got) == set(want)
    for k, (name, message) in want.items():
        assert (got[k]["alias"], got[k]["message"]) == (name, TRUNCATED if k == "long" else message)
        assert got[k]["priority"] == "P3" and got[k]["tags"] == ["airflow.data"]


def test_a_prefix_of_the_parts_is_a_prefix_of_the_message(spark):
    """Blank parts up to the cut must not be taken for the end of the message."""
    rows = [("a", 0, "Traceback (most recent call last):"), ("a", 1, "E: x"), *[("a", 2 + i, "\r") for i in range(400)], ("a", 500, "y")]
    (r,) = log_alerts(spark.createDataFrame(rows, "log_id string, line_no long, line string")).collect()
    assert r["message"] == "x" + " " * 299 + "... truncated ..."


def _whole(name, message):
    return [F.upper(name).alias("title"), message.alias("text")]


def test_a_generator_gets_the_whole_message(spark):
    rows = [("big", 0, "Traceback (most recent call last):"), ("big", 1, "E: head"), *[("big", 2 + i, f"piece {i}") for i in range(1000)]]
    lines = spark.createDataFrame(rows, "log_id string, line_no long, line string").repartition(5)
    (r,) = log_alerts(lines, payload=_whole).collect()
    assert r["title"] == "E" and r["text"] == "head " + " ".join(f"piece {i}" for i in range(1000))
    (r,) = log_alerts(lines, payload=_whole, characters=20).collect()
    assert r["text"].startswith("head piece 0 piece 1 piece 2")


def test_of_a_hot_log_one_block_and_the_leading_characters_are_put_together(spark):
    """A log of a million tail lines over 1,000 partitions: its blocks are
    counted, and no more than a block and 301 parts meet."""
    from riskloom.operators.logscan import BLOCK_LINES, leading_parts, messages

    hot = spark.range(1_000_000, numPartitions=1000).select(F.lit("hot").alias("log_id"), F.lit("E").alias("exception_name"), (F.col("id") * 7).alias("part_no"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("part"))
    other = spark.createDataFrame([("small", "X", -1, ""), ("small", "X", 5, "a" * 400), ("small", "X", 9000, "b"), ("sparse", "Y", -1, "y"), *[("sparse", "Y", k * 10 * BLOCK_LINES, "z") for k in range(400)]], "log_id string, exception_name string, part_no long, part string")
    parts = hot.unionByName(other)
    kept = {r["log_id"]: r["count"] for r in leading_parts(parts, 301).groupBy("log_id").count().collect()}
    assert kept["hot"] <= BLOCK_LINES + 301 and kept["sparse"] <= 302 and kept["small"] == 2
    got = {r["log_id"]: r["message"] for r in messages(parts, characters=301).collect()}
    assert got["hot"][:301] == " ".join(f"p{i}" for i in range(200))[:301]
    assert got["sparse"][:301] == "y" + " z" * 150 and got["small"][:301] == "a" * 301


def _stream_steps(spark, root, lines, cuts):
    """Feed ``lines`` to the stream's batches in line order, split at ``cuts``."""
    from riskloom.streaming.jobs import begin_scan, scan_batch

    run = scan_batch(begin_scan(spark, root), every=3)
    bounds = [None, *cuts, None]
    for b, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        cond = F.lit(True)
        if lo is not None:
            cond &= F.col("line_no") >= lo
        if hi is not None:
            cond &= F.col("line_no") < hi
        run(lines.where(cond), b)
        run(lines.where(cond), b)  # a replayed batch changes nothing


def test_stream_batches_equal_the_batch_scan(spark, tmp_path):
    from riskloom.streaming.jobs import scan_state

    hot = ["Traceback (most recent call last):", "Big: head"] + [f"tail piece {i}" for i in range(3000)]
    lines = _lines(spark).unionByName(spark.createDataFrame([("hot", i, x) for i, x in enumerate(hot)], "log_id string, line_no long, line string"))
    want = sorted(map(tuple, log_exceptions(lines).collect()))
    # cuts split a log between its traceback and exception lines and the hot log's tail
    for k, cuts in enumerate(([], [25, 55, 1000], [15, 35, 45, 65, 2000, 2500])):
        root = str(tmp_path / f"s{k}")
        _stream_steps(spark, root, lines, cuts)
        parts = spark.read.parquet(f"{root}/parts").drop("batch_id")
        assert sorted(map(tuple, parts.collect())) == want
        assert [r[0] for r in scan_state(spark, root, len(cuts) + 1, 3).where("phase = 1").collect()] == ["only frames"]
        (r,) = alerts(parts.where("log_id = 'hot'"), payload=_whole).collect()
        assert r["text"] == "head " + " ".join(f"tail piece {i}" for i in range(3000))


def test_a_batch_reads_as_many_folders_however_many_went_before(spark, tmp_path):
    from riskloom.streaming.jobs import begin_scan, scan_batch, scan_state, state_folders

    assert max(len(state_folders("r", b, 16)) for b in range(400)) == 16
    assert state_folders("r", 37, 16) == ["r/whole/batch_id=31", *[f"r/state/batch_id={b}" for b in range(32, 37)]]
    root = begin_scan(spark, str(tmp_path / "s"))
    run, states = scan_batch(root, every=4), []
    for b in range(14):
        rows = [(f"log{b}", 0, "Traceback (most recent call last):"), (f"log{b - 3}", 1, "Late: found"), ("quiet", b, "INFO nothing")]
        lines = spark.createDataFrame(rows, "log_id string, line_no long, line string")
        run(lines, b)
        if b in (3, 7, 9):
            run(lines, b)  # replayed, the whole writing of the state too
        read = scan_state(spark, root, b + 1, 4)
        states.append({r["log_id"]: r["phase"] for r in read.collect()})
        assert len({"/".join(f.split("/")[:-1]) for f in read.inputFiles()}) <= 4
    assert states == [{f"log{k}": 2 if k + 3 <= b else 1 for k in range(b + 1)} for b in range(14)]


def test_an_unreadable_state_version_raises(spark, tmp_path):
    from riskloom.streaming.jobs import begin_scan, scan_batch

    root = begin_scan(spark, str(tmp_path / "s"))
    run = scan_batch(root)
    run(_lines(spark), 0)
    for f in (tmp_path / "s" / "state" / "batch_id=0").glob("*.parquet"):
        f.write_bytes(b"not parquet")
    for f in (tmp_path / "s" / "state" / "batch_id=0").glob(".*.crc"):
        f.write_bytes(b"")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises, not a fresh start
        run(_lines(spark), 1)


def test_sparse_chunks_are_micro_batches_of_their_own(spark):
    """A chunk of one row must not shape the files of the others."""
    import datetime as dt

    from riskloom.streaming.common import Chunks

    day = dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(seconds=i % 3600), i) for i in range(20_000)] + [(day + dt.timedelta(hours=9), -1), (day + dt.timedelta(hours=30), -2)]
    source = Chunks(spark.createDataFrame(rows, "ts timestamp, i long").repartition(4), "ts", 3, "sparse")
    seen = [spark.read.parquet(p).count() for p in source.passes()]
    assert seen == [20_001, 20_001, 20_002]
    none = Chunks(spark.createDataFrame([], "ts timestamp, i long"), "ts", 3, "none")
    assert [spark.read.schema(none.schema).parquet(p).count() for p in none.passes()] == [0, 0, 0]
