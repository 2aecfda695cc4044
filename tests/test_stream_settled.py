"""The settled check poked pass by pass, each poke against the marks of the one before."""

import datetime as dt

from riskloom.streaming.common import Folder
from riskloom.streaming.jobs import begin_pokes, listed_batch, poke, stream_settled

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "path string, mtime timestamp, partition string"


def at(hour):
    return DAY + dt.timedelta(hours=hour)


class Arrivals(Folder):
    """Passes over a folder that gets the given rows, or nothing, before each."""

    def __init__(self, spark, path, rounds):
        super().__init__(path, spark.createDataFrame([], SCHEMA).schema)
        self.spark, self.rounds = spark, rounds
        spark.createDataFrame([], SCHEMA).write.parquet(path)

    def passes(self):
        for rows in self.rounds:
            if rows:
                self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(self.path)
            yield self.path


def replay(rounds, marks):
    """The pokes in plain Python."""
    seen, marks, out = {}, dict(marks), []
    for number, rows in enumerate(rounds):
        for path, mtime, partition in rows:
            seen.setdefault(partition, []).append((mtime, path))
        for partition in sorted({*seen, *marks}):
            objects, stored = seen.get(partition, []), marks.get(partition)
            latest = max((m for m, _ in objects), default=None)
            path = min((p for m, p in objects if m == latest), default=None)
            settled = bool(objects) and stored is not None and latest <= stored
            if objects and not settled:
                marks[partition] = latest
            out.append((number, partition, len(objects), latest, path, stored, settled, marks.get(partition)))
    return out


ROUNDS = [
    [("a/1", at(1), "a"), ("b/1", at(1), "b"), ("b/2", at(1), "b")],
    [("a/2", at(2), "a"), ("c/1", at(9), "c")],
    [],
    [("b/0", at(0), "b"), ("a/3", at(3), "a")],
    [],
    [("late", at(5), "marked")],
]
MARKS = [("marked", at(5)), ("only mark", at(7))]
COLUMNS = ["pass", "partition", "n_objects", "latest_mtime", "latest_path", "stored_mark", "settled", "new_mark"]


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_marks_are_carried_and_untouched_partitions_settle(spark, tmp_path):
    marks = spark.createDataFrame(MARKS, "partition string, stored_mark timestamp")
    got = rows_of(stream_settled(spark, Arrivals(spark, str(tmp_path / "in"), ROUNDS), marks))
    want = sorted(replay(ROUNDS, MARKS))
    assert got == want
    settled = {(r[0], r[1]) for r in got if r[6]}
    # settled without a new object of their own, and by an object no later than the mark
    assert {(1, "b"), (2, "a"), (2, "c"), (4, "a"), (5, "marked")} <= settled and (0, "a") not in settled and (3, "a") not in settled


def test_a_replayed_batch_and_poke_change_nothing(spark, tmp_path):
    root = begin_pokes(spark, str(tmp_path / "r"), spark.createDataFrame(MARKS, "partition string, stored_mark timestamp"))
    for number, rows in enumerate(ROUNDS):
        cut = [rows[:1], rows[1:]]
        for batch_id, some in enumerate(cut):
            if some:
                batch = spark.createDataFrame(some, SCHEMA)
                for _ in range(2):
                    listed_batch(root, number)(batch, batch_id)
        poke(spark, root, number)
        poke(spark, root, number)
    pokes = spark.read.parquet(f"{root}/pokes").where("pass >= 0")
    assert rows_of(pokes) == sorted(replay(ROUNDS, MARKS))


def test_a_pass_reads_the_version_before_only(spark, tmp_path):
    root = begin_pokes(spark, str(tmp_path / "r"), spark.createDataFrame([], "partition string, stored_mark timestamp"))
    for number in range(3):
        listed_batch(root, number)(spark.createDataFrame([(f"p/{number}", at(number), "p")], SCHEMA), number)
        poke(spark, root, number)
    for gone in ("pokes/pass=-1", "pokes/pass=0", "listed/pass=0", "listed/pass=1"):
        for f in (tmp_path / "r" / gone).rglob("*"):
            if f.is_file():
                f.write_bytes(b"")
    listed_batch(root, 3)(spark.createDataFrame([("p/0", at(0), "p")], SCHEMA), 3)
    poke(spark, root, 3)
    (r,) = spark.read.parquet(f"{root}/pokes/pass=3").collect()
    assert (r["n_objects"], r["latest_mtime"], r["settled"]) == (4, at(2), True)
