"""Streaming forms of the batch jobs (STR1-STR4).

* ``stream_buckets`` — tumbling event windows with a watermark (update mode).
* ``stream_settled`` — the settled check poked once a pass: every pass reads
  the listing and the marks that the last one stored, decides for every
  partition, changed or not, and stores the marks for the next.
* ``stream_logscan`` — the three-phase exception scan (seek → in trace →
  tail) per log, fed in line order across micro-batches: each batch writes
  the log states that changed and the message parts it found, with aggregates
  and size-checked joins, never a log's lines in one task.  The states are
  written whole every few batches, so a batch reads as many folders after a
  year as on the first day.
* ``stream_score`` — whichever model was saved, applied to each micro-batch.

Every job takes a source (``Folder`` or ``Chunks``), writes through an
idempotent per-batch sink and checkpoints in the shared checkpoint folder, so
a restarted query resumes exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_dir
from riskloom.streaming.common import Folder, batch_sink, latest_versions, passes, run_passes


# ------------------------------------------------------------------ STR4
def stream_buckets(spark: SparkSession, source: Folder, watermark: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Tumbling event-time windows: (slot, n_events, total_value) — final
    version per window."""
    out = scratch_dir(spark, "stream-buckets")

    def start(ev: DataFrame):
        agg = (
            ev.withColumn("ts", F.col("ts").cast("timestamp"))  # event time must be a timestamp, not ntz
            .withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
            .select(F.col("w.start").alias("slot"), "n_events", "total_value")
        )
        return agg.writeStream.outputMode("update").foreachBatch(batch_sink(out))

    run_passes(spark, source, "stream-buckets", start)
    return latest_versions(spark, out, ["slot"])


# ------------------------------------------------------------------ STR2
_POKE = "partition string, n_objects long, latest_mtime timestamp, latest_path string, stored_mark timestamp, settled boolean, new_mark timestamp"


def begin_pokes(spark: SparkSession, root: str, marks: DataFrame) -> str:
    """Write the version that the first poke starts from: nothing listed yet,
    ``marks`` (partition, stored_mark) stored."""
    none = lambda t: F.lit(None).cast(t)
    start = marks.select(
        F.col("partition").cast("string").alias("partition"), F.lit(0).cast("long").alias("n_objects"), none("timestamp").alias("latest_mtime"),
        none("string").alias("latest_path"), none("timestamp").alias("stored_mark"), F.lit(False).alias("settled"),
        F.col("stored_mark").cast("timestamp").alias("new_mark"),
    )
    start.write.mode("overwrite").parquet(f"{root}/pokes/pass=-1")
    return root


def listed_batch(root: str, number: int):
    """foreachBatch function of pass ``number``: what a micro-batch adds to
    each partition's listing, one row a partition, in a folder of its own that
    a replay overwrites."""
    from riskloom.operators.lakeops import latest_aggregates

    def run(batch: DataFrame, batch_id: int) -> None:
        added = batch.groupBy("partition").agg(*latest_aggregates())
        added.write.mode("overwrite").parquet(f"{root}/listed/pass={number}/batch_id={batch_id}")

    return run


def poke(spark: SparkSession, root: str, number: int) -> None:
    """Pass ``number`` of the settled check: the listing as the last pass knew
    it and what this pass added, held against the marks that the last pass
    stored.  One row a partition, written as the version that the next pass
    reads; done again it writes the same rows, as it reads no version but the
    one before."""
    from riskloom.operators.lakeops import settle

    last = spark.read.schema(_POKE).parquet(f"{root}/pokes/pass={number - 1}")
    listing = last.select("partition", "n_objects", "latest_mtime", "latest_path")
    folder = f"{root}/listed/pass={number}"
    if _exists(spark, folder):  # a pass without new objects has no micro-batch
        added = spark.read.schema("partition string, n_objects long, latest_mtime timestamp, latest_path string").parquet(folder)
        listing = listing.unionByName(added.select(*listing.columns))
    age = -F.unix_micros("latest_mtime")
    first = F.min(F.when(F.col("latest_mtime").isNotNull(), F.struct(age.alias("a"), F.col("latest_path").alias("p"))))
    known = listing.groupBy("partition").agg(F.sum("n_objects").alias("n_objects"), F.max("latest_mtime").alias("latest_mtime"), first["p"].alias("latest_path"))
    marks = last.where(F.col("new_mark").isNotNull()).select("partition", F.col("new_mark").alias("stored_mark"))
    settle(known, marks).write.mode("overwrite").parquet(f"{root}/pokes/pass={number}")


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def stream_settled(spark: SparkSession, source: Folder, marks: DataFrame) -> DataFrame:
    """JOB4 on a stream, poked after every pass: one row a (pass, partition)
    with the object count, the latest object (ties → smallest path), the mark
    stored before, whether the partition is settled and the mark stored now.

    A partition that a pass did not touch is poked like any other, so it
    settles in the first pass that finds it as the pass before left it.
    Partitions that only ``marks`` (partition, stored_mark) knows are reported
    as not settled.  Count and latest are algebraic: a micro-batch is
    aggregated partially in its scan tasks, and a pass reads its own rows and
    one version of one row a partition, however many passes went before."""
    root = begin_pokes(spark, scratch_dir(spark, "stream-settled"), marks)
    number = -1
    for number, run in enumerate(passes(spark, source, "stream-settled")):
        run(lambda inv, number=number: inv.writeStream.foreachBatch(listed_batch(root, number)))
        poke(spark, root, number)
    pokes = spark.read.schema(_POKE + ", pass long").parquet(f"{root}/pokes")
    return pokes.where(F.col("pass") >= 0)


# ------------------------------------------------------------------ STR3
_SCAN_STATE = "log_id string, phase int, name string"
_SCAN_PARTS = "log_id string, exception_name string, part_no long, part string"


def _before_all():
    """Start position meaning "every line of this batch is later"."""
    return F.lit(-(2**63)).cast("long")


def scan_step(state: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of the exception scan: (state, lines) → (state rows
    that are new or changed, message parts of this batch).

    ``state`` holds one row per log that has passed its traceback line:
    phase 1 = looking for the ``Name: message`` line, phase 2 = appending
    tail lines; a log changes its row twice at most.  Lines of a log arrive
    in order across batches, so every line of this batch follows the state.
    Each step is an aggregate or a size-checked join, as in the batch scan:
    a log with a third of the lines is aggregated partially and never
    gathered into one task.  Parts are those of ``log_exceptions``: the
    whole message, however long.
    """
    from riskloom.functions.text import strip_spaces
    from riskloom.operators.joins import broadcast_if_small
    from riskloom.operators.logscan import EXCEPTION_LINE, TRACE_START, tail_filter

    no, line = F.col("line_no"), F.col("line")
    # phase 0 → 1: the first traceback line of logs not yet in the state
    t = lines.where(line.rlike(TRACE_START)).groupBy("log_id").agg(F.min("line_no").alias("_from"))
    fresh = t.join(state.select("log_id"), "log_id", "left_anti").withColumn("fresh", F.lit(True))
    waiting = state.where(F.col("phase") == 1).select("log_id", _before_all().alias("_from"), F.lit(False).alias("fresh"))
    seek = broadcast_if_small(waiting.unionByName(fresh))
    # phase 1 → 2: the first exception line after it
    e = (
        lines.join(seek, "log_id")
        .where((no > F.col("_from")) & line.rlike(EXCEPTION_LINE))
        .groupBy("log_id")
        .agg(F.min(F.struct(no.alias("n"), line.alias("l"))).alias("_e"))
    )
    heads = broadcast_if_small(
        e.select(
            "log_id",
            F.col("_e.n").alias("_from"),
            strip_spaces(F.regexp_extract("_e.l", EXCEPTION_LINE, 1)).alias("name"),
            strip_spaces(F.regexp_extract("_e.l", EXCEPTION_LINE, 2)).alias("head"),
        )
    )
    # phase 2: tail lines after the exception line
    open_ = state.where(F.col("phase") == 2).select("log_id", _before_all().alias("_from"), "name")
    grow = broadcast_if_small(open_.unionByName(heads.select("log_id", "_from", "name")))
    tail = lines.join(grow, "log_id").where((no > F.col("_from")) & tail_filter(line))
    parts = heads.select("log_id", F.col("name").alias("exception_name"), F.lit(-1).cast("long").alias("part_no"), F.col("head").alias("part")).unionByName(
        tail.select("log_id", F.col("name").alias("exception_name"), no.cast("long").alias("part_no"), strip_spaces(line).alias("part"))
    )
    began = seek.where("fresh").join(heads.select("log_id"), "log_id", "left_anti").select("log_id", F.lit(1).alias("phase"), F.lit(None).cast("string").alias("name"))
    changed = began.unionByName(heads.select("log_id", F.lit(2).alias("phase"), "name"))
    return changed, parts


#: The states of all logs are written whole after every so many batches.
SNAPSHOT_EVERY = 16


def state_folders(root: str, batch_id: int, every: int = SNAPSHOT_EVERY) -> list[str]:
    """What holds the state before a batch: the last whole writing of it, and
    the changes of the batches since, ``every`` folders at most."""
    whole = batch_id // every * every - 1  # batches are numbered without gaps
    first = f"{root}/whole/batch_id={whole}" if whole >= 0 else f"{root}/state/batch_id=-1"
    return [first, *[f"{root}/state/batch_id={b}" for b in range(whole + 1, batch_id)]]


def scan_state(spark: SparkSession, root: str, before: int, every: int = SNAPSHOT_EVERY) -> DataFrame:
    """The state of every log before a batch; a folder that is missing raises."""
    changes = spark.read.schema(_SCAN_STATE).parquet(*state_folders(root, before, every))
    return changes.groupBy("log_id").agg(F.max("phase").alias("phase"), F.max("name").alias("name"))


def begin_scan(spark: SparkSession, root: str) -> str:
    """Write the empty version that the first batch starts from, so reading
    the state never has to guess whether there is one: what cannot be read
    raises."""
    for name, schema in (("state", _SCAN_STATE), ("parts", _SCAN_PARTS)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/{name}/batch_id=-1")
    return root


def scan_batch(root: str, every: int = SNAPSHOT_EVERY):
    """foreachBatch function: the changes and parts of batch b from the state
    before it, written as folders ``batch_id=b`` (a replayed batch overwrites
    its own folders from the same inputs).  Parts come first: a state row is
    there only if the parts that go with it are.  After the last batch of
    ``every`` the state is written whole, from folders that are complete by
    then; only later batches read it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = batch.select("log_id", "line_no", "line").persist()
        changed, parts = scan_step(scan_state(spark, root, batch_id, every), lines)
        parts.write.mode("overwrite").parquet(f"{root}/parts/batch_id={batch_id}")
        changed.write.mode("overwrite").parquet(f"{root}/state/batch_id={batch_id}")
        lines.unpersist()  # nothing cached outlives its batch
        if (batch_id + 1) % every == 0:
            changes = spark.read.schema(_SCAN_STATE).parquet(*state_folders(root, batch_id, every), f"{root}/state/batch_id={batch_id}")
            whole = changes.groupBy("log_id").agg(F.max("phase").alias("phase"), F.max("name").alias("name"))
            whole.write.mode("overwrite").parquet(f"{root}/whole/batch_id={batch_id}")

    return run


def stream_log_parts(spark: SparkSession, source: Folder) -> DataFrame:
    """The parts of every log's exception (as ``log_exceptions``) from a stream
    of (log_id, line_no, line), lines of a log arriving in order across
    micro-batches."""
    root = begin_scan(spark, scratch_dir(spark, "stream-logscan"))
    run_passes(spark, source, "stream-logscan", lambda lines: lines.writeStream.foreachBatch(scan_batch(root)))
    return spark.read.schema(_SCAN_PARTS + ", batch_id long").parquet(f"{root}/parts").drop("batch_id")


def stream_logscan(spark: SparkSession, source: Folder, **generator) -> DataFrame:
    """Alert rows per log from the streamed parts; ``payload`` and
    ``characters`` as in ``log_alerts``: a generator gets the whole message."""
    from riskloom.operators.logscan import alerts

    return alerts(stream_log_parts(spark, source), **generator)


# ------------------------------------------------------------------ STR1
def stream_score(spark: SparkSession, model_path: str, source: Folder, keep: list[str]) -> DataFrame:
    """Continuous scoring: each micro-batch scored with the model under
    ``model_path``, whichever kind it is."""
    from riskloom.operators.models import load_model

    model = load_model(model_path)
    out = scratch_dir(spark, "stream-score")
    run_passes(
        spark, source, "stream-score", lambda rows: rows.writeStream.outputMode("append").foreachBatch(batch_sink(out, lambda batch: model.score(batch, keep)))
    )
    return spark.read.parquet(out).drop("batch_id", "batch")
