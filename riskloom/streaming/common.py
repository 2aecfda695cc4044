"""Shared pieces of the streaming jobs: feeding a table as time-ordered chunks,
an idempotent per-batch sink, and reading back the latest version of each
key."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from riskloom.session import scratch_dir
from riskloom.sources.sinks import clustered


class Folder:
    """A folder that files arrive in, as a stream source: one pass over what is there."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def passes(self) -> Iterator[str]:
        yield self.path


class Chunks(Folder):
    """``df`` arriving in ``chunks`` time-ordered parts: each pass appends the
    next part to the folder, so a job that is run once a pass (with one
    checkpoint) sees a part as one micro-batch, whatever its files are.

    Chunk ids are computed in one pass into a table partitioned by chunk,
    rows of a chunk brought together and cut by bytes; a part is read back
    from it through partition pruning.
    """

    def __init__(self, df: DataFrame, ts: str, chunks: int, name: str):
        spark = df.sparkSession
        super().__init__(scratch_dir(spark, name), df.schema)
        self.chunks = chunks
        bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
        lo, hi = bounds["lo"], bounds["hi"]
        chunk = F.lit(0)
        if lo is not None:
            step = (hi - lo) / chunks
            chunk = F.lit(chunks - 1)
            for k in reversed(range(chunks - 1)):
                chunk = F.when(F.col(ts) < F.lit(lo + step * (k + 1)), F.lit(k)).otherwise(chunk)
        staged = scratch_dir(spark, f"{name}-staged")
        clustered(df.withColumn("_chunk", chunk), ["_chunk"]).write.partitionBy("_chunk").parquet(staged)
        self.staged = spark.read.schema(StructType([*df.schema.fields, StructField("_chunk", IntegerType())])).parquet(staged)

    def passes(self) -> Iterator[str]:
        for k in range(self.chunks):
            self.staged.where(F.col("_chunk") == k).drop("_chunk").write.mode("append").parquet(self.path)
            yield self.path


def file_stream(spark: SparkSession, source: Folder, path: str) -> DataFrame:
    return spark.readStream.schema(source.schema).parquet(path)


def passes(spark: SparkSession, source: Folder, name: str) -> Iterator:
    """For each pass over the source a function that runs it: given
    ``start(stream of the source)`` it starts that query with ``availableNow``,
    resuming from the checkpoint of the passes before, and waits for its end."""
    checkpoint = scratch_dir(spark, f"{name}-ckpt")
    for path in source.passes():

        def run(start, path=path) -> None:
            writer = start(file_stream(spark, source, path))
            writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

        yield run


def run_passes(spark: SparkSession, source: Folder, name: str, start) -> None:
    """Run the query that ``start`` makes once for each pass."""
    for run in passes(spark, source, name):
        run(start)


def batch_sink(out_path: str, change=None):
    """foreachBatch function: each micro-batch (after ``change``) written to its
    own folder, overwritten on replay, so a retried batch is idempotent."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if change is None else change(batch)
        rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return write


def latest_versions(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """The last emitted row per key over all batch folders (update mode)."""
    rows = spark.read.parquet(out_path)
    w = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "batch_id", "batch")
