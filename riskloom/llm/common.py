"""Small shared parts of the pipeline operators: inputs, shared folder, files, id filters."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import materialize, scratch_dir, ship_package  # noqa: F401

#: Rows of one long id that may be broadcast (16 MB of keys); beyond it a shuffle join is planned.
MAX_BROADCAST_IDS = 1_000_000

#: Bytes of text that a Python task handles at a time.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; also makes this package importable on the executors."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of ``docs``: other columns, whatever their names, stay out of the way."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, as a URI that executors open too."""
    base = scratch_dir(spark, name)
    return base if ":" in base.split("/")[0] else f"file://{base}"


def shared_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it (file, HDFS, S3, GCS by scheme)."""
    if uri.startswith("file:"):  # Hadoop also writes file:/x
        uri = "file:///" + uri[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def save_file(uri: str, name: str, parts: Iterable[bytes]) -> int:
    """Write one file of a shared folder and return its bytes.  It appears under its name only when
    it is whole, so a lost or repeated task attempt leaves nothing half-written behind that name."""
    fs, root = shared_folder(uri)
    fs.create_dir(root, recursive=True)
    tmp, size = f"{root}/.{name}.{uuid.uuid4().hex}", 0
    with fs.open_output_stream(tmp) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    fs.move(tmp, f"{root}/{name}")
    return size


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``limit`` bytes of text each, at least one row long."""
    import numpy as np

    n = batch.num_rows
    if not n:
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def id_side(ids: DataFrame, max_rows: int = MAX_BROADCAST_IDS) -> DataFrame:
    """``ids`` (one long column, already a written table) ready to join: broadcast when counted to
    fit the bound, else left to a shuffle join."""
    return F.broadcast(ids) if ids.count() <= max_rows else ids


def drop_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (one column); all columns stay as they are."""
    gone = materialize(ids.select(F.col(ids.columns[0]).cast("long").alias("__gone_id")).distinct(), "gone")
    return docs.join(id_side(gone), docs[id_col].cast("long") == F.col("__gone_id"), "left_anti")
