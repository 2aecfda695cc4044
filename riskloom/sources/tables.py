"""Sources: parquet tables, header CSV, JDBC, day-partitioned lake tables,
file inventories, gzip logs and catalog tables.

All readers return lazy DataFrames so filters and projections written after
them reach the scan (PushedFilters / ReadSchema / PartitionFilters).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Index columns written by pandas (`Unnamed: 0`) or named by Spark (`_c0`)
# for an empty CSV header cell.  Fixed values.
INDEX_COLUMNS = ("Unnamed: 0", "_c0")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_index_columns(df: DataFrame) -> DataFrame:
    """PRJ1 for the loader: drop a pandas/Spark index column if present."""
    present = [c for c in INDEX_COLUMNS if c in df.columns]
    return df.drop(*present) if present else df


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    drop_index: bool = True,
    lines_in_fields: bool = True,
) -> DataFrame:
    """SRC1: header CSV.  With a schema (no inference pass over the data) its
    columns are found by their names in the header, in whatever order the
    file has them; a name that is missing, or a field that is not of its
    type, raises.  Quoted fields may hold doubled quotes and line breaks
    (RFC 4180).  A file that may have a line break inside a field cannot be
    cut, so it is one scan task; a caller that declares that none has
    (``lines_in_fields=False``) gets every file read in splits, and a field
    that breaks the promise raises for its wrong number of columns."""
    reader = spark.read.option("header", True).option("multiLine", lines_in_fields).option("escape", '"').option("mode", "FAILFAST")
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
        return drop_index_columns(df) if drop_index else df
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    header = reader.csv(path).columns  # the names alone; every field text
    df = reader.schema(StructType([wanted[c] if c in wanted.names else StructField(c, StringType()) for c in header])).option("enforceSchema", False).csv(path)
    df = require_columns(df, wanted.names).select([F.col(f"`{c}`") for c in wanted.names])
    return drop_index_columns(df) if drop_index else df


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """PRJ6: raise listing every missing column; otherwise return ``df``."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def to_string_columns(df: DataFrame) -> DataFrame:
    """PRJ5: every column cast to string (NULL stays NULL)."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def jdbc_query(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    table: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    as_strings: bool = False,
) -> DataFrame:
    """SRC2/SRC3: a database query as a DataFrame.

    Statements containing drop/delete anywhere are refused before anything is
    sent.  For large tables pass ``table`` plus a numeric ``partition_column``
    and bounds so Spark reads ``num_partitions`` ranges in parallel (the
    ``query`` option cannot be combined with partitioning).
    """
    from riskloom.functions.text import is_destructive_text

    text = query or table or ""
    if is_destructive_text(text):
        raise ValueError("refused: statement contains 'drop' or 'delete'")
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if table is None:
            raise ValueError("partitioned JDBC reads need `table`, not `query`")
        reader = (
            reader.option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions or 8)
        )
    elif query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    df = reader.load()
    return to_string_columns(df) if as_strings else df


def read_day_partition(
    spark: SparkSession, base: str, year: str, month: str, day: str, schema: StructType | str | None = None
) -> DataFrame:
    """SRC5: ``base/year=Y/month=M/day=D`` through partition pruning.

    The equality filters on partition columns become PartitionFilters, so only
    that day's folder is listed and read.  Pass ``schema`` (with the partition
    columns as strings) to keep ``01`` as text instead of inferring integers.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(base)
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def list_prefixes(prefixes: DataFrame, column: str = "prefix") -> DataFrame:
    """SRC6 for many prefixes: (prefix, path, name, mtime, length) of every
    file below each of ``prefixes`` (URIs; file, HDFS, S3 or GCS by scheme).

    Each prefix is listed by the task that holds its row, page by page as the
    store gives them, so the listing of a lake never gathers on the driver.  A
    prefix that is not there has no files; nulls are passed over; one that
    is given twice is listed once."""

    def listed(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        for batch in batches:
            for prefix in batch["prefix"]:
                uri = "file:///" + prefix[5:].lstrip("/") if prefix.startswith("file:") else prefix
                fs, root = pafs.FileSystem.from_uri(uri)
                found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
                files = [f for f in found if f.type == pafs.FileType.File]
                for k in range(0, len(files), 10_000):
                    some = files[k : k + 10_000]
                    yield pd.DataFrame(
                        {"prefix": prefix, "path": [f.path for f in some], "name": [f.base_name for f in some],
                         "mtime": pd.to_datetime([f.mtime_ns // 1000 for f in some], unit="us", utc=True), "length": [f.size for f in some]}
                    )

    own = prefixes.select(F.col(column).cast("string").alias("prefix")).where("prefix is not null").distinct()
    return own.mapInPandas(listed, "prefix string, path string, name string, mtime timestamp, length long")


def file_inventory(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """SRC6: object listing (path, name, modified time, length) without reading
    file contents: the binaryFile source prunes the `content` column."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", "modificationTime", "length")
    )
    return df.select(
        F.col("path"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("name"),
        F.col("modificationTime").alias("mtime"),
        F.col("length"),
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: text logs (gzip or plain) to ordered lines (log_path, line_no, line).

    Lines are read one per row, split at "\n" only, so no file is ever held
    as one value.  A scan task reads its file blocks in order and
    ``monotonically_increasing_id`` is consecutive within a task, so a line's
    position in its block is its id minus the block's first id.  A gzip file
    is one block; a plain file may be split, and each block is offset by the
    lines of the earlier blocks of its file (one row per block: counted,
    summed in block order, joined back after a size check).  Blocks and ids
    depend on how a scan is split, so the files are read once, into a table
    of (path, block, id, line), and both sides come from that table; a line
    whose block has no offset raises.  No line is shuffled for this.
    """
    from pyspark.sql import Window

    from riskloom.operators.joins import broadcast_if_small
    from riskloom.session import materialize

    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("log_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    raw = materialize(raw, "log-lines")
    blocks = raw.groupBy("log_path", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("log_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("log_path", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    j = raw.join(broadcast_if_small(offsets), ["log_path", "_block"], "left")
    known = F.when(F.col("_off").isNull(), F.raise_error(F.lit("a log line has no block offset"))).otherwise(F.col("_off"))
    return j.select("log_path", (known + F.col("_id") - F.col("_first")).cast("long").alias("line_no"), "line")


def state_items_for_key(items: DataFrame, key: str, key_col: str = "pk") -> DataFrame:
    """SRC8/SRC9: items of one key.  An equality filter on the key, pushed down
    to the scan when the state table is parquet."""
    return items.where(F.col(key_col) == F.lit(key))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC10: a catalog table by (possibly qualified) name."""
    return spark.table(name)


def columns_in_order(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ2: project a run-time list of columns in list order."""
    return df.select([F.col(f"`{c}`") for c in cols])


def spread_small_input(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before CPU-heavy per-row work.

    A small file may hold a single row group, i.e. one scan task.  A scan
    with fewer splits than cores is smaller than that many split sizes: a
    round-robin repartition then costs little and lets every core work.
    Otherwise the scan's own splits are kept and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def global_line_numbers(lines: DataFrame, log: str = "log_id", path: str = "log_path", pos: str = "line_no") -> DataFrame:
    """Line numbers across a log written as several ordered part files.

    A large log may be stored as parts (part-00000…, in line order).  Each
    part's offset is the number of lines in the parts before it: a count per
    file (one row per file), a running sum over the files of each log, then
    a join back — the per-file table is broadcast only after a size check.
    """
    from pyspark.sql import Window

    from riskloom.operators.joins import broadcast_if_small

    per_file = lines.groupBy(log, path).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(log).orderBy(path).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select(log, path, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    j = lines.join(broadcast_if_small(offsets), [log, path])
    return j.withColumn(pos, (F.col("_off") + F.col(pos)).cast("long")).drop("_off")
