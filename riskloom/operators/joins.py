"""Size-checked broadcast: broadcast a side only after measuring its bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from riskloom.session import materialize

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes counted for a fixed-width value, and besides for every row (headers, hash table).
VALUE_BYTES = 8
ROW_BYTES = 32


def fits(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_bytes``.  With fixed-width columns only
    the rows are probed up to the bound, so a table far larger is not read
    whole; otherwise one aggregate sums the bytes.  Nothing is cached."""
    width = ROW_BYTES
    sized = None
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            width += VALUE_BYTES
            continue
        size = F.coalesce(size, F.lit(0)).cast("long")
        sized = size if sized is None else sized + size
    if sized is None:
        rows = max_bytes // width
        return df.limit(rows + 1).count() <= rows
    return (df.agg(F.sum(sized + F.lit(width))).first()[0] or 0) <= max_bytes


def measured(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """(``df`` as a written table, whether it fits): the side is computed once,
    into the shared folder, and neither the check nor the join computes or
    caches it again.  For a side that is a plain scan use :func:`fits`."""
    side = materialize(df, "side")
    return side, fits(side, max_bytes)


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_bytes``, else the written
    side, so Spark plans a shuffle join (AQE still splits skewed partitions
    of the large side)."""
    side, small = measured(df, max_bytes)
    return F.broadcast(side) if small else side
