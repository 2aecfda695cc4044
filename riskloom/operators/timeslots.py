"""Time-slot map and backfill work list (JOB7, JOB8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.timefns import strftime_to_spark

DEFAULT_INPUT_FORMAT = "yyyyMMdd/HH"


def _encode_fmt(fmt: str) -> str:
    return fmt.replace("=", "-").replace("/", "_")


def parse_timestr(col, fmt: str = DEFAULT_INPUT_FORMAT) -> Column:
    """Parse slot boundary text such as ``20240101/00``."""
    return F.to_timestamp(F.col(col) if isinstance(col, str) else col, fmt)


def time_slots(
    bounds: DataFrame,
    start: str,
    end: str,
    output_format: str,
    interval_hours: int = 1,
    auto_encode: bool = True,
) -> DataFrame:
    """JOB7: for each (start, end) row, slots every ``interval_hours`` from
    start, indexed "0", "1", …; count = trunc(hours / interval) + 1, so an end
    less than one interval before the start still yields one slot.

    ``output_format`` is a strftime format; with ``auto_encode`` its ``=`` and
    ``/`` become ``-`` and ``_`` first (path-safe slot ids).
    """
    fmt = _encode_fmt(output_format) if auto_encode else output_format
    pattern = strftime_to_spark(fmt)
    secs = F.unix_seconds(F.col(end).cast("timestamp")) - F.unix_seconds(F.col(start).cast("timestamp"))
    ratio = secs / F.lit(interval_hours * 3600.0)
    n = (F.when(ratio >= 0, F.floor(ratio)).otherwise(F.ceil(ratio)) + 1).cast("int")
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    exploded = bounds.select(F.col(start).alias("_start"), F.explode(idx).alias("_i"))
    slot_ts = F.timestamp_add("HOUR", F.col("_i") * F.lit(interval_hours), F.col("_start"))
    return exploded.select(
        F.col("_i").cast("string").alias("idx"),
        F.date_format(slot_ts, pattern).alias("slot"),
        slot_ts.alias("slot_ts"),
    )


def slot_coverage(slots: DataFrame, events: DataFrame, ts: str = "ts", interval_hours: int = 1) -> DataFrame:
    """JOB8: each slot with its event count (0 = nothing arrived: reprocess).

    Events are counted per hour first (partial aggregate).  Each slot covers
    ``interval_hours`` hours from its start: it is expanded to those hour
    stamps (a table bounded by the time range, not by the data), equi-joined
    with the hourly counts and summed per slot.
    """
    per_hour = events.groupBy(F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("_hour")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    hours = slots.select(
        "idx", "slot", "slot_ts", F.explode(F.sequence(F.lit(0), F.lit(interval_hours - 1))).alias("_h")
    ).withColumn("_hour", F.timestamp_add("HOUR", F.col("_h"), F.col("slot_ts")))
    j = hours.join(per_hour, "_hour", "left")
    return j.groupBy("idx", "slot", "slot_ts").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_events")).select(
        "idx", "slot", "n_events"
    )
