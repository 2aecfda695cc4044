"""Date/time column functions (FN9-FN13, FN15, FN16) and a strftime →
Spark datetime-pattern translator used by the time-slot job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default local zone of the time helpers.  Fixed value.
DEFAULT_LOCAL_TZ = "Asia/Kuala_Lumpur"

# strftime directive → Spark datetime pattern letters.  Fixed values.
_STRFTIME_TO_SPARK = {
    "Y": "yyyy",
    "y": "yy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "I": "hh",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "b": "MMM",
    "B": "MMMM",
    "a": "EEE",
    "A": "EEEE",
    "p": "a",
    "j": "DDD",
}


def strftime_to_spark(fmt: str) -> str:
    """Translate a strftime format into a Spark ``date_format`` pattern.

    Literal text is quoted; ``%%`` is a literal percent sign.
    """
    out: list[str] = []
    lit: list[str] = []

    def flush():
        if lit:
            text = "".join(lit).replace("'", "''")
            out.append(f"'{text}'")
            lit.clear()

    i = 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%" and i + 1 < len(fmt):
            d = fmt[i + 1]
            if d == "%":
                lit.append("%")
            elif d in _STRFTIME_TO_SPARK:
                flush()
                out.append(_STRFTIME_TO_SPARK[d])
            else:
                raise ValueError(f"unsupported strftime directive %{d}")
            i += 2
            continue
        lit.append(ch)
        i += 1
    flush()
    return "".join(out)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_instant(ts) -> Column:
    """Treat a naive timestamp as UTC (session time zone is UTC)."""
    return _c(ts).cast("timestamp")


def utc_to_local(ts, tz: str = DEFAULT_LOCAL_TZ) -> Column:
    """FN12: wall-clock time in ``tz`` of a UTC instant."""
    return F.from_utc_timestamp(as_instant(ts), tz)


def shift_hours(ts, hours: int) -> Column:
    """FN13: ``ts + hours``."""
    return F.timestamp_add("HOUR", F.lit(hours), _c(ts))


def shift_days(ts, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(days), _c(ts))


def run_date(ts, previous=None, next=None, delta=None, tz: str = "UTC") -> Column:
    """FN9: zone conversion plus day shift, with the reference's argument rule:
    nothing moves unless ``delta`` is given; then a truthy ``previous`` moves
    back ``delta`` days and ``next`` moves forward ``next`` days."""
    d = utc_to_local(ts, tz) if tz != "UTC" else as_instant(ts)
    if delta is not None:
        if previous:
            d = shift_days(d, -int(delta))
        if next:
            d = shift_days(d, int(next))
    return d


def exec_date_parts(ts, previous=None, next=None, delta=None, tz: str = "UTC") -> list[Column]:
    """FN10: (Y-m-d, lower month abbreviation, mm, dd, HH, MM).  Shifts by
    ``previous``/``next`` days, only when ``delta`` is given."""
    d = utc_to_local(ts, tz) if tz != "UTC" else as_instant(ts)
    if delta is not None:
        if previous:
            d = shift_days(d, -int(previous))
        if next:
            d = shift_days(d, int(next))
    return [
        F.date_format(d, "yyyy-MM-dd").alias("current"),
        F.lower(F.date_format(d, "MMM")).alias("m_str"),
        F.date_format(d, "MM").alias("m_int"),
        F.date_format(d, "dd").alias("day"),
        F.date_format(d, "HH").alias("hour"),
        F.date_format(d, "mm").alias("minute"),
    ]


def quarter_hour(ts) -> Column:
    """FN11: quarter-hour bucket of the minute, '00'..'03'."""
    return F.lpad(F.floor(F.minute(_c(ts)) / 15).cast("string"), 2, "0")


def hour_window_strings(ts) -> list[Column]:
    """FN15: hour floor and previous hour as ISO ``…T….000`` and as
    ``yyyy-MM-dd HH:mm:ss.ffffff`` text."""
    cur = F.date_trunc("hour", _c(ts))
    prev = shift_hours(cur, -1)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    sql = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return [
        F.date_format(cur, iso).alias("formatted_date"),
        F.date_format(prev, iso).alias("previous_hour"),
        F.date_format(cur, sql).alias("sql_formatted_date"),
        F.date_format(prev, sql).alias("sql_previous_hour"),
    ]


def partition_date_parts(ts, tz: str = DEFAULT_LOCAL_TZ, add_days: int = 1) -> list[Column]:
    """FN16: local date + ``add_days`` → (year, month, day) strings."""
    d = F.date_add(F.to_date(utc_to_local(ts, tz)), add_days)
    return [
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
    ]
