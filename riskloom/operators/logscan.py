"""Log exception scan and alert rows (JOB2, JOB3, WIN3, AGG11, FN17).

Per log: t = first line starting with the traceback header; e = first later
line of the form ``Name: message``; then every later line that starts with
neither a space nor a tab, unless it matches the ignore list, is appended to
the message.

Plan (no whole log ever gathered into one task or row):

1. ``t`` per log — a filtered ``min`` aggregate (partial, then final).
2. lines ⋈ t (t is one row per log: broadcast after a size check) → ``e``
   per log, again a filtered ``min``.
3. lines ⋈ e → tail pieces.  The full message is the ordered parts
   (``log_exceptions``).  A generator is given the whole message, unless it
   says how many leading characters it reads (the default one does): then
   the fold has two levels.  Characters are counted per (log, block of
   lines), running sums over a log's blocks tell which of them come before
   those characters are reached, and only their pieces meet (``leading_parts``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.text import TRUNCATE_AT, strip_spaces, truncate_message
from riskloom.operators.joins import broadcast_if_small
from riskloom.session import materialize

#: Line numbers of a block of the two-level message fold.
BLOCK_LINES = 4096

# Line patterns of the scan.  Fixed values.
TRACE_START = r"^Traceback \(most recent call last\):"
EXCEPTION_LINE = r"(?sU)^(\w+):(.*)"
EXTRA_LINE = r"^[^\t ]"
IGNORE_PATTERNS = (r"py4j\.clientserver.*?Closing down clientserver connection",)
# Alert defaults.  Fixed values.
ALERT_PRIORITY = "P3"
ALERT_TAGS = ("airflow.data",)


def exception_heads(
    lines: DataFrame,
    log: str = "log_id",
    order: str = "line_no",
    line: str = "line",
) -> DataFrame:
    """(log, trace_line_no, error_line_no, exception_name, exception_head)
    for every log that has a complete exception."""
    t = lines.where(F.col(line).rlike(TRACE_START)).groupBy(log).agg(F.min(order).alias("_t"))
    cand = lines.join(broadcast_if_small(t), log).where(F.col(order) > F.col("_t"))
    e = (
        cand.where(F.col(line).rlike(EXCEPTION_LINE))
        .groupBy(log)
        .agg(F.min("_t").alias("trace_line_no"), F.min(F.struct(F.col(order).alias("n"), F.col(line).alias("l"))).alias("_e"))
    )
    return e.select(
        log,
        "trace_line_no",
        F.col("_e.n").alias("error_line_no"),
        strip_spaces(F.regexp_extract("_e.l", EXCEPTION_LINE, 1)).alias("exception_name"),
        strip_spaces(F.regexp_extract("_e.l", EXCEPTION_LINE, 2)).alias("exception_head"),
    )


def tail_filter(line: Column, ignore: Sequence[str] = IGNORE_PATTERNS) -> Column:
    """Whether a line after the exception line belongs to the message."""
    keep = line.rlike(EXTRA_LINE)
    for pat in ignore:
        keep = keep & ~line.rlike(pat)
    return keep


def log_exceptions(
    lines: DataFrame,
    log: str = "log_id",
    order: str = "line_no",
    line: str = "line",
    ignore: Sequence[str] = IGNORE_PATTERNS,
) -> DataFrame:
    """The full message of each log's exception as ordered parts:
    (log, exception_name, part_no, part).  part_no = -1 is the text after the
    colon; other parts carry their line number.  Message = parts joined by
    single spaces, in part_no order, stripped."""
    heads = materialize(exception_heads(lines, log, order, line), "heads")  # one row a log, used twice
    head_part = heads.select(log, "exception_name", F.lit(-1).cast("long").alias("part_no"), F.col("exception_head").alias("part"))
    h = broadcast_if_small(heads.select(log, "exception_name", "error_line_no"))
    tail = lines.join(h, log).where((F.col(order) > F.col("error_line_no")) & tail_filter(F.col(line), ignore))
    return head_part.unionByName(
        tail.select(log, "exception_name", F.col(order).cast("long").alias("part_no"), strip_spaces(F.col(line)).alias("part"))
    )


def default_payload(name: Column, message: Column) -> list[Column]:
    """JOB3 default generator: alias, truncated message, priority, tags.  It
    reads no more than ``TRUNCATE_AT`` + 1 characters of the message."""
    return [
        name.alias("alias"),
        truncate_message(message).alias("message"),
        F.lit(ALERT_PRIORITY).alias("priority"),
        F.array(*[F.lit(t) for t in ALERT_TAGS]).alias("tags"),
    ]


def leading_parts(parts: DataFrame, characters: int, log: str = "log_id", block_lines: int = BLOCK_LINES) -> DataFrame:
    """The parts (log, part_no, part) that the first ``characters`` of each
    log's message can come from, each cut to as many characters.

    The lines of a log are counted by blocks, partially in their scan tasks,
    and only the counts of a log's blocks (one row for ``block_lines`` line
    numbers) are ordered and summed up.  Blocks that begin within the first
    ``characters`` are kept: as every part adds one character at least, what is
    kept of a log is one block and ``characters`` parts, whatever its size."""
    blocks = parts.select(log, "part_no", F.floor(F.col("part_no") / block_lines).alias("_block"), F.substring("part", 1, characters).alias("part"))
    sizes = blocks.groupBy(log, "_block").agg(F.sum(F.length("part") + 1).alias("_chars"))
    earlier = Window.partitionBy(log).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.withColumn("_begin", F.coalesce(F.sum("_chars").over(earlier), F.lit(0)))
    first = begin.where(F.col("_begin") < characters).select(log, "_block")
    return blocks.join(broadcast_if_small(first), [log, "_block"], "left_semi").drop("_block")


def messages(parts: DataFrame, log: str = "log_id", characters: int | None = None) -> DataFrame:
    """(log, exception_name, message) from ordered parts.

    The whole message is one value, as a generator that reads all of it must
    be given; with ``characters`` only the parts that its first so many come
    from are put together (the message is right up to there at least).
    Blank parts at either end are cut off first, so a prefix of the parts is
    a prefix of the stripped message."""
    blank = F.col("part") == ""
    ends = parts.groupBy(log).agg(
        F.max("exception_name").alias("exception_name"),
        F.min(F.when(~blank, F.col("part_no"))).alias("_first"),
        F.max(F.when(~blank, F.col("part_no"))).alias("_last"),
    )
    ends = broadcast_if_small(ends)
    inner = parts.select(log, "part_no", "part").join(ends.select(log, "_first", "_last"), log).where(F.col("part_no").between(F.col("_first"), F.col("_last")))
    if characters is not None:
        inner = leading_parts(inner, characters, log)
    joined = inner.groupBy(log).agg(F.array_sort(F.collect_list(F.struct("part_no", "part"))).alias("_p"))
    text = F.coalesce(F.array_join(F.transform("_p", lambda s: s["part"]), " "), F.lit(""))
    return ends.join(joined, log, "left").select(log, "exception_name", text.alias("message"))


def log_alerts(
    lines: DataFrame,
    log: str = "log_id",
    order: str = "line_no",
    line: str = "line",
    ignore: Sequence[str] = IGNORE_PATTERNS,
    payload: Callable[[Column, Column], list[Column]] = default_payload,
    characters: int | None = None,
) -> DataFrame:
    """One alert row per log with an exception: (log, alias, message,
    priority, tags) by default; ``payload`` replaces the generator and gets
    the whole message, or its first ``characters`` if it reads no more."""
    parts = materialize(log_exceptions(lines, log, order, line, ignore), "parts")  # read twice below
    return alerts(parts, log, payload, characters)


def alerts(
    parts: DataFrame,
    log: str = "log_id",
    payload: Callable[[Column, Column], list[Column]] = default_payload,
    characters: int | None = None,
) -> DataFrame:
    """Alert rows from the parts of ``log_exceptions``."""
    if payload is default_payload:
        characters = TRUNCATE_AT + 1
    m = messages(parts, log, characters)
    return m.select(log, *payload(F.col("exception_name"), F.col("message")))
