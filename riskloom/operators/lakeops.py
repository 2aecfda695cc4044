"""Lake-operations jobs (JOB4-JOB6, JOB9-JOB11, AGG4, AGG5, WIN1, PRJ9-11,
JON4, JON6).

All are aggregates, filters and joins of small aggregated sides; none
gathers a key's rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.text import (
    count_to_select,
    has_destructive_word,
    starts_with_drop_alter,
    table_names,
)


# ------------------------------------------------------------ inventory jobs
def latest_objects(inv: DataFrame, partition: str = "partition", path: str = "path", mtime: str = "mtime") -> DataFrame:
    """AGG5/WIN1: per partition the object count, the latest modified time and
    the latest object (ties → smallest path, the one a listing shows first) —
    one partial+final aggregate."""
    return inv.groupBy(partition).agg(*latest_aggregates(path, mtime))


def latest_aggregates(path: str = "path", mtime: str = "mtime") -> list[Column]:
    """n_objects, latest_mtime, latest_path of a group, batch or streaming."""
    age = -F.unix_micros(F.col(mtime).cast("timestamp"))
    first = F.min(F.when(F.col(mtime).isNotNull(), F.struct(age.alias("a"), F.col(path).alias("p"))))
    return [F.count(F.lit(1)).alias("n_objects"), F.max(mtime).alias("latest_mtime"), first["p"].alias("latest_path")]


def marks_at(inv: DataFrame, cutoff: str, partition: str = "partition", mtime: str = "mtime") -> DataFrame:
    """Stored marks as they were at ``cutoff``: latest mtime seen by then."""
    return (
        inv.where(F.col(mtime) <= F.to_timestamp(F.lit(cutoff)))
        .groupBy(partition)
        .agg(F.max(mtime).alias("stored_mark"))
    )


def settled_check(inv: DataFrame, marks: DataFrame, partition: str = "partition") -> DataFrame:
    """JOB4: a partition is settled iff it has objects and its latest mtime is
    not after the stored mark; otherwise the new mark is the latest mtime.
    Partitions known only to the mark table are reported as not settled."""
    return settle(latest_objects(inv, partition).drop("latest_path"), marks, partition)


def settle(latest: DataFrame, marks: DataFrame, partition: str = "partition", how: str = "full_outer") -> DataFrame:
    """The settled decision of JOB4 from per-partition ``latest`` rows (count,
    latest mtime and whatever else they carry) and stored marks."""
    carried = [c for c in latest.columns if c not in (partition, "n_objects", "latest_mtime")]
    j = latest.join(marks, partition, how)
    n = F.coalesce(F.col("n_objects"), F.lit(0)).cast("long")
    settled = (n > 0) & F.col("stored_mark").isNotNull() & (F.col("latest_mtime") <= F.col("stored_mark"))
    settled = F.coalesce(settled, F.lit(False))
    new_mark = F.when(settled, F.col("stored_mark")).when(n > 0, F.col("latest_mtime")).otherwise(F.col("stored_mark"))
    return j.select(partition, n.alias("n_objects"), "latest_mtime", *carried, "stored_mark", settled.alias("settled"), new_mark.alias("new_mark"))


def retention_candidates(
    inv: DataFrame,
    now: str,
    days: int = 30,
    exclude: Sequence[str] = (),
    path: str = "path",
    mtime: str = "mtime",
    root: str = "",
) -> DataFrame:
    """JOB11/PRJ10: files whose whole-day age exceeds ``days`` and none of
    whose directories below ``root`` (any depth) is named in ``exclude``."""
    age_us = F.unix_micros(F.to_timestamp(F.lit(now))) - F.unix_micros(F.col(mtime).cast("timestamp"))
    age_days = F.floor(age_us / F.lit(86_400_000_000)).cast("long")
    top = root.rstrip("/") + "/" if root else ""
    below = F.when(F.col(path).startswith(top), F.substring(F.col(path), len(top) + 1, 2**31 - 1)).otherwise(F.col(path))
    parts = F.split(below, "/")
    dirs = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    keep = age_days > F.lit(days)
    if exclude:
        excl = F.array(*[F.lit(x) for x in exclude])
        keep = keep & ~F.arrays_overlap(dirs, excl)
    return inv.select(path, age_days.alias("age_days")).where(keep)


def name_flags(inv: DataFrame, prefix: str | None = None, contains: str | None = None, name: str = "name") -> DataFrame:
    """PRJ9: not hidden, prefix match and substring match per object."""
    n = F.col(name)
    out = [F.col("path"), n, (~n.startswith(".")).alias("visible")]
    out.append((n.startswith(prefix) if prefix is not None else F.lit(True)).alias("has_prefix"))
    out.append((n.contains(contains) if contains is not None else F.lit(True)).alias("has_substring"))
    return inv.select(*out)


# ------------------------------------------------------------ state items
def _usable(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def state_ranges(items: DataFrame, pk: str = "pk", min_col: str = "min_ts", max_col: str = "max_ts") -> DataFrame:
    """JOB5/AGG4 for every key: (pk, min_ts, max_ts) over items that have both
    texts non-empty, compared as text; NULLs when a key has none."""
    both = _usable(F.col(min_col)) & _usable(F.col(max_col))
    return items.groupBy(pk).agg(
        F.min(F.when(both, F.col(min_col))).alias("min_ts"),
        F.max(F.when(both, F.col(max_col))).alias("max_ts"),
    )


def state_attributes(items: DataFrame, attributes: Sequence[str], pk: str = "pk", seq: str = "seq") -> DataFrame:
    """JOB6/PRJ11: (pk, attribute, value) — for each key and requested
    attribute the value of the last item (by ``seq``) that has it.  Requested
    attributes that no item has are omitted."""
    present = [a for a in attributes if a in items.columns]
    if not present:
        return items.sparkSession.createDataFrame([], f"{pk} string, attribute string, value string")
    long = items.unpivot([pk, seq], present, "attribute", "value").where(F.col("value").isNotNull())
    return long.groupBy(pk, "attribute").agg(F.max_by("value", seq).alias("value"))


def remaining_items(items: DataFrame, consumed: Sequence[str], pk: str = "pk") -> DataFrame:
    """JON4: the items left after consuming ``consumed`` keys (NULL keys stay)."""
    hit = F.coalesce(F.col(pk).isin(list(consumed)), F.lit(False))
    return items.where(~hit)


def consume_range(path: str, items: DataFrame, keys: DataFrame, pk: str = "pk") -> tuple[DataFrame, DataFrame]:
    """JOB5 as a step: (the ranges of the consumed ``keys``, the items that
    are left).  The remainder is written as the next version of the state
    under ``path``; see :func:`_consume`."""
    taken, left = _consume(path, items, keys, pk)
    return state_ranges(taken, pk), left


def consume_attributes(path: str, items: DataFrame, keys: DataFrame, attributes: Sequence[str], pk: str = "pk", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """JOB6 as a step: (the last values of the requested attributes of the
    consumed ``keys``, the items that are left), as :func:`consume_range`."""
    taken, left = _consume(path, items, keys, pk)
    return state_attributes(taken, attributes, pk, seq), left


def _consume(path: str, items: DataFrame, keys: DataFrame, pk: str) -> tuple[DataFrame, DataFrame]:
    """Split ``items`` by a table of keys (any size; a NULL key consumes the
    items without one) and write both sides once: taken/ and left/ under
    ``path``, so what is returned does not change when the state moves on."""
    keys = keys.select(F.col(pk).alias("_key")).distinct()
    same = items[pk].eqNullSafe(F.col("_key"))
    spark = items.sparkSession
    out = []
    for name, how in (("taken", "left_semi"), ("left", "left_anti")):
        items.join(keys, same, how).write.mode("overwrite").parquet(f"{path}/{name}")
        out.append(spark.read.schema(items.schema).parquet(f"{path}/{name}"))
    return out[0], out[1]


# ------------------------------------------------------------ reconciliation
def reconcile_counts(source: DataFrame, lake: DataFrame, ts: str = "ts", grain: str = "hour") -> DataFrame:
    """JOB9/JON6: rows per time slot on both sides, full outer joined;
    status = match / missing (lake has none) / mismatch."""
    s = source.groupBy(F.date_trunc(grain, F.col(ts)).alias("slot")).agg(F.count(F.lit(1)).alias("source_count"))
    l = lake.groupBy(F.date_trunc(grain, F.col(ts)).alias("slot")).agg(F.count(F.lit(1)).alias("lake_count"))
    j = s.join(l, "slot", "full_outer")
    sc = F.coalesce(F.col("source_count"), F.lit(0)).cast("long")
    lc = F.coalesce(F.col("lake_count"), F.lit(0)).cast("long")
    status = F.when(sc == lc, "match").when(lc == 0, "missing").otherwise("mismatch")
    return j.select("slot", sc.alias("source_count"), lc.alias("lake_count"), status.alias("status"))


# ------------------------------------------------------------ query text
def query_lineage(stmts: DataFrame, query: str = "query") -> DataFrame:
    """JOB10: (table_name, n_statements) — tables named after FROM/JOIN."""
    t = stmts.select(F.explode(table_names(F.col(query))).alias("table_name"))
    return t.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_statements"))


def statement_checks(stmts: DataFrame, id_col: str = "stmt_id", query: str = "query") -> DataFrame:
    """FN6-FN8 per statement: unsafe flags and the COUNT(*) → * rewrite."""
    q = F.col(query)
    return stmts.select(
        id_col,
        has_destructive_word(q).alias("has_drop_delete"),
        starts_with_drop_alter(q).alias("leading_drop_alter"),
        count_to_select(q).alias("rewritten"),
        F.size(table_names(q)).alias("n_tables"),
    )
