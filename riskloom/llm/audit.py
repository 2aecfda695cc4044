"""Audit of how corpus filters overlap, by contractions of a contingency tensor (operator 12).

Five filters look at whole documents; a document fails a filter on the condition given:

    A  under 50 words                        B  100 * distinct words < 65 * words
    C  100 * A-Z characters > 5 * characters D  holds one of # $ % & * |
    E  its text is that of a document of a smaller id, anywhere in the table

A word is a run of characters other than space and \\t \\n \\v \\f \\r, case-sensitive.  Whatever the order
in which the filters run, all that can be said about a part of the corpus follows from how many of its
documents fail which set of filters:

1. One pass counts the documents of each part by their five bits: a 2x2x2x2x2 tensor a part (and one for
   the documents of good quality, one for the toxic ones).
2. For every order of the filters and every step, ``einsum`` contracts the tensors with a vector an axis:
   "pass" for the filters before, "fail" for the step's own where documents are removed, "all" for those
   still to come.  The same contraction with "all" or "pass" before gives what the filter would have
   found, what it alone finds, and the Shapley sum.

Filter E is settled by counts too: rows are counted by (text hash, id, part, bits), the smallest id of each
text that has several is one row, and the two meet on (text hash, id), so a text that a third of all rows
share is no hot key.  Nothing but hashes, ids and bits moves.  Texts are equal when their SHA-256 is.

Null texts count as empty, and all empty texts are one text.  A null part is the part ''.  A null id is
smaller than nothing and greater than nothing: such rows never fail E, nor make others fail; they have no
labels.  Rows that share id and text are not copies of each other, but each is a document of its own.
Labels that repeat an id count as good (toxic) if one of them does.  An empty table gives no part and so
no row.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, ship_package

FILTERS = "ABCDE"
CELLS = 2 ** len(FILTERS)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALL, _PASS, _FAIL = range(3)
#: Along an axis: all documents, those that pass, those that fail.
_SELECT = np.array([[1, 1], [1, 0], [0, 1]], np.int64)


def failures(text: Column) -> list[Column]:
    """The failure conditions of filters A to D, as booleans of a text that is not null."""
    words = F.filter(F.split(text, r"[ \x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return [n < 50, distinct * 100 < n * 65, upper * 100 > F.length(text) * 5, text.rlike(r"[#$%&*|]")]


def _bits(flags: Sequence[Column]) -> Column:
    """A number whose binary digits, the first filter's first, are 1 where the filter fails."""
    out = F.lit(0)
    for flag in flags:
        out = out * 2 + flag.cast("int")
    return out


def fail_counts(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", part_col="source") -> DataFrame:
    """part, cell, n, good, toxic: how many documents of each part fail exactly the filters whose bits
    are set in ``cell`` (A is the highest bit), and how many of those are good or toxic."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("body"))
    rows = rows.select("id", "part", F.unhex(F.sha2("body", 256)).alias("hash"), _bits(failures(F.col("body"))).alias("bits"))
    counted = materialize(rows.groupBy("hash", "id", "part", "bits").agg(F.count(F.lit(1)).alias("n")), "counted")
    # The smallest id of each text that stands under several; every other row of such a text fails E.
    least = counted.filter("id is not null").groupBy("hash").agg(F.min("id").alias("id"), F.max("id").alias("most")).filter("id < most")
    first = least.select("hash", "id", F.lit(True).alias("first"))
    copied = least.select("hash", F.lit(True).alias("copied"))
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.filter("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    marks = marks.select("id", *[F.coalesce(c, F.lit(False)).cast("long").alias(c) for c in ("good", "toxic")])
    # Rows without an id have no labels and are spread, not sent to the one place of the null key.
    spread = counted.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("hash")).otherwise(F.lit(0).cast("long")))
    joined = spread.join(first, ["hash", "id"], "left").join(marks.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    joined = joined.select("hash", "id", "part", "bits", "n", "first", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    # By text, part and kind there are few rows however many documents share a text.
    by_text = joined.groupBy("hash", "part", "bits", "good", "toxic").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("first") | F.col("id").isNull(), F.col("n")).otherwise(0)).alias("passing"))
    by_text = by_text.join(copied, "hash", "left").withColumn("late", F.when(F.col("copied"), F.col("n") - F.col("passing")).otherwise(0))
    kinds = F.explode(F.array(F.struct(F.lit(1).alias("e"), F.col("late").alias("m")), F.struct(F.lit(0).alias("e"), (F.col("n") - F.col("late")).alias("m"))))
    split = by_text.select("part", "bits", "good", "toxic", kinds.alias("k")).filter("k.m > 0")
    return split.groupBy("part", (F.col("bits") * 2 + F.col("k.e")).alias("cell")).agg(
        F.sum("k.m").alias("n"), F.sum(F.col("k.m") * F.col("good")).alias("good"), F.sum(F.col("k.m") * F.col("toxic")).alias("toxic"))


def part_tensors(counts: DataFrame) -> DataFrame:
    """part, n, good, toxic: a part's tensors, each an array of 32 counts in cell order."""
    one = lambda c, cell: F.coalesce(F.sum(F.when(F.col("cell") == cell, F.col(c))), F.lit(0))
    return counts.groupBy("part").agg(*[F.array(*[one(c, cell) for cell in range(CELLS)]).alias(c) for c in ("n", "good", "toxic")])


def contract(tensors: np.ndarray, choice: np.ndarray) -> np.ndarray:
    """Counts of the documents that each row of ``choice`` (what to take along each axis) selects from
    each of ``tensors`` (parts x 2 x ... x 2): parts x rows."""
    axes = "abcde"
    return np.einsum(f"p{axes}," + ",".join("r" + a for a in axes) + "->pr", tensors, *[_SELECT[choice[:, k]] for k in range(len(axes))], optimize="greedy")


def step_choices() -> dict[str, np.ndarray]:
    """For every order and step, what to take along each axis: of the documents kept, removed, failing,
    and failing this filter alone."""
    out = {k: [] for k in ("kept", "removed", "failing", "alone")}
    for order in permutations(range(len(FILTERS))):
        for step, own in enumerate(order):
            earlier = list(order[:step])
            kept, removed = np.full(len(FILTERS), _ALL), np.full(len(FILTERS), _ALL)
            kept[[*earlier, own]] = _PASS
            removed[earlier], removed[own] = _PASS, _FAIL
            failing, alone = np.full(len(FILTERS), _ALL), np.full(len(FILTERS), _PASS)
            failing[own] = alone[own] = _FAIL
            for name, choice in zip(out, (kept, removed, failing, alone), strict=True):
                out[name].append(choice)
    return {k: np.array(v) for k, v in out.items()}


def interactions(tensors: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of each, from :func:`part_tensors`."""
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def audit(batches):
        choices = step_choices()
        orders = ["".join(FILTERS[k] for k in order) for order in permutations(range(len(FILTERS)))]
        steps = len(FILTERS)
        rows = len(orders) * steps
        own = np.array([FILTERS.index(order[s]) for order in orders for s in range(steps)])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                n, good, toxic = (np.array(some.column(c).to_pylist(), np.int64).reshape(-1, *[2] * steps) for c in ("n", "good", "toxic"))
                kept, removed, failing, alone = (contract(n, choices[c]) for c in ("kept", "removed", "failing", "alone"))
                shapley = np.stack([removed[:, own == f].sum(1) for f in range(steps)], 1)[:, own]
                found = [kept, removed, failing - removed, alone, contract(good, choices["removed"]), contract(toxic, choices["removed"]), shapley]
                columns = [some.column("part").take(pa.array(np.repeat(np.arange(len(n)), rows))), pa.array(np.repeat(orders, steps).tolist() * len(n)), pa.array(np.tile(np.arange(1, steps + 1), len(orders) * len(n)), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x.ravel(), pa.int64()) for x in found]], names=["part", "filter_order", "step", *COUNTS])

    ship_package(tensors.sparkSession)
    return tensors.select("part", "n", "good", "toxic").mapInArrow(audit, schema)


def filter_audit(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", part_col="source") -> DataFrame:
    """One row a part, order of the filters and step."""
    return interactions(part_tensors(fail_counts(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)))


AUDIT_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
lab AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(lab.toxic, 0) AS toxic,
    {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w), 'C': 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t),
     'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)} AS k
  FROM w LEFT JOIN lab ON w.doc_id = lab.doc_id),
cells AS (SELECT part, [k.A, k.B, k.C, k.D, k.E] AS f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT i, substr('ABCDE', i, 1) AS x FROM range(1, 6) AS r(i)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT filter_order, s AS step, o[s] AS own, list_slice(o, 1, s - 1) AS before FROM orders, range(1, 6) AS r(s)),
seen AS (
  SELECT part, n, good, toxic, filter_order, step, own, f[own] AS fails, len(list_filter(before, lambda i: f[i])) > 0 AS gone, len(list_filter(f, lambda x: x)) AS failed
  FROM cells, steps),
rows AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM rows"""
