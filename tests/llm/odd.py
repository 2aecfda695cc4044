"""Small documents with everything that is odd: nulls, empty, long, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "the of and a to in is that thing wording letter house über été año ciudad haus straße".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed", "er"]) + str(rng.choice("abcdefgh")) for _ in range(n))


def rows() -> list[tuple]:
    """(doc_id, text)."""
    base = prose(1, 80)
    return [
        (1, base), (2, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, " \n\t "), (7, "word"), (8, "two words"),
        (9, prose(2, 6000)), (10, "日本語 text ünï \U0001f600 ß"), (None, prose(3, 30)), (None, None), (11, prose(4, 60)), (12, "WORD"),
        (13, "x" * 5000), (-5, prose(5, 40)), (2**40, prose(6, 40)),
    ]


#: Columns whose names operators use inside; they must not get in the way.
CLASHING = "spans string, n long, length long, start long, words string, lang string, source string, node long, cell long, part int, score double, item long, found string"


def frame(spark: SparkSession, data: list[tuple] | None = None, partitions: int = 3) -> DataFrame:
    data = rows() if data is None else data
    extra = len(CLASHING.split(","))
    schema = f"doc_id long, text string, {CLASHING}"
    return spark.createDataFrame([(*r, *[None] * extra) for r in data], schema).repartition(partitions)


def empty(spark: SparkSession) -> DataFrame:
    return frame(spark, [], 1)
