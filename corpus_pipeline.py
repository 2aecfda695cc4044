"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps with all their columns; the last
packs what is left.  Each works on whole texts of all its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, table
from riskloom.llm.decontam import decontaminate
from riskloom.llm.jaccard import keep_one
from riskloom.llm.langid import keep_identified, learn
from riskloom.llm.packing import pack
from riskloom.llm.queries import word_bpe
from riskloom.llm.secrets import without_secrets

#: The least share of letters in a document's own language: with less, three or more languages share it and none leads.
LEAST_SHARE = 0.34
#: Near-duplicates: five-word shingles, Jaccard similarity in hundredths.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a null text or one without letters goes, as does a jumble."""
    return keep_identified(docs, learn(docs.filter(F.col("lang").isNotNull())), LEAST_SHARE)


def _named(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage``, which drops documents by their ids, over ``docs`` of which those without an id have one
    of their own for it, beyond all others.  The ids are written, so that a retry gives the same ones."""
    own = F.col("doc_id").cast("long")
    last, missing = docs.agg(F.max(own), F.count_if(own.isNull())).first()
    if not missing:
        return stage(docs)
    kind, first = docs.schema["doc_id"].dataType, 0 if last is None else max(last + 1, 0)
    ids = docs.filter(own.isNull()).withColumns({"doc_id": F.lit(first).cast("long") + F.monotonically_increasing_id(), "__unnamed": F.lit(True)})
    known = docs.filter(own.isNotNull()).withColumns({"doc_id": own, "__unnamed": F.lit(False)})
    kept = stage(known.unionByName(materialize(ids, "unnamed")))
    return kept.withColumn("doc_id", F.when(~F.col("__unnamed"), F.col("doc_id")).cast(kind)).drop("__unnamed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near and exact copies, that of the smallest id."""
    return _named(docs, lambda named: keep_one(named, SHINGLE_WORDS, SIMILAR_PERCENT))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return _named(docs, lambda named: decontaminate(named, table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no secret is found."""
    return _named(docs, without_secrets)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return pack(docs, word_bpe(), end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("packing", packing),
]

#: Tokenizer ids and a fitted classifier are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
