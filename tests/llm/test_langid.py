import itertools
import random

import numpy as np
import pytest
from odd import empty, frame, rows
from pyspark.sql import functions as F

from riskloom.llm import langid as li


@pytest.mark.parametrize("seed", range(30))
def test_labels_equal_all_labellings(seed):
    rng = np.random.default_rng(seed)
    n, langs = int(rng.integers(1, 8)), int(rng.integers(1, 4))
    score = rng.integers(-20, 0, (n, langs)).astype(float)
    switch = float(rng.integers(1, 12))
    value = lambda path: sum(score[i, k] for i, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
    assert value(li.best_labels(score, switch).tolist()) == max(map(value, itertools.product(range(langs), repeat=n)))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = li.identified(docs, li.learn_by_id(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 250 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_documents_and_columns_teach_nothing(spark):
    data = [(i, "the and house of " * 5 if i % 2 else "der und haus von " * 5, "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    changed = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a = li.identified(docs, li.learn_by_id(docs)).select("doc_id", "lang_pred", "score").collect()
    b = li.identified(changed.withColumn("doc_id", -F.col("doc_id")), li.learn_by_id(changed)).select("doc_id", "lang_pred", "score").collect()
    assert sorted((r[0], r[1], r[2]) for r in a) == sorted((-r[0], r[1], r[2]) for r in b)


def mixed(seed, first, second):
    rng = random.Random(seed)
    return " ".join([rng.choice(first) for _ in range(30)] + [rng.choice(second) for _ in range(12)])


EN, DE, RU = "the and house of with from this that".split(), "der und haus von mit aus dieses nicht".split(), "и дом это не на как".split()


def test_spans_scripts_and_odd_rows(spark):
    learnt = [(2, mixed(k, EN, EN), "en") for k in range(5)] + [(2, mixed(k, DE, DE), "de") for k in range(5)] + [(2, mixed(k, RU, RU), "ru") for k in range(5)]
    uri = li.learn(spark.createDataFrame(learnt, "doc_id long, text string, lang string"))
    ask = [(1, mixed(1, EN, DE)), (2, mixed(2, DE, RU)), (3, "дом"), (4, "123 -- !"), (5, "€ 5"), (6, "HOUSE"), (7, "ελλάδα"), *rows()]
    got = li.identified(frame(spark, ask), uri).collect()
    assert len(got) == len(ask)
    by = {(r["doc_id"], len(r["spans"])): r for r in got}
    assert [(s["lang"], s["start"], s["end"]) for s in by[1, 2]["spans"]] == [("en", 0, 30), ("de", 30, 42)]
    assert [(s["lang"], s["start"], s["end"]) for s in by[2, 2]["spans"]] == [("de", 0, 30), ("ru", 30, 42)]
    preds = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(3, "ru"), (4, "und"), (5, "und"), (6, "und"), (6, "en")} <= preds
    assert all(not r["held_out"] for r in got if r["doc_id"] is None)
    kept = li.keep_identified(frame(spark, ask), uri, 0.5)
    assert kept.columns == frame(spark, ask).columns and kept.filter("doc_id = 4").count() == 0  # neither a null text nor digits


def test_nothing_to_learn_from(spark):
    uri = li.learn(spark.createDataFrame([], "lang string, text string"))
    assert {r["lang_pred"] for r in li.identified(frame(spark), uri).collect()} == {"und"}
    assert li.identified(empty(spark), uri).count() == 0
