"""The registered queries at sf0.001: against DuckDB where SQL can express them, else against plain code."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm.queries import QUERIES
from riskloom.llm.sql import QUERIES_SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES_SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(QUERIES_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_op1_equals_the_library(spark, documents):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = {r["doc_id"]: tuple(r) for r in QUERIES["op1_id_store"](spark, SF).collect()}, 0
    for key in sorted(documents):
        ids = [*own.encode(documents[key] or "", add_special_tokens=False).ids, 1]
        assert got.pop(key) == (key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_op5_finds_the_passages_that_stand_in_the_documents(spark, duck, documents):
    items = dict(duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    whole = {(d, i) for d, text in documents.items() for i, item in items.items() if item in text}
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    assert whole and whole <= set(got) and all(got[p] == 1.0 for p in whole)
    assert all(s >= 0.8 for s in got.values())


def test_op6_changes_only_personal_data(spark, documents):
    for r in QUERIES["op6_pseudonyms"](spark, SF).collect():
        n = sum(r[c] for c in r.asDict() if c.startswith("n_"))
        assert (r["text"] == documents[r["doc_id"]]) == (n == 0)


def test_op9_is_a_packing(spark, documents):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op9_packing"](spark, SF).collect()
    sizes = {key: len(own.encode(t or "", add_special_tokens=False).ids) + 1 for key, t in documents.items()}
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        sizes[r["doc_id"]] -= r["length"]
    assert not any(sizes.values())
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= 2048
    assert len(by) <= -(-sum(r["length"] for r in rows) // 2048) + 2


@pytest.mark.parametrize("name", ["op3_fingerprints", "op4_token_counts", "op7_language_id"])
def test_one_row_a_document(spark, documents, name):
    got = QUERIES[name](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
