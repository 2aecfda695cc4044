"""Unlabelled documents without some feature are scored like any other row to score."""

import random

import duckdb
import pytest

import __spark_entry__ as E
from test_entry_and_oracle import _rows

#: (doc_id, text, n_chars) without a label: no text, no characters, no words, no count.
ODD = [(9001, None, None), (9002, "", 0), (9003, " \n\t ", 4), (9004, "Some text here 12.", None), (9005, None, 7)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """(folder, number of documents to score)."""
    rng, d = random.Random(5), str(tmp_path_factory.mktemp("odd"))
    words = "The of 7 to in 1984 Haus letter thing and".split()
    docs = [(i, rng.choice(" \n").join(rng.choice(words) + rng.choice(["", "s", "Ed"]) for _ in range(rng.randint(3, 60)))) for i in range(240)]
    docs = [(i, t, len(t)) for i, t in docs] + ODD
    spark.createDataFrame(docs, "doc_id long, text string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    return d, 40 + len(ODD)


@pytest.mark.parametrize("name", ["save_load_score", "score_histogram", "stream_score"])
def test_neighbours_vote_for_every_row_as_in_sql(spark, tables, name):
    d, n = tables
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    df = E.queries()[name](spark, d)
    got, want = [tuple(r) for r in df.collect()], con.execute(E.oracle_sql()[name])
    assert _rows(df.columns, got) == _rows([c[0] for c in want.description], want.fetchall())
    assert n == (sum(r[df.columns.index("n")] for r in got) if "n" in df.columns else len(got))


@pytest.mark.parametrize("name", ["save_load_tree", "tree_codes"])
def test_a_tree_scores_every_row(spark, tables, name):
    d, n = tables
    assert sum(r["n"] for r in E.queries()[name](spark, d).collect()) == n
