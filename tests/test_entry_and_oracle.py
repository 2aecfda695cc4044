"""Contract checks and the SQL oracle comparison at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from riskloom.plans.oracle import queries_sql
from riskloom.plans.registry import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Queries without SQL oracle (MLlib models, slow hash, rows-only checks).
ROWS_ONLY = {
    "lasso_selection", "selection_summary", "train_decision_tree", "train_random_forest", "train_gbt",
    "train_mlp", "model_selection", "save_load_tree", "tokenize_slow", "tree_codes",
    "exact_tree", "exact_forest", "knn_vectors_approx",
}


def test_registry_and_oracle_keys_agree():
    assert set(queries_sql()) <= set(REGISTRY) <= set(E.queries())
    assert set(REGISTRY) - set(queries_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"prediction", "n", "prediction_label"}
    assert sum(r["n"] for r in rows) > 0


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries_sql()))
def test_query_matches_sql_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 1
