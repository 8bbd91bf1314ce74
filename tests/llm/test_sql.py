"""Queries with SQL give DuckDB's rows, on sf0.01 and on odd rows."""

import duckdb
import pandas as pd
import pytest

from blockloom.llm.queries import QUERIES, SQL

LONG = " ".join(f"t{i}" for i in range(120))
ODD = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "One two"), (5, "one TWO"), (6, LONG), (7, f"a b {LONG.upper()} c"), (8, f"lead {LONG} tail"), (9, "w " * 300), (10, "w " * 200), (11, "é ü Éa_b-c")]


def same(got, want):
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.select(", ".join(columns)).fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    same(QUERIES[name](spark, sf), con.sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_odd(spark, tmp_path, name):
    con = duckdb.connect()
    docs = pd.DataFrame(ODD, columns=["doc_id", "text"]).astype({"text": object})
    docs["lang"], docs["source"], docs["n_chars"] = "en", "x", 1
    docs.to_parquet(f"{tmp_path}/documents.parquet")
    pd.DataFrame([(1, " ".join(LONG.split()[:40])), (2, "One"), (3, None), (4, "?"), (15, "a b-c")], columns=["item_id", "text"]).to_parquet(f"{tmp_path}/benchmark.parquet")
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    same(QUERIES[name](spark, str(tmp_path)), con.sql(SQL[name]))
