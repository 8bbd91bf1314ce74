"""Every registered query with SQL gives DuckDB's rows."""

import duckdb
import pytest

from blockloom.plans.rest import QUERIES, SQL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows(frame, columns):
    return sorted((tuple(float(x) if isinstance(x, float) or type(x).__name__ == "Decimal" else x for x in r) for r in frame), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, sf, name):
    got = QUERIES[name](spark, sf)
    want = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = rows(map(tuple, got.select(*columns).collect()), columns)
    b = rows(want.select(", ".join(columns)).fetchall(), columns)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, nan_ok=True) if all(isinstance(v, (int, float)) for v in x) else all(p == q or (isinstance(p, float) and p == pytest.approx(q)) for p, q in zip(x, y)), (x, y)
