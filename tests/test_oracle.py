"""Every query with SQL gives the SQL's rows, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
from millrace import queries  # noqa: E402

DATA = os.environ.get("MILLRACE_DATA", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted(
        (tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall()), key=repr
    )
