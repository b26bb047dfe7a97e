"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, digest, duck_type, type_names  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from clickmart.queries import ORACLE as SQL  # noqa: E402
from clickmart.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    con.sql(SQL[name]).create_view(f"oracle_{name}")  # the SQL must do as a view
    res = con.execute(f"SELECT * FROM oracle_{name}")
    ocols = [d[0] for d in res.description]
    assert dict(type_names(df)) == {c: duck_type(t) for c, t in zip(ocols, con.table(f"oracle_{name}").types)}
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["start_ts", "end_ts", "revenue", "visitors", "purchases", "aov"]
    assert df.count() > 0
