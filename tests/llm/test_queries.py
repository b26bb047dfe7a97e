"""Registered queries against DuckDB, and the names the entry point adds."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from oracle_check import TABLES, digest  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from clickmart.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.sql(ORACLE[name]).create_view("oracle")
    want = con.execute("SELECT * FROM oracle")
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(columns, want.fetchall())[0]


def test_entry_has_one_query_an_operator():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
