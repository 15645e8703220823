"""The queries that SQL can express against DuckDB, over whole sample tables."""

import os

import duckdb
import pytest

from hourtally.llm.registry import ORACLE_SQL, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR") or "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = duck.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert rows and sorted(rows, key=repr) == sorted(want.select(*columns).fetchall(), key=repr)
