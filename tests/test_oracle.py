"""Every registered query against DuckDB, in two session zones."""

import os
import subprocess
import sys
import tempfile

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

TABLES = ("events", "lineitem")
# Days of the sample: every query keeps some rows and leaves some out, and few directories are
# written. ORACLE_SF_DIR runs whole tables instead.
DAYS = {
    "events": "ts < '2024-01-27'",
    "lineitem": "l_shipdate BETWEEN '1995-11-15' AND '1996-02-15' "
    "OR l_shipdate BETWEEN '1996-12-15' AND '1997-01-31'",
}


def _some_days():
    folder = tempfile.mkdtemp(prefix="hourtally-oracle-")
    for table, days in DAYS.items():
        duckdb.connect().execute(
            f"COPY (SELECT * FROM '/root/testdata/sf0.001/{table}.parquet' WHERE {days}) "
            f"TO '{folder}/{table}.parquet' (FORMAT parquet)"
        )
    return folder


FOLDER = os.environ.get("ORACLE_SF_DIR") or _some_days()

QUERIES = entry_module._own_queries()
ORACLES = entry_module._own_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def rows(frame):
    """Sorted rows, columns in name order, numbers of any width alike."""

    def cell(value):
        if pd.isna(value):
            return "NULL"
        return float(value) if isinstance(value, (int, float)) else str(value)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(cell, r)) for r in frame.itertuples(index=False)), key=repr)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got, want = rows(result.toPandas()), rows(expected.df())
    assert len(got) == len(want) > 0
    assert got == want


@pytest.mark.parametrize(
    "name",
    [
        "hourly_total_views",
        "daily_media_totals",
        "hourly_rows_and_views",
        "normalize_pagecounts",
        "interval_derivations",
        "keyed_ingest_first_wins",
    ],
)
def test_does_not_depend_on_session_zone(spark, duck, zone, name):
    zone("America/New_York")
    assert rows(QUERIES[name](spark, FOLDER).toPandas()) == rows(duck.sql(ORACLES[name]).df())


def test_a_missing_corpus_library_leaves_the_other_queries():
    code = (
        "import sys, warnings; sys.modules['ahocorasick'] = None; warnings.simplefilter('ignore');"
        "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e._own_queries()))"
    )
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert out.stdout.strip() == "True", out.stderr


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize(
    ("module", "filter_name", "names"),
    [
        ("reports", "article_is", ["hourly_views_by_article", "stored_views_by_article"]),
        ("reports", "epoch_between", ["hourly_rows_and_views", "stored_epoch_range"]),
        ("filters", "epoch_between", ["relative_window_views"]),
    ],
)
def test_queries_fail_without_their_filter(spark, duck, monkeypatch, module, filter_name, names):
    from hourtally.operators import filters
    from hourtally.plans import reports

    holder = {"reports": reports, "filters": filters}[module]
    monkeypatch.setattr(holder, filter_name, lambda df, *_: df)
    for name in names:
        got = rows(QUERIES[name](spark, FOLDER).toPandas())
        assert got != rows(duck.sql(ORACLES[name]).df())
