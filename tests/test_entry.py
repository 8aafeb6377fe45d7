"""The driver contract: entry runs, every query matches its SQL twin."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"event_type", "prediction", "model_name", "model_version", "n_events", "sum_value_k"}


def test_every_twin_is_a_registered_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(rel.columns, rel.fetchall())
