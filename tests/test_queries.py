"""Every query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, sf, name):
    good, note = compare(spark, con, sf, name)
    assert good, note


def test_entry_has_rows(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["split", "label_idx", "pathology", "modality", "rows"]
    assert rows.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
