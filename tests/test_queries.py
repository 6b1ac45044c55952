"""Every registered query of the engine against its SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from loglake.plans.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(str(tuple(r[k] for k in order)) for r in found)


@needs_data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    ours = queries()[name](spark, SF)
    theirs = con.execute(oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    found = ours.collect()
    assert found and rows(ours.columns, found) == rows(names, theirs.fetchall())


def test_entry_names():
    assert set(oracle_sql()) == set(queries()) <= set(__spark_entry__.queries())


@needs_data
def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() == 700
