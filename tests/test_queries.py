"""Every registered query against its DuckDB oracle (the driver's gate, at the test SF)."""

import duckdb
import pytest

from __spark_entry__ import entry, queries
from tidewater.plans import ORACLES, QUERIES
from tools.check import TABLES, digest

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(NAMES) - set(ORACLES)
    assert rows_only == set()
    assert set(ORACLES) <= set(NAMES)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "user_id", "n", "max_value", "min_value"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    df = queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(rows) > 0
        return
    rel = con.execute(ORACLES[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
