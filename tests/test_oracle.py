"""Every registered query against its DuckDB oracle on the smallest data folder."""

import duckdb
import pytest

from __spark_entry__ import entry
from orderflow.plans.flow import TABLES
from orderflow.plans.oracle import oracle_sql
from orderflow.plans.queries import queries

from conftest import SF_SMALL

import sys, os
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import canon  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    got = canon(queries()[name](spark, SF_SMALL).toPandas())
    want = canon(con.execute(oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["order_status", "order_count"]
    assert {r.order_status for r in rows} == {"COMPLETED", "PAYMENT_FAILED", "INVENTORY_REJECTED"}
