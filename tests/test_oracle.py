"""Every registered query against its DuckDB SQL, and the entry point."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import compare
from ashgrid.plans.catalog import REGISTRY
from ashgrid.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_duckdb(spark, con, name):
    r = compare(spark, SF_SMALL, name, E.queries()[name], E.oracle_sql()[name], con)
    assert r["ok"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["yr", "area_total", "n_rows"]
    assert df.count() > 0
