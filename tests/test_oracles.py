"""Every query of the library against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from marketsignals.plans import ORACLES, QUERIES, load_all
from marketsignals.sources.tables import TABLES, table_path
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{table_path(SF, t)}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
