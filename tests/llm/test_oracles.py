"""The operators' queries against their SQL, and the registry."""

import duckdb
import pytest

import corpus_pipeline
from marketsignals.llm.queries import ORACLES, QUERIES
from tools.oracle_check import digest

from .conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, rows)[0] == digest(names, res.fetchall())[0]


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert list(corpus_pipeline.QUERIES) == ["pipeline"] and len(corpus_pipeline.STAGES) == 5
