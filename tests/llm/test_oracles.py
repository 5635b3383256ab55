"""Registered queries against their SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from ledgerline.llm.oracles import ORACLES
from ledgerline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    db = duckdb.connect()
    for table in os.listdir(SF):
        db.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{table}'")
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in found.select(*columns).collect())
