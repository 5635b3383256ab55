"""Registered queries against their SQL in DuckDB on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

CHECKED = [
    "csv_scan_raw", "ingest_lineage", "row_hash", "sanitize_headers", "batch_replace", "map_columns", "clean_status",
    "fact_transactions", "dedupe_last", "qa_duplicates", "match_candidates_tolerance", "match_greedy_nodate",
    "exceptions", "rpt_match_rate_by_month", "dim_vendor_rerun", "qa_flags_one_feed", "qa_outliers_huge", "flags_by_severity",
    "match_greedy_rounds", "match_greedy_tolerance_rounds", "match_greedy_nodate_rounds", "matches_by_score",
    "rpt_top_vendors_huge", "audit_ledgers", "publish_latest", "stage_export",
]


def database(sf):
    db = duckdb.connect()
    for name in os.listdir(sf):
        db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")
    return db


def plain(value):
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, name):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    result = database(SF).execute(oracle_sql()[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    assert got == expected


def test_every_query_has_sql():
    from __spark_entry__ import oracle_sql, queries

    from ledgerline.plans.queries import QUERIES

    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_unrolled_rounds_are_enough(sf):
    from ledgerline.plans.oracles import open_edges
    from ledgerline.plans.queries import CFG, NO_WINDOW, TOLERANT

    db = database(sf)
    for cfg, kind in ((CFG, "typed"), (TOLERANT, "typed"), (NO_WINDOW, "fine")):
        assert db.execute(open_edges(cfg, kind)).fetchone() == (0,)
