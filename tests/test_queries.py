"""Registered queries against their SQL. STATLAKE_ALL=1 compares every query; the default is a sample."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from statlake.plans import all_queries
from statlake.plans.registered import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["x01_parse_time", "p_map_labor", "a02_region_year_statistics", "j02_left_join_statistics", "q08_dataset_gate", "w01_repeated_rows",
          "w06_status_transitions", "a21_exact_percentiles", "k09_search", "k25_tfidf_keywords", "m12_dashboard", "i01_schema_from_data",
          "s02_unwrap_data", "s16_domain_table", "e01_ingest_resumed", "e02_ingest_complete", "e07_priority_ingest", "u03_new_or_changed",
          "s01_landed_objects", "s28_load_history", "s30_update_rows", "e03_ingest_records", "u03_stream_landing", "k09_indexed_search", "j11_joinable_pairs",
          "a15_stored_totals", "q14_profile_check", "a01_bitmap_counts", "x10_normalize_dimension", "k24_ranked_loads"]
all_queries()
NAMES = sorted(ORACLES) if os.environ.get("STATLAKE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = sorted((tuple(norm(v) for v in r) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["year", "region_code"]


def test_plans_have_no_cross_join(spark, sf):
    for name in ("j02_left_join_statistics", "j05_inventory_counts", "k09_search", "k26_vector_search", "j11_join_compatibility"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
