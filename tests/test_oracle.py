"""Registered queries against DuckDB on the smallest data; FULL_ORACLE=1 runs all of them."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry

FOLDER = Path("/root/testdata/sf0.001")
OWN = registry.queries()
QUERIES, ORACLES = OWN, registry.oracle_sql()
SAMPLE = [
    "a01_plan_mix_by_age_band", "a02_monthly_usage_statistics", "a03_usage_against_allowance",
    "a05_usage_distribution_all", "a13_recent_usage", "b18_customer_daily_usage",
    "d05_current_discount_amounts", "i10_correction_customer_daily", "p02_fee_distribution",
    "q30_master_rules", "r03_rollover_allowances", "r03_rollover_continued", "r03_rollover_spans",
    "u02_changed_usage", "v16_customer_selected_service",
]
NAMES = sorted(ORACLES) if os.environ.get("FULL_ORACLE") else SAMPLE


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(OWN) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, oracle, name):
    df = QUERIES[name](spark, str(FOLDER))
    result = oracle.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = result.fetchall()
    got = [tuple(row[column] for column in names) for row in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
