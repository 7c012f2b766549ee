"""Usage built from narrow keys against the SQL of the fixtures, and the settings that large tables need."""

from datetime import datetime

import pytest

from checks import fixtures
from meterline.session import configure_tables

DAY = datetime(2024, 1, 2, 3)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("base"))
    keys = [0, 7, -5, 9_999_999, 12_345_678, 123_456_789, 1_234_567, -12_345_678, None]
    orders = [(n, key) for n, key in enumerate(keys)] + [(1, 7), (None, 3)]
    lines = [
        (n, line, price, flag, day)
        for n in [*range(len(keys)), 99, None] for line in (0, 1, 2, 3, -1, None)
        for flag, price, day in (("A", 10.5, DAY), ("N", None, DAY), ("R", 0.0005, None), (None, 7.25, DAY), ("A", 1.25, DAY))
    ]
    events = [
        (n, DAY if n and n % 5 else None, key, kind, 0.125)
        for n in [*range(-3, 8), None] for key in keys for kind in ("view", "click", "signup", "purchase", "other", None)
    ]
    tables = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint"),
        "lineitem": (lines, "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp"),
        "events": (events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name, base", [("content_usage", ("lineitem", "orders")), ("recent_usage", ("events",))])
def test_usage_has_the_rows_of_its_sql(spark, folder, name, base):
    for table in base:
        spark.read.parquet(f"{folder}/{table}.parquet").createOrReplaceTempView(table)
    told = spark.sql(fixtures.with_tables(f"select * from {name}"))
    built = getattr(fixtures, name)(spark, folder)
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in told.schema]
    assert sorted(map(repr, built.collect())) == sorted(map(repr, told.collect()))


def test_only_numbers_are_shuffled_for_usage(spark, folder):
    for name in ("content_usage", "recent_usage"):
        plan = getattr(fixtures, name)(spark, folder)._jdf.queryExecution().executedPlan().toString()
        keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert keys and all("kind" in line or "orderkey" in line for line in keys)


def test_a_table_of_users_is_not_collected_for_joins(spark):
    configure_tables(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1MB"
    assert spark.conf.get("spark.sql.unionOutputPartitioning") == "false"
