"""Rules and reports on usage read it once, with results by hand on repeated and missing keys."""

from datetime import date
from decimal import Decimal as D

import pytest

from checks import registry
from checks.q_broken import _broken
from meterline.operators.frames import literal_frame
from meterline.plans import quality
from meterline.plans.area import operations_area
from meterline.plans.operations_reports import monthly_usage_statistics, usage_distribution
from meterline.plans.tables import Tables
from tests import small

DAYS = [date(2024, 1, d) for d in (5, 6, 20)] + [date(2024, 2, 3)]


@pytest.fixture(scope="module")
def stage(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("usage") / "content_usage")
    stage = small.stage(spark, DAYS)
    stage.content_usage.write.parquet(folder)
    return stage.replace(content_usage=spark.read.parquet(folder))


@pytest.fixture
def area(stage):
    return operations_area(stage, secret=small.SECRET, reference_date="2024-03-01")


def scans(df, of="content_usage"):
    """Times that a plan scans a table, each use of a shuffle counted."""
    return sum("FileScan" in x and of in x for x in df._jdf.queryExecution().executedPlan().toString().splitlines())


def found(rules):
    return {r.rule_name: r.failed_rows for r in rules.collect()}


def test_warehouse_rules_pass_over_the_detail_once(area, stage):
    rules = quality.operations_warehouse_rules(
        area.dw.replace(content_usage=_broken(area.dw.content_usage)), stage, "2024-03-01"
    )
    assert scans(rules) == 2  # the stored detail, and the source that its total is compared with
    usage = [r for r in small.usage(DAYS) if r[1] != "U4" or r[2] >= date(2024, 2, 1)]
    video = sum(r[3] == "video" and (r[1] != "U2" or r[2] >= date(2024, 1, 10)) for r in usage)
    assert {k: v for k, v in found(rules).items() if v} == {"operations_dw_usage_total": 1, "operations_dw_category_grain": video}


def test_early_rows_count_for_each_row_of_a_repeated_customer(spark):
    users = literal_frame(spark, [
        ("a", date(2024, 1, 3)), ("a", date(2024, 1, 3)), ("a", date(2024, 1, 2)), ("b", None), (None, date(2025, 1, 1)),
    ], "user_id string, subscription_start_date date")
    rows = [("a", date(2024, 1, 1), 2), ("a", date(2024, 1, 2), 1), ("b", DAYS[0], 1), (None, DAYS[0], 2), ("c", DAYS[0], 1), ("a", None, 1)]
    usage = literal_frame(
        spark, [(u, d, "x", "y", D(1)) for u, d, n in rows for _ in range(n)],
        "user_id string, usage_date date, content_category string, content_detail string, data_usage_mb decimal(14,3)",
    )
    grain = ["user_id", "usage_date", "content_category", "content_detail"]
    names = {x: x for x in ("total", "rows", "early", "grain")}
    eligible = literal_frame(spark, [(7, D(8))], "n bigint, mb decimal(14,3)")
    rules = quality._detail_rules(Tables(users=users, content_usage=usage), "user_id", grain, eligible, names)
    assert found(rules) == {"total": 0, "rows": 1, "early": 2 * 3 + 1 * 2, "grain": 2}
    none = quality._detail_rules(Tables(users=users, content_usage=usage.limit(0)), "user_id", grain, eligible.limit(0), names)
    assert found(none) == {"total": 0, "rows": 0, "early": 0, "grain": 0}


def test_reports_on_marts_not_stored_run_no_job_before_their_query(spark, area):
    spark.sparkContext.setJobGroup("no job", "no job")
    try:
        reports = [report(area, "2024-01-01", "2024-03-01") for report in (monthly_usage_statistics, usage_distribution)]
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("no job")
    months = {r.calendar_month: r.recorded_customer_count for r in reports[0].collect()}
    assert months == {date(2024, 1, 1): 2, date(2024, 2, 1): 2}


def test_preaggregate_report_counts_null_keys_and_lost_months(spark):
    def rows(*keys):
        return literal_frame(spark, [(k, m, D(1)) for k, m in keys], "analysis_user_key string, month_key int, total_usage_mb decimal(18,3)")

    fact = rows(("a", 20240101), ("a", 20240202), ("b", None), ("b", 20240301))
    view = rows(("a", 20240101), ("a", 20240101), (None, None), (None, None), ("c", 20240401))
    report = quality.preaggregate_report(
        Tables(customer_monthly_category_usage=fact), Tables(v_customer_monthly_usage_preaggregated=view)
    )
    assert {r.rule_name: r.failed_rows for r in report.collect()} == {
        "view_column_contract": 3, "customer_month_grain": 2, "monthly_usage_reconciliation": 6, "month_first_key": 1,
    }
    empty = quality.preaggregate_report(
        Tables(customer_monthly_category_usage=fact.limit(0)), Tables(v_customer_monthly_usage_preaggregated=view.limit(0))
    )
    assert [r.failed_rows for r in empty.where("rule_name <> 'view_column_contract'").collect()] == [0, 0, 0]


def test_preaggregate_report_reads_fact_and_view_once(area):
    report = quality.preaggregate_report(area.mart, area.views)
    assert scans(report) == 2 and {r.result for r in report.collect()} == {"PASS"}


def test_layer_totals_sum_each_layer_once(stage, area):
    from meterline.plans.area import personalization_area

    pers = personalization_area(stage, reference_date="2024-03-01")
    totals = quality.layer_totals(area.dw, pers.dw, area.mart, pers.mart)
    assert scans(totals) == 4 and {r.total_check for r in totals.collect()} == {"PASS"}


def test_raw_usage_is_summed_once_for_all_its_rules(spark, tmp_path):
    tables = {
        "lineitem": ([(1, 1, 10.5, "A", DAYS[0]), (1, 2, 1.5, "N", DAYS[1]), (2, 1, 2.0, "R", DAYS[0])],
                     "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate date"),
        "orders": ([(1, 7), (2, 9)], "o_orderkey bigint, o_custkey bigint"),
        "customer": ([(7, "a"), (8, "b")], "c_custkey bigint, c_name string"),
        "part": ([(1, 1, "p")], "p_partkey bigint, p_size int, p_name string"),
        "supplier": ([(1, "s")], "s_suppkey bigint, s_name string"),
        "events": ([(1, DAYS[0], 7, "view", 1.0)], "event_id bigint, ts date, user_id bigint, event_type string, value double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    rules = registry.QUERIES["q08_bounds_and_counts_against_raw_usage"](spark, str(tmp_path))
    assert scans(rules, "lineitem") == 0
    assert found(rules) == {"usage_rows": 1, "usage_total": 1, "early_usage": 0, "user_repeats": 1}
