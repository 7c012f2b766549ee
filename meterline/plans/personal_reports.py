"""Reports of the personalization area: one customer, or all customers with user_id=None."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import day_of_key, month_of_text, month_start
from meterline.plans.area import Area, of_customer
from meterline.plans.marts import day


def _round(column: str, name: str | None = None) -> Column:
    return F.round(column, 1).alias(name or column)


def _in_month(area: Area, year_month: str) -> Area:
    first = month_of_text(F.lit(year_month))
    return area.during_months(first, F.add_months(first, 1))


def monthly_usage(area: Area, user_id: str | None, from_month: str, to_month: str) -> DataFrame:
    last = F.add_months(month_start(day(to_month)), 1)
    view = area.during_months(month_start(day(from_month)), last).views.v_customer_monthly_usage
    return (
        of_customer(view, user_id)
        .orderBy("user_id", "calendar_month")
        .select(
            "user_id", "name", "calendar_month", _round("total_usage_mb"),
            _round("average_daily_usage_mb"),
        )
    )


def daily_usage_of_month(area: Area, user_id: str | None, year_month: str) -> DataFrame:
    first = month_of_text(F.lit(year_month))
    view = area.during_days(first, F.last_day(first)).views.v_customer_month_daily_usage
    return (
        of_customer(view, user_id)
        .orderBy("user_id", "calendar_date")
        .select(
            "user_id", "name", "calendar_date", _round("total_usage_mb", "daily_usage_mb"),
            _round("month_to_date_usage_mb"),
        )
    )


def detail_usage_of_day(area: Area, user_id: str | None, usage_date: str) -> DataFrame:
    view = area.during_days(day(usage_date), day(usage_date)).views.v_customer_day_content_usage
    return (
        of_customer(view, user_id)
        .orderBy("user_id", F.desc("data_usage_mb"), "content_category", "content_detail")
        .select(
            "user_id", "name", "calendar_date", "content_category", "content_detail",
            _round("data_usage_mb"),
        )
    )


def monthly_category_usage(area: Area, user_id: str | None, year_month: str) -> DataFrame:
    view = _in_month(area, year_month).views.v_customer_monthly_category_usage
    return (
        of_customer(view, user_id)
        .orderBy("user_id", F.desc("total_usage_mb"), "content_category")
        .select("user_id", "name", "calendar_month", "content_category", _round("total_usage_mb"))
    )


def monthly_detail_usage(area: Area, user_id: str | None, year_month: str) -> DataFrame:
    view = _in_month(area, year_month).views.v_customer_monthly_detail_usage
    return (
        of_customer(view, user_id)
        .orderBy("user_id", F.desc("total_usage_mb"), "content_category", "content_detail")
        .select(
            "user_id", "name", "calendar_month", "content_category", "content_detail",
            _round("total_usage_mb"),
        )
    )


def selected_service_usage(area: Area, user_id: str | None, year_month: str) -> DataFrame:
    view = _in_month(area, year_month).views.v_customer_selected_service_usage
    return (
        of_customer(view, user_id)
        .orderBy("user_id", "service_id", F.desc("total_usage_mb"))
        .select(
            "user_id", "name", "calendar_month", "service_id", "service_name",
            "content_category", "content_detail", _round("total_usage_mb"),
        )
    )


def recent_usage(area: Area, user_id: str | None) -> DataFrame:
    """Usage of the 7 and 30 days that end at the last day with usage of any customer."""
    latest = area.latest_day()
    view = area.during_days(F.date_sub(latest, 29), latest).views.v_customer_month_daily_usage
    week = F.col("calendar_date") >= F.date_sub(latest, 6)
    return (
        of_customer(view, user_id)
        .groupBy("user_id", "name")
        .agg(
            F.round(F.sum(F.when(week, F.col("total_usage_mb"))), 1).alias("trailing_7d_usage_mb"),
            F.round(F.sum("total_usage_mb"), 1).alias("trailing_30d_usage_mb"),
        )
        .withColumn("reference_date", latest)
    )


def current_plan(area: Area, user_id: str | None) -> DataFrame:
    return of_customer(area.views.v_customer_current_plan, user_id)


def current_services(area: Area, user_id: str | None) -> DataFrame:
    return of_customer(area.views.v_customer_service_current, user_id).orderBy(
        "user_id", "service_id"
    )


def current_discounts(area: Area, user_id: str | None) -> DataFrame:
    return of_customer(area.views.v_customer_discount_current, user_id).orderBy(
        "user_id", "discount_id"
    )


def family_status(area: Area, user_id: str | None) -> DataFrame:
    return of_customer(area.views.v_customer_family_current, user_id)


def recommendation_context(area: Area, user_id: str | None) -> DataFrame:
    """Current plan with usage of the last 7 and 30 days and of the current month."""
    latest = area.latest_day()
    date = day_of_key(F.col("date_key"))
    usage = of_customer(area.mart.customer_daily_usage, user_id)

    def recent(condition: Column) -> Column:
        return F.round(F.sum(F.when(condition, F.col("total_usage_mb"))), 1)

    summed = usage.groupBy("user_id").agg(
        recent(date >= F.date_sub(latest, 6)).alias("trailing_7d_usage_mb"),
        recent(date >= F.date_sub(latest, 29)).alias("trailing_30d_usage_mb"),
        recent(month_start(date) == month_start(latest)).alias("current_month_usage_mb"),
    )
    return current_plan(area, user_id).join(summed, "user_id").withColumn("reference_date", latest)


def plan_candidates(area: Area, min_fee, max_fee) -> DataFrame:
    fee = F.col("monthly_fee")
    return area.views.v_plan_candidates.where(
        fee.between(F.lit(min_fee).cast("decimal(12,2)"), F.lit(max_fee).cast("decimal(12,2)"))
    ).orderBy("monthly_fee", "plan_id")


def plan_benefits(area: Area, plan_id: str | None) -> DataFrame:
    view = area.views.v_plan_benefits
    chosen = view if plan_id is None else view.where(F.col("plan_id") == plan_id)
    return chosen.orderBy("plan_id", F.col("option_group").asc_nulls_last(), "service_id")


def available_dates(area: Area, user_id: str | None) -> DataFrame:
    bounds = (
        of_customer(area.mart.customer_daily_usage, user_id)
        .groupBy("user_id")
        .agg(F.min("date_key").alias("first"), F.max("date_key").alias("last"))
    )
    names = area.mart.dim_customer.select("user_id", "name")
    return bounds.join(names, "user_id").select(
        "user_id",
        "name",
        day_of_key(F.col("first")).alias("min_date"),
        day_of_key(F.col("last")).alias("max_date"),
    )
