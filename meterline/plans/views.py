"""Read views on the marts. Facts carry natural keys, so a view joins only what it shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import day_of_key
from meterline.functions.measures import EXACT_MB
from meterline.plans.tables import Tables

def _month() -> Column:
    return day_of_key(F.col("month_key")).alias("calendar_month")


def _day() -> Column:
    return day_of_key(F.col("date_key")).alias("calendar_date")


def operations_views(mart: Tables, dw: Tables) -> Tables:
    def plan_names() -> DataFrame:
        return mart.dim_plan.select("plan_id", "plan_name")

    def subscriber_current() -> DataFrame:
        # Counted by plan before the names are joined.
        customers = mart.dim_customer.select("analysis_user_key", "plan_id", "age_band")
        counted = (
            mart.subscriber_current.join(customers, "analysis_user_key")
            .groupBy("as_of_date", "plan_id", "age_band")
            .agg(F.count("*").cast("int").alias("subscriber_count"))
        )
        return counted.join(plan_names(), "plan_id").select(
            "as_of_date", "plan_id", "plan_name", "age_band", "subscriber_count"
        )

    def usage_segment(fact: DataFrame, *period) -> DataFrame:
        return fact.join(plan_names(), "plan_id").select(
            *period, "plan_id", "plan_name", "age_band", "content_category", "total_usage_mb",
            "usage_user_count", "average_usage_mb",
        )

    def monthly_usage_preaggregated() -> DataFrame:
        # Grouping by the fact's own keys keeps a month_key filter pushable to the scan.
        totals = mart.customer_monthly_category_usage.groupBy(
            "month_key", "analysis_user_key"
        ).agg(F.sum("total_usage_mb").cast(EXACT_MB).alias("total_usage_mb"))
        return totals.select("analysis_user_key", _month(), "total_usage_mb", "month_key")

    def customer_count(fact: DataFrame, key: str, dim: DataFrame, *attributes: str) -> DataFrame:
        counted = fact.groupBy(key).agg(F.count("*").cast("int").alias("customer_count"))
        return counted.join(dim, key).select(key, *attributes, "customer_count")

    return Tables(
        v_subscriber_current=subscriber_current,
        v_daily_usage_segment=lambda: usage_segment(mart.daily_usage_segment, _day()),
        v_monthly_usage_segment=lambda: usage_segment(mart.monthly_usage_segment, _month()),
        v_customer_daily_usage=lambda: mart.customer_daily_usage.select(
            "analysis_user_key", _day(), "total_usage_mb"
        ),
        v_customer_monthly_category_usage=lambda: mart.customer_monthly_category_usage.select(
            "analysis_user_key", _month(), "content_category", "total_usage_mb"
        ),
        v_family_current=lambda: mart.family_current,
        v_service_current=lambda: customer_count(
            mart.customer_service_current, "service_id", mart.dim_service,
            "service_name", "service_category",
        ),
        v_discount_current=lambda: customer_count(
            mart.customer_discount_current, "discount_id", mart.dim_discount,
            "discount_name", "policy_domain",
        ),
        v_plan_catalog=lambda: mart.dim_plan,
        v_plan_age_benefits=lambda: dw.plan_age_benefits.drop("source_batch_id")
        .join(dw.plans.select("plan_id", "plan_name"), "plan_id")
        .join(
            dw.age_benefits.select("age_benefit_id", "benefit_name", "min_age", "max_age"),
            "age_benefit_id",
        )
        .select(
            "plan_id", "plan_name", "age_benefit_id", "benefit_name", "min_age", "max_age",
            "bonus_data_gb", "bonus_shared_data_gb", "bonus_voice_minutes", "bonus_sms_count",
            "bonus_video_minutes",
        ),
        v_customer_monthly_usage_preaggregated=monthly_usage_preaggregated,
    )


def personalization_views(mart: Tables, dw: Tables) -> Tables:
    def named(fact: DataFrame, *columns) -> DataFrame:
        names = mart.dim_customer.select("user_id", "name")
        return fact.join(names, "user_id").select("user_id", "name", *columns)

    def monthly_category() -> DataFrame:
        # Rolled up from detail on the keys alone; names join the smaller result.
        rolled = mart.customer_monthly_content_usage.groupBy(
            "user_id", "month_key", "content_category"
        ).agg(F.sum("total_usage_mb").cast(EXACT_MB).alias("total_usage_mb"))
        return named(rolled, _month(), "content_category", "total_usage_mb")

    def selected_service_usage() -> DataFrame:
        bridge = mart.bridge_service_content.join(
            mart.dim_service.select("service_id", "service_name"), "service_id"
        )
        usage = mart.customer_monthly_content_usage.join(
            bridge, ["content_category", "content_detail"]
        )
        chosen = mart.customer_service_current.select("user_id", "service_id")
        return named(
            usage.join(chosen, ["user_id", "service_id"]),
            _month(), "service_id", "service_name", "content_category", "content_detail",
            "total_usage_mb",
        )

    def current_plan() -> DataFrame:
        customers = mart.dim_customer.select("user_id", "name", "plan_id")
        return customers.join(mart.dim_plan, "plan_id").select(
            "user_id", "name", "plan_id", "plan_name", "plan_family", "plan_category",
            "monthly_fee", "data_limit_gb", "is_unlimited", "choice_tier", "network_type",
        )

    return Tables(
        v_customer_month_daily_usage=lambda: named(
            mart.customer_daily_usage, F.trunc(day_of_key(F.col("date_key")), "MM").alias(
                "calendar_month"
            ), _day(), "total_usage_mb", "month_to_date_usage_mb",
        ),
        v_customer_day_content_usage=lambda: named(
            mart.customer_content_daily_usage, _day(), "content_category", "content_detail",
            "data_usage_mb",
        ),
        v_customer_monthly_usage=lambda: named(
            mart.customer_monthly_usage, _month(), "total_usage_mb", "average_daily_usage_mb"
        ),
        v_customer_monthly_category_usage=monthly_category,
        v_customer_monthly_detail_usage=lambda: named(
            mart.customer_monthly_content_usage, _month(), "content_category", "content_detail",
            "total_usage_mb",
        ),
        v_customer_selected_service_usage=selected_service_usage,
        v_customer_current_plan=current_plan,
        v_customer_discount_current=lambda: named(
            mart.customer_discount_current.join(mart.dim_discount, "discount_id"),
            "discount_id", "discount_name", "policy_domain", "start_date",
        ),
        v_customer_service_current=lambda: named(
            mart.customer_service_current.join(mart.dim_service, "service_id"),
            "service_id", "service_name", "service_category", "benefit_type", "start_date",
        ),
        v_customer_family_current=lambda: named(
            mart.customer_family_current.join(mart.dim_family, "family_id"),
            "family_id", "has_bundle", "bundle_type", "has_home_internet",
            "internet_product_group", "internet_status",
        ),
        v_plan_candidates=lambda: mart.dim_plan,
        v_plan_benefits=lambda: dw.plan_benefits.drop("source_batch_id")
        .join(dw.plans.select("plan_id", "plan_name"), "plan_id")
        .join(
            dw.additional_services.select("service_id", "service_name", "service_category"),
            "service_id",
        )
        .select(
            "plan_id", "plan_name", "benefit_type", "benefit_value", "is_selectable",
            "option_group", "selection_count", "service_id", "service_name", "service_category",
        ),
    )


def register_views(views: Tables) -> list[str]:
    """Temporary views of one area in its own session; the areas are not to be mixed in one."""
    for name in views:
        views[name].createOrReplaceTempView(name)
    return list(views)
