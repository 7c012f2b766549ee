"""Join recipes on the source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.fixed_values import SERVICE_DETAILS
from meterline.functions.calendar import month_start
from meterline.functions.measures import EXACT_MB, mb_to_gb, service_of_detail
from meterline.operators.frames import literal_frame
from meterline.plans.area import of_customer
from meterline.plans.tables import Tables


def _with_plan(users: DataFrame, plans: DataFrame, *columns: str) -> DataFrame:
    chosen = plans.select(F.col("plan_id").alias("current_plan_id"), *columns)
    return users.join(chosen, "current_plan_id")


def user_with_plan(stage: Tables) -> DataFrame:
    return _with_plan(
        stage.users, stage.plans, "plan_name", "monthly_fee", "data_limit_gb", "is_unlimited"
    ).select("user_id", "name", "plan_name", "monthly_fee", "data_limit_gb", "is_unlimited")


def family_members(stage: Tables, user_id: str) -> DataFrame:
    """All members of a customer's family, the customer included."""
    target = stage.users.where(F.col("family_id").isNotNull())
    own = of_customer(target, user_id).select("family_id")
    return stage.users.join(own, "family_id", "left_semi").select(*stage.users.columns)


def user_discount_kinds(stage: Tables, user_id: str | None = None) -> DataFrame:
    entitlements = stage.user_discounts.where(F.col("status") == "ACTIVE").select(
        "user_id", "bundle_composition_id", "discount_id", "start_date"
    )
    users = of_customer(stage.users, user_id).select("user_id", "name")
    roles = stage.bundle_discount_compositions.select("bundle_composition_id", "component_role")
    return (
        of_customer(entitlements, user_id)
        .join(users, "user_id")
        .join(roles, "bundle_composition_id")
        .join(stage.discounts.select("discount_id", "discount_name"), "discount_id")
        .select("user_id", "name", "discount_id", "discount_name", "component_role", "start_date")
    )


def family_internet(stage: Tables, user_id: str | None = None) -> DataFrame:
    users = of_customer(stage.users, user_id).select("user_id", "family_id")
    return users.join(stage.families, "family_id").select(
        "user_id", "family_id", "internet_product_group", "internet_contract_months",
        "bundle_discount_method", "internet_benefit_discount_id",
    )


def family_mobile_total(stage: Tables) -> DataFrame:
    """Mobile fee total of a bundle: all lines, or base and low lines of a premium bundle."""
    fees = _with_plan(stage.users, stage.plans, "monthly_fee").select("user_id", "monthly_fee")
    families = stage.families.select("family_id", "bundle_type")
    lines = stage.bundle_discount_compositions.where(F.col("component_type") == "MOBILE").select(
        "family_id", "user_id", "component_role"
    )
    counted = (F.col("bundle_type") == "INTERNET_MOBILE") | F.col("component_role").isin(
        "BASE_MOBILE", "LOW_MOBILE"
    )
    return (
        lines.join(fees, "user_id")
        .join(families, "family_id")
        .where(counted)
        .groupBy("family_id")
        .agg(F.sum("monthly_fee").alias("mobile_total_fee"))
    )


def daily_usage(stage: Tables) -> DataFrame:
    return stage.content_usage.groupBy("user_id", "usage_date").agg(
        F.sum("data_usage_mb").alias("daily_data_mb")
    )


def observed_usage(stage: Tables) -> DataFrame:
    return stage.content_usage.groupBy("user_id").agg(
        mb_to_gb(F.sum("data_usage_mb").cast(EXACT_MB)).alias("observed_data_gb")
    )


def offered_services(stage: Tables) -> DataFrame:
    """Services a customer may choose on the current plan and whether they did."""
    offers = stage.plan_benefits.where(F.col("is_selectable")).select(
        F.col("plan_id").alias("current_plan_id"), "service_id"
    )
    names = stage.additional_services.select(
        "service_id", F.col("service_name").alias("available_service")
    )
    chosen = stage.user_services.select("user_id", "service_id", F.lit(True).alias("_chosen"))
    return (
        _with_plan(stage.users, stage.plans, "plan_name")
        .join(offers.join(names, "service_id"), "current_plan_id")
        .join(chosen, ["user_id", "service_id"], "left")
        .select(
            "user_id", "plan_name", "available_service",
            F.coalesce("_chosen", F.lit(False)).alias("is_selected"),
        )
    )


def quota_utilization(stage: Tables) -> DataFrame:
    """Monthly usage against the base allowance; null for unlimited plans."""
    daily = daily_usage(stage)
    monthly = daily.groupBy("user_id", month_start(F.col("usage_date")).alias("usage_month")).agg(
        mb_to_gb(F.sum("daily_data_mb").cast(EXACT_MB)).alias("monthly_usage_gb"),
        F.count("*").alias("observed_days"),
    )
    users = _with_plan(stage.users, stage.plans, "data_limit_gb", "is_unlimited").select(
        "user_id", "data_limit_gb", "is_unlimited"
    )
    limit = F.col("data_limit_gb").cast("double")
    used = F.when(
        ~F.col("is_unlimited") & (F.col("data_limit_gb") > 0), F.col("monthly_usage_gb") / limit
    )
    return monthly.join(users, "user_id").select(
        "user_id", "usage_month", "monthly_usage_gb", "observed_days", "data_limit_gb",
        used.alias("quota_utilization"),
    )


def service_usage(stage: Tables) -> DataFrame:
    """Usage per customer of the content that belongs to a service."""
    mapped = stage.content_usage.withColumn(
        "mapped_service_id", service_of_detail(F.col("content_detail"))
    ).where(F.col("mapped_service_id").isNotNull())
    summed = mapped.groupBy("user_id", "mapped_service_id").agg(
        F.sum("data_usage_mb").alias("service_usage_mb")
    )
    names = stage.additional_services.select(
        F.col("service_id").alias("mapped_service_id"), "service_name"
    )
    return summed.join(names, "mapped_service_id").select(
        "user_id", "mapped_service_id", "service_name", "service_usage_mb"
    )


def chosen_service_usage(
    stage: Tables, mapping: Sequence[tuple[str, str]] = SERVICE_DETAILS
) -> DataFrame:
    """Chosen services with the usage of each mapped detail, one row without usage if there is none."""
    pairs = literal_frame(
        stage.users.sparkSession, mapping, "service_id string, content_detail string"
    )
    usage = (
        stage.content_usage.where(F.col("content_detail").isin(*[d for _, d in mapping]))
        .groupBy("user_id", "content_detail")
        .agg(F.sum("data_usage_mb").alias("usage_mb"))
        .join(F.broadcast(pairs), "content_detail")
    )
    names = stage.additional_services.select("service_id", "service_name")
    chosen = stage.user_services.select("user_id", "service_id").join(names, "service_id")
    return chosen.join(usage, ["user_id", "service_id"], "left").select(
        "user_id", "service_id", "service_name", "content_detail", "usage_mb"
    )
