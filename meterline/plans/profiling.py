"""Distributions of the source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.fixed_values import CHOICE_FAMILIES, HIGH_PLAN_FEE
from meterline.functions.measures import EXACT_MB, decade, mb_to_gb, ratio, share_pct
from meterline.operators import selection
from meterline.operators.relations import crosstab, value_distribution
from meterline.plans.discount_policy import family_fees
from meterline.plans.features import usage_features
from meterline.plans.quality import union_rules
from meterline.plans.recipes import daily_usage
from meterline.plans.tables import Tables

QUANTILES = [0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99]


def numeric_distribution(df: DataFrame, column: str, value: Column | None = None) -> DataFrame:
    """Count, mean, deviation, range and interpolated quantiles of one decimal measure.

    The quantiles are exact: every rank they interpolate between is located through value counts, so
    the column is never gathered in one task.
    """
    measure = (F.col(column) if value is None else value).cast("decimal(22,3)")
    values = df.select(F.lit(column).alias("column_name"), measure.alias("v")).where(
        F.col("v").isNotNull()
    )
    counts = selection.value_counts(values, "column_name", "v")
    bins = selection.ranked_bins(counts, "column_name")

    def position(q: float) -> Column:
        return (F.col("customers") - 1).cast("decimal(18,0)") * F.lit(q).cast("decimal(3,2)")

    ends = []
    for q in QUANTILES:
        base = F.floor(position(q)) + 1
        ends.append(selection.wanted(f"low{q}", base))
        ends.append(selection.wanted(f"high{q}", F.least(base + 1, F.col("customers"))))
    found = selection.values_at_ranks(counts, bins, "column_name", ends)

    def at(target: str) -> Column:
        return F.max(F.when(F.col("target") == target, F.col("value")))

    picked = found.groupBy("column_name").agg(
        F.max("customers").alias("customers"),
        *[at(f"{end}{q}").alias(f"{end}_{round(q * 100)}") for q in QUANTILES for end in ("low", "high")],
    )
    named = []
    for q in QUANTILES:
        low, high = F.col(f"low_{round(q * 100)}"), F.col(f"high_{round(q * 100)}")
        part = position(q) - F.floor(position(q))
        named.append(F.round(low + (high - low) * part, 2).alias(f"p{round(q * 100):02d}"))
    wide = picked.select("column_name", *named)
    shape = values.groupBy("column_name").agg(
        F.count("*").alias("row_count"),
        F.round(F.sum("v").cast(EXACT_MB) / F.count("*").cast("decimal(12,0)"), 2).alias("mean"),
        F.round(F.stddev_samp(F.col("v").cast("double")), 2).alias("std"),
        F.round(F.min("v"), 2).alias("min"),
        F.round(F.max("v"), 2).alias("max"),
    )
    return shape.join(wide, "column_name")


def value_distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return union_rules(*[value_distribution(df, column) for column in columns])


def user_plan_distribution(stage: Tables) -> DataFrame:
    """Users by gender, plan, plan family, network, choice plan and ten-year age group."""
    plans = stage.plans.select(
        F.col("plan_id").alias("current_plan_id"), "plan_name", "plan_family", "network_type"
    )
    users = stage.users.join(plans, "current_plan_id", "left").select(
        "gender", "plan_name", "plan_family", "network_type",
        F.col("plan_family").isin(*CHOICE_FAMILIES).alias("is_choice"),
        decade(F.col("age")).alias("age_group"),
    )
    return value_distributions(users, users.columns)


def content_distribution(usage: DataFrame, *keys: str) -> DataFrame:
    """Rows, GB, share, mean and exact median per category or detail."""
    group = "content_group"
    rows = usage.select(
        F.concat_ws("/", *keys).alias(group), F.col("data_usage_mb").cast("decimal(22,3)").alias("mb")
    )
    counts = selection.value_counts(rows, group, "mb")
    middle = selection.medians(counts, selection.ranked_bins(counts, group), group)
    whole = usage.agg(F.sum("data_usage_mb").cast("decimal(24,3)")).scalar()
    return middle.select(
        group,
        F.col("customers").alias("row_count"),
        mb_to_gb(F.col("total_mb"), 2).alias("total_gb"),
        share_pct(F.col("total_mb"), whole).alias("share_pct"),
        F.round(F.col("total_mb") / F.col("customers").cast("decimal(12,0)"), 2).alias("mean_mb"),
        F.round("median", 2).alias("median_mb"),
    )


def monthly_equivalent(stage: Tables) -> DataFrame:
    """30-day equivalent GB per user: mean daily MB x 30 / 1024."""
    total = F.sum("daily_data_mb").cast(EXACT_MB) * F.lit(30).cast("decimal(2,0)")
    days = F.count("*").cast("decimal(9,0)") * F.lit(1024).cast("decimal(4,0)")
    return daily_usage(stage).groupBy("user_id").agg(
        F.round(total.cast("decimal(28,3)") / days.cast("decimal(13,0)"), 3).alias("monthly_gb")
    )


def services_per_user(stage: Tables) -> DataFrame:
    """Users of each chosen service by benefit type."""
    pairs = stage.user_services.select("benefit_type", "service_id", "user_id").distinct()
    counted = pairs.groupBy("benefit_type", "service_id").agg(F.count("*").alias("user_count"))
    names = stage.additional_services.select("service_id", "service_name")
    return counted.join(names, "service_id").select("benefit_type", "service_name", "user_count")


def discounts_per_user(stage: Tables) -> DataFrame:
    """How many users hold how many entitlement rows."""
    rows = stage.user_discounts.groupBy("user_id").agg(F.count("*").alias("discount_rows"))
    return rows.groupBy("discount_rows").agg(F.count("*").alias("user_count"))


def users_per_discount(stage: Tables) -> DataFrame:
    pairs = stage.user_discounts.select("discount_id", "user_id").distinct()
    return pairs.groupBy("discount_id").agg(F.count("*").alias("user_count"))


def entitlement_coverage(stage: Tables) -> DataFrame:
    """Users with an entitlement, all users, and youth entitlements."""
    holders = stage.user_discounts.select("user_id").distinct().agg(F.count("*")).scalar()
    youth = stage.user_discounts.where(F.col("discount_id") == "D004").agg(F.count("*")).scalar()
    return stage.users.agg(F.count("*").alias("users")).select(
        holders.alias("users_with_discount"), "users", youth.alias("youth_entitlements")
    )


def _user_figures(stage: Tables) -> DataFrame:
    plans = stage.plans.select(F.col("plan_id").alias("current_plan_id"), "plan_name")
    usage = usage_features(stage).select("user_id", "monthly_estimated_data_gb")
    return (
        stage.users.select(
            "user_id", "current_plan_id", "family_id", "gender", decade(F.col("age")).alias("age_group")
        )
        .join(plans, "current_plan_id")
        .join(usage, "user_id", "left")
        .join(family_fees(stage), "user_id")
    )


def group_means(stage: Tables, group: str) -> DataFrame:
    """Mean monthly GB of the users of a group that have usage, and share on a high fee."""
    high = F.count_if(F.col("monthly_fee") >= HIGH_PLAN_FEE).cast("decimal(18,0)")
    gb = F.col("monthly_estimated_data_gb")
    mean = ratio(F.sum(gb).cast("decimal(24,2)"), F.count(gb).cast("decimal(10,0)"))
    return _user_figures(stage).groupBy(F.col(group).alias("group_value")).agg(
        F.count("*").alias("user_count"),
        F.round(mean, 1).alias("mean_monthly_gb"),
        F.round(
            high * F.lit(100).cast("decimal(3,0)") / F.count("*").cast("decimal(12,0)"), 1
        ).alias("high_fee_pct"),
    )


def family_summary(stage: Tables) -> DataFrame:
    """Share of users with a family, family counts and share of enrolled families."""
    users = stage.users.agg(
        F.count("*").alias("users"), F.count("family_id").alias("family_users")
    )
    families = stage.families.agg(F.count("*")).scalar()
    enrolled = stage.families.agg(F.count_if(F.col("has_bundle"))).scalar()
    return users.select(
        "users",
        "family_users",
        share_pct(F.col("family_users"), F.col("users"), 1).alias("family_user_pct"),
        families.alias("families"),
        share_pct(enrolled, families, 1).alias("enrolled_pct"),
    )


def family_sizes(stage: Tables) -> DataFrame:
    sizes = (
        stage.users.where(F.col("family_id").isNotNull())
        .groupBy("family_id")
        .agg(F.count("*").alias("members"))
    )
    return sizes.groupBy("members").agg(F.count("*").alias("family_count"))


def age_by_plan_family(stage: Tables, families: Sequence[str]) -> DataFrame:
    """Users by ten-year age group, one column per plan family."""
    plans = stage.plans.select(F.col("plan_id").alias("current_plan_id"), "plan_family")
    users = stage.users.join(plans, "current_plan_id").select(
        decade(F.col("age")).alias("age_group"), "plan_family"
    )
    return crosstab(users, "age_group", "plan_family", families)


def category_columns(usage: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Usage of every user with one column per category."""
    return (
        usage.groupBy("user_id")
        .pivot("content_category", list(categories))
        .agg(F.sum("data_usage_mb"))
        .na.fill(0)
    )
