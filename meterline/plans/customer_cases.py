"""Customer selection: who fits an advisory case. `top=None` returns every match."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import fixed_values as fixed
from meterline.functions.measures import EXACT_MB, in_force, mb_to_gb
from meterline.operators.lookup import matching_rules, with_rules
from meterline.plans.area import Area
from meterline.plans.marts import day

WINDOW_DAYS = 30


def _top(df: DataFrame, top: int | None) -> DataFrame:
    return df if top is None else df.limit(top)


def _gb(value) -> Column:
    """A GB threshold in MB."""
    return F.lit(Decimal(str(value)) * 1024).cast("decimal(20,4)")


def _windowed(area: Area) -> tuple[Column, Area]:
    latest = area.latest_day()
    return latest, area.during_days(F.date_sub(latest, WINDOW_DAYS - 1), latest)


def _window_usage(area: Area, min_observed_days: int) -> DataFrame:
    """Usage per customer in the window, for customers seen on enough days."""
    return (
        area.mart.customer_daily_usage.groupBy("user_id")
        .agg(F.sum("total_usage_mb").cast(EXACT_MB).alias("usage_mb"), F.count("*").alias("days"))
        .where(F.col("days") >= min_observed_days)
        .drop("days")
    )


def video_benefit_mismatch(
    area: Area,
    *,
    min_gb=20,
    min_share="0.30",
    min_observed_days: int = WINDOW_DAYS,
    service_id: str = fixed.VIDEO_BRAND_SERVICE,
    details: Sequence[str] = tuple(fixed.VIDEO_BRAND_DETAILS),
    unlimited_outside_choice: tuple | None = None,
    top: int | None = 10,
) -> DataFrame:
    """Heavy use of one brand's content without its service being chosen.

    `unlimited_outside_choice=(from_fee, below_fee)` narrows to unlimited plans outside the choice
    families in that price range that do not offer the service.
    """
    latest, recent = _windowed(area)
    brand = F.sum(F.when(F.col("content_detail").isin(*details), F.col("data_usage_mb")))
    per_day = recent.mart.customer_content_daily_usage.groupBy("user_id", "date_key").agg(
        F.sum("data_usage_mb").alias("day_mb"), brand.alias("day_brand_mb")
    )
    usage = (
        per_day.groupBy("user_id")
        .agg(
            F.sum("day_mb").cast(EXACT_MB).alias("usage_mb"),
            F.coalesce(F.sum("day_brand_mb"), F.lit(0)).cast(EXACT_MB).alias("brand_mb"),
            F.count("*").alias("days"),
        )
        .where(F.col("days") >= min_observed_days)
    )
    services = area.views.v_customer_service_current.groupBy("user_id").agg(
        F.expr("listagg(distinct service_name, ', ') within group (order by service_name)").alias(
            "chosen"
        ),
        F.bool_or(F.col("service_id") == service_id).alias("has_service"),
    )
    offering = (
        area.dw.plan_benefits.where(F.col("service_id") == service_id)
        .select("plan_id", F.lit(True).alias("offers"))
        .distinct()
    )
    outside_choice = F.col("is_unlimited") & ~F.col("plan_family").isin(*fixed.CHOICE_FAMILIES)
    share = F.lit(min_share).cast("decimal(5,4)")
    matches = (
        area.views.v_customer_current_plan.join(
            usage.where(
                (F.col("brand_mb") >= _gb(min_gb))
                & (F.col("usage_mb") > 0)
                & (F.col("brand_mb") >= F.col("usage_mb") * share)
            ),
            "user_id",
        )
        .join(services, "user_id", "left")
        .where(~F.coalesce("has_service", F.lit(False)))
        .join(offering, "plan_id", "left")
    )
    if unlimited_outside_choice is not None:
        low, high = (F.lit(v).cast("decimal(12,2)") for v in unlimited_outside_choice)
        matches = matches.where(
            outside_choice
            & (F.col("monthly_fee") >= low)
            & (F.col("monthly_fee") < high)
            & F.col("offers").isNull()
        )
    hundredfold = F.col("brand_mb") * F.lit(100).cast("decimal(3,0)")
    ordered = matches.orderBy(F.desc("brand_mb"), "user_id")
    return _top(ordered, top).select(
        "user_id",
        "name",
        "plan_name",
        "monthly_fee",
        "is_unlimited",
        mb_to_gb(F.col("usage_mb"), 2).alias("usage_30d_gb"),
        mb_to_gb(F.col("brand_mb"), 2).alias("brand_30d_gb"),
        F.round(hundredfold / F.col("usage_mb").cast("decimal(24,3)"), 1).alias("brand_share_pct"),
        F.coalesce("chosen", F.lit(fixed.NO_CHOSEN_SERVICE)).alias("current_services"),
        F.when(F.col("offers"), fixed.BENEFIT_NOT_CHOSEN)
        .when(outside_choice, fixed.BENEFIT_OUTSIDE_CHOICE)
        .otherwise(fixed.BENEFIT_ABSENT)
        .alias("case_detail"),
        latest.alias("usage_end_date"),
    )


def high_usage_low_fee(
    area: Area,
    *,
    min_gb=80,
    max_fee=61000,
    max_limit_gb=30,
    min_observed_days: int = WINDOW_DAYS,
    top: int | None = 10,
) -> DataFrame:
    latest, recent = _windowed(area)
    usage = _window_usage(recent, min_observed_days).where(F.col("usage_mb") >= _gb(min_gb))
    plans = area.views.v_customer_current_plan.where(
        (F.col("monthly_fee") <= max_fee)
        & ~F.col("is_unlimited")
        & (F.col("data_limit_gb") <= max_limit_gb)
    )
    ordered = plans.join(usage, "user_id").orderBy(F.desc("usage_mb"), "monthly_fee", "user_id")
    return _top(ordered, top).select(
        "user_id", "name", "plan_name", "monthly_fee",
        F.col("data_limit_gb").alias("base_data_limit_gb"),
        mb_to_gb(F.col("usage_mb"), 2).alias("usage_30d_gb"),
        latest.alias("usage_end_date"),
    )


def low_usage_high_fee(
    area: Area,
    *,
    below_gb=15,
    min_fee=fixed.HIGH_PLAN_FEE,
    min_observed_days: int = WINDOW_DAYS,
    top: int | None = 10,
) -> DataFrame:
    latest, recent = _windowed(area)
    usage = _window_usage(recent, min_observed_days).where(F.col("usage_mb") < _gb(below_gb))
    plans = area.views.v_customer_current_plan.where(F.col("monthly_fee") >= min_fee)
    ordered = plans.join(usage, "user_id").orderBy(F.desc("monthly_fee"), "usage_mb", "user_id")
    return _top(ordered, top).select(
        "user_id", "name", "plan_name", "monthly_fee", "is_unlimited",
        mb_to_gb(F.col("usage_mb"), 2).alias("usage_30d_gb"),
        latest.alias("usage_end_date"),
    )


def _bundle_members(area: Area) -> DataFrame:
    """Family members whose plan may join a family bundle."""
    plans = area.dw.plans.where(F.col("family_bundle_eligible")).select(
        F.col("plan_id").alias("current_plan_id"), "plan_name", "plan_family", "monthly_fee"
    )
    users = area.dw.users.where(F.col("family_id").isNotNull()).select(
        "user_id", "name", "age", "subscription_start_date", "family_id", "current_plan_id"
    )
    return users.join(plans, "current_plan_id")


def _unbundled_families(area: Area) -> DataFrame:
    return area.dw.families.where(
        ~F.col("has_bundle")
        & F.col("has_home_internet")
        & (F.col("internet_status") == "ACTIVE")
    )


def premium_family_not_enrolled(
    area: Area, as_of: str, *, top: int | None = 10
) -> DataFrame:
    """Choice customers of an unbundled family that would qualify for the additional-line rate.

    The member who would become the base line is the lowest (fee, oldest, earliest, id) high-fee
    line: a combinable minimum, so no family is ranked in one task.
    """
    rule = area.dw.premium_family_discount_rules.where(
        (F.col("discount_id") == "D003")
        & in_force(day(as_of), "effective_start_date", "effective_end_date")
    )

    def policy(column: str) -> Column:
        return rule.select(column).scalar()

    members = _bundle_members(area)
    high = F.col("monthly_fee") >= policy("minimum_plan_fee")
    order = F.struct(
        "monthly_fee", (-F.col("age")).alias("oldest"), "subscription_start_date", "user_id"
    )
    families = (
        members.groupBy("family_id")
        .agg(
            F.count("*").alias("member_count"),
            F.count_if(high).alias("high_fee_line_count"),
            F.min(F.when(high, order))["user_id"].alias("base_user"),
        )
        .where(
            (F.col("high_fee_line_count") >= policy("minimum_high_line_count"))
            & (F.col("member_count") <= policy("maximum_mobile_line_count"))
        )
        .join(
            _unbundled_families(area)
            .where(F.col("internet_product_group") == fixed.HIGHER_INTERNET_GROUP)
            .select("family_id"),
            "family_id",
        )
    )
    enrolled = area.mart.customer_discount_current.where(F.col("discount_id") == "D003")
    saving = F.round(F.col("monthly_fee") * policy("discount_rate"), 0)
    found = (
        members.where(high & F.col("plan_family").isin(*fixed.CHOICE_FAMILIES))
        .join(families, "family_id")
        .where(F.col("user_id") != F.col("base_user"))
        .join(enrolled.select("user_id"), "user_id", "left_anti")
        .select(
            "user_id", "name", "plan_name", "monthly_fee", "family_id", "member_count",
            "high_fee_line_count",
            saving.alias("potential_premium_discount_per_month"),
            F.lit(fixed.PREMIUM_NOT_ENROLLED).alias("case_detail"),
        )
        .orderBy(F.desc("potential_premium_discount_per_month"), "family_id", "user_id")
    )
    return _top(found, top)


def total_bundle_not_enrolled(area: Area, as_of: str, *, top: int | None = 10) -> DataFrame:
    """Members of unbundled families for which a total-discount rule would pay.

    Rules that overlap would repeat a family and a missing rule drops it, as a plain join does.
    """
    members = _bundle_members(area)
    totals = members.groupBy("family_id").agg(
        F.count("*").alias("member_count"),
        F.sum("monthly_fee").alias("family_total_monthly_fee"),
    )
    rules = area.dw.internet_bundle_discount_rules.where(
        (F.col("discount_target") == "MOBILE_POOL")
        & (F.col("discount_amount") > 0)
        & in_force(day(as_of), "effective_start_date", "effective_end_date")
    )
    discounted = (
        area.views.v_customer_discount_current.where(
            F.col("policy_domain").isin("INTERNET_BUNDLE", "PREMIUM_FAMILY")
        )
        .join(members.select("user_id", "family_id"), "user_id")
        .select("family_id")
    )
    matches = matching_rules(
        "_pool",
        F.col("internet_product_group"),
        F.col("internet_contract_months"),
        mobile_total=F.col("family_total_monthly_fee"),
    )
    open_families = (
        _unbundled_families(area)
        .join(totals.where(F.col("member_count") >= 2), "family_id")
        .join(discounted, "family_id", "left_anti")
    )
    eligible = (
        with_rules(open_families, rules, _pool=("D001", "TOTAL", "MOBILE_TOTAL_POOL"))
        .withColumn("_rule", F.explode(matches))
        .select(
            "family_id", "member_count", "family_total_monthly_fee", "internet_product_group",
            "internet_contract_months",
            F.col("_rule.discount_amount").alias("potential_family_mobile_discount"),
        )
    )
    found = (
        members.select("user_id", "name", "plan_name", "monthly_fee", "family_id")
        .join(eligible, "family_id")
        .select(
            "user_id", "name", "plan_name", "monthly_fee", "family_id", "member_count",
            "family_total_monthly_fee", "internet_product_group", "internet_contract_months",
            "potential_family_mobile_discount",
            F.lit(fixed.TOTAL_NOT_ENROLLED).alias("case_detail"),
        )
        .orderBy(F.desc("potential_family_mobile_discount"), "family_id", "user_id")
    )
    return _top(found, top)


def all_cases(area: Area, as_of: str, **options) -> dict[str, DataFrame]:
    """The five cases over one published state; options are keyed by case."""
    return {
        "video_benefit_mismatch": video_benefit_mismatch(
            area, **options.get("video_benefit_mismatch", {})
        ),
        "high_usage_low_fee": high_usage_low_fee(area, **options.get("high_usage_low_fee", {})),
        "low_usage_high_fee": low_usage_high_fee(area, **options.get("low_usage_high_fee", {})),
        "premium_family_not_enrolled": premium_family_not_enrolled(
            area, as_of, **options.get("premium_family_not_enrolled", {})
        ),
        "total_bundle_not_enrolled": total_bundle_not_enrolled(
            area, as_of, **options.get("total_bundle_not_enrolled", {})
        ),
    }


def case_members(cases: dict[str, DataFrame]) -> DataFrame:
    """(case_name, user_id) over all cases."""
    frames = [
        df.select(F.lit(name).alias("case_name"), "user_id") for name, df in cases.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
