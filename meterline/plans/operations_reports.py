"""Reports of the operations area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.fixed_values import USAGE_BUCKETS
from meterline.functions.calendar import day_of_key, month_key
from meterline.functions.measures import (
    COUNT,
    EXACT_MB,
    age_band_position,
    mb_to_gb,
    ratio,
    share_pct,
)
from meterline.operators import selection
from meterline.operators.frames import fill_grid, month_frame, per_month, with_groups
from meterline.plans.area import Area
from meterline.plans.marts import day

TOP_PERCENTS = [1, 10]


def plan_mix_by_age_band(area: Area, as_of_date: str) -> DataFrame:
    """Subscribers by age band and plan with the share within the band."""
    band = W.partitionBy("age_band")
    return (
        area.views.v_subscriber_current.where(F.col("as_of_date") == day(as_of_date))
        .withColumn(
            "age_band_share_pct",
            share_pct(F.col("subscriber_count"), F.sum("subscriber_count").over(band)),
        )
        .orderBy(
            age_band_position(F.col("age_band")).asc_nulls_last(),
            F.col("subscriber_count").desc_nulls_first(),
            F.col("plan_id").asc_nulls_last(),
        )
        .select(
            "as_of_date", "age_band", "plan_id", "plan_name",
            F.col("subscriber_count").cast("bigint").alias("subscriber_count"),
            "age_band_share_pct",
        )
    )


def _customer_months(area: Area, start: str, end_exclusive: str, preaggregated: bool) -> DataFrame:
    """Monthly usage per customer: from the pre-aggregated view or from the category view."""
    if preaggregated:
        limited = area.during_months(day(start), day(end_exclusive))
        return limited.views.v_customer_monthly_usage_preaggregated
    usage = area.views.v_customer_monthly_category_usage.where(
        (F.col("calendar_month") >= day(start)) & (F.col("calendar_month") < day(end_exclusive))
    )
    return usage.groupBy("calendar_month", "analysis_user_key").agg(
        F.sum("total_usage_mb").cast(EXACT_MB).alias("total_usage_mb")
    )


def _month_statistics(
    area: Area, start: str, end_exclusive: str, preaggregated: bool
) -> tuple[DataFrame, DataFrame, bool]:
    """Values and ranked bins by calendar_month, and whether the bins are read from files of the mart.

    Without files, bins and values are two uses of one shuffle in one query.
    """
    month = "calendar_month"
    if preaggregated and "month_usage_bins" in area.mart:
        key = F.col("month_key")
        chosen = (key >= month_key(day(start))) & (key < month_key(day(end_exclusive)))
        first = day_of_key(key).alias(month)
        bins = area.mart.month_usage_bins.where(chosen).select(first, "bin", "n", "mb")
        totals = area.mart.customer_month_totals.where(chosen)
        values = totals.select(first, F.col("total_usage_mb").alias("value"), F.lit(1).cast("bigint").alias("n"), "bin")
        return values, selection.ranked(bins, month), area.stored
    values = selection.value_counts(_customer_months(area, start, end_exclusive, preaggregated), month, "total_usage_mb")
    return values, selection.ranked_bins(values, month), False


def monthly_usage_statistics(
    area: Area, start: str, end_exclusive: str, preaggregated: bool = True
) -> DataFrame:
    """Customers with usage, mean and exact median GB per month; months without usage are kept."""
    month = "calendar_month"
    values, bins, kept = _month_statistics(area, start, end_exclusive, preaggregated)
    statistics = selection.medians(values, bins, month, kept)
    customers = F.col("customers").cast(COUNT)
    mean = F.col("total_mb") / (customers * F.lit(1024).cast("decimal(4,0)"))
    return (
        fill_grid(month_frame(values.sparkSession, start, end_exclusive), statistics, month)
        .select(
            month,
            F.coalesce("customers", F.lit(0)).alias("recorded_customer_count"),
            F.round(mean, 2).alias("average_monthly_usage_gb"),
            mb_to_gb(F.col("median"), 2).alias("median_monthly_usage_gb"),
        )
        .orderBy(month)
    )


def usage_against_allowance(
    area: Area, start: str, end_exclusive: str, as_of_date: str
) -> DataFrame:
    """Monthly usage per subscriber of a plan against its base allowance."""
    subscribers = (
        area.views.v_subscriber_current.where(F.col("as_of_date") == day(as_of_date))
        .groupBy("plan_id")
        .agg(F.sum("subscriber_count").alias("subscriber_count"))
    )
    usage = (
        area.during_months(day(start), day(end_exclusive))
        .views.v_monthly_usage_segment.groupBy("calendar_month", "plan_id")
        .agg(F.sum("total_usage_mb").cast(EXACT_MB).alias("usage_mb"))
    )
    plans = area.dw.plans.select(
        "plan_id", "plan_name", "monthly_fee", "data_limit_gb", "is_unlimited"
    )
    per_subscriber = ratio(F.col("usage_mb"), F.col("subscriber_count").cast("decimal(12,0)"))
    limit_mb = F.col("data_limit_gb") * F.lit(1024).cast("decimal(4,0)")
    has_limit = ~F.col("is_unlimited") & (F.col("data_limit_gb") > 0)
    used_pct = F.col("usage_mb") * F.lit(100).cast("decimal(3,0)") / (
        F.col("subscriber_count").cast("decimal(12,0)") * limit_mb.cast("decimal(14,2)")
    )
    return (
        per_month(subscribers, start, end_exclusive)
        .join(plans, "plan_id")
        .join(usage, ["calendar_month", "plan_id"], "left")
        .orderBy("calendar_month", "monthly_fee", "plan_id")
        .select(
            "calendar_month",
            day(as_of_date).alias("as_of_date"),
            "plan_id",
            "plan_name",
            "subscriber_count",
            mb_to_gb(F.col("usage_mb"), 2).alias("total_usage_gb"),
            F.round(per_subscriber.cast("decimal(30,10)") / F.lit(1024).cast("decimal(4,0)"), 2)
            .alias("average_usage_per_subscriber_gb"),
            "data_limit_gb",
            "is_unlimited",
            F.when(has_limit, F.round(used_pct, 2)).alias("base_allowance_usage_pct"),
        )
    )


def category_mix(area: Area, start: str, end_exclusive: str) -> DataFrame:
    """Usage by month, plan, age band and category with the share inside the segment."""
    inside = W.partitionBy("calendar_month", "plan_id", "age_band")
    usage = area.during_months(day(start), day(end_exclusive)).views.v_monthly_usage_segment
    return (
        usage.withColumn(
            "category_usage_share_pct",
            share_pct(F.col("total_usage_mb"), F.sum("total_usage_mb").over(inside)),
        )
        .orderBy(
            "calendar_month",
            "plan_id",
            age_band_position(F.col("age_band")).asc_nulls_last(),
            F.col("total_usage_mb").desc_nulls_first(),
            "content_category",
        )
        .select(
            "calendar_month", "plan_id", "plan_name", "age_band", "content_category",
            mb_to_gb(F.col("total_usage_mb")).alias("total_usage_gb"),
            "category_usage_share_pct",
        )
    )


def top_label(percent: int) -> str:
    return f"top_{percent}_pct"


def usage_bucket(gb_bin: Column) -> Column:
    """Label of the distribution bucket that holds a whole-GB bin."""
    label = F.lit(None).cast("string")
    for name, lower, _ in USAGE_BUCKETS:
        label = F.when(gb_bin >= lower, F.lit(name)).otherwise(label)
    return label


def usage_distribution(
    area: Area, start: str, end_exclusive: str, preaggregated: bool = True
) -> DataFrame:
    """Per month: six usage buckets and the share of the top 1 % and 10 % of customers.

    Bucket bounds are whole GB, so the GB bins of the order statistics already separate them.
    """
    month = "calendar_month"
    values, bins, kept = _month_statistics(area, start, end_exclusive, preaggregated)
    buckets = bins.groupBy(month, usage_bucket(F.col("bin")).alias("group_label")).agg(
        F.sum("n").alias("group_customers"),
        F.sum("mb").cast(EXACT_MB).alias("group_mb"),
        F.max("customers").alias("customers"),
        F.max("total_mb").alias("total_mb"),
    )
    labels = {top_label(percent): percent for percent in TOP_PERCENTS}
    top = selection.top_shares(values, bins, month, labels, kept).select(
        month,
        F.col("target").alias("group_label"),
        F.col("top_customers").alias("group_customers"),
        F.col("top_mb").alias("group_mb"),
        "customers",
        "total_mb",
    )
    found = buckets.unionByName(top)
    whole = W.partitionBy(month)
    groups = [
        F.struct(
            F.lit("distribution").alias("result_type"),
            F.lit(label).alias("group_label"),
            F.lit(number).alias("sort_order"),
        )
        for number, (label, _, _) in enumerate(USAGE_BUCKETS, 1)
    ] + [
        F.struct(
            F.lit("concentration").alias("result_type"),
            F.lit(top_label(percent)).alias("group_label"),
            F.lit(100 + percent).alias("sort_order"),
        )
        for percent in TOP_PERCENTS
    ]
    grid = with_groups(month_frame(values.sparkSession, start, end_exclusive), groups)
    customers = F.coalesce("group_customers", F.lit(0))
    mb = F.coalesce("group_mb", F.lit(0).cast(EXACT_MB))
    joined = fill_grid(grid, found, month, "group_label").withColumns(
        {
            "customers": F.max("customers").over(whole),
            "total_mb": F.max("total_mb").over(whole),
        }
    )
    return joined.orderBy(month, "sort_order").select(
        month,
        "result_type",
        "group_label",
        customers.alias("customer_count"),
        share_pct(customers, F.col("customers")).alias("customer_share_pct"),
        mb_to_gb(mb, 2).alias("total_usage_gb"),
        share_pct(mb, F.col("total_mb")).alias("usage_share_pct"),
    )


def bundle_internet_matrix(area: Area) -> DataFrame:
    """Families by bundle and home internet; the four combinations always appear."""
    families = area.views.v_family_current
    flags = [
        F.struct(F.lit(bundle).alias("has_bundle"), F.lit(internet).alias("has_home_internet"))
        for bundle in (False, True)
        for internet in (False, True)
    ]
    grid = with_groups(families.sparkSession.range(0, 1, 1, 1).select(), flags)
    counted = families.groupBy("has_bundle", "has_home_internet").agg(
        F.count("*").alias("family_count")
    )
    total = families.agg(F.count("*")).scalar()
    count = F.coalesce("family_count", F.lit(0))
    return (
        fill_grid(grid, counted, "has_bundle", "has_home_internet")
        .select(
            "has_bundle",
            "has_home_internet",
            count.alias("family_count"),
            share_pct(count, total).alias("family_share_pct"),
        )
        .orderBy("has_bundle", "has_home_internet")
    )


