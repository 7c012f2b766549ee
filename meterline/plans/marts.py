"""Star schemas of the two areas, on natural keys with integer day and month keys.

Coarser facts are built from finer ones that already hold one row per customer, so user counts are
plain row counts and the detail layer is scanned as rarely as possible. Month-level counts are never
added up from days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.fixed_values import AGE_BANDS, SERVICE_DETAILS
from meterline.functions.calendar import calendar_columns, date_key, month_key, month_start
from meterline.functions.measures import CUSTOMER_MB, EXACT_MB, SEGMENT_MB, active_on
from meterline.operators import selection
from meterline.operators.frames import day_frame, literal_frame
from meterline.plans.tables import Tables

#: Prefix of a fact's stored form, and its column that counts what is behind each row: a row whose counter is 0 has ended.
COUNTED, COUNTER = "counted.", "_rows"


def day(value: str) -> Column:
    return F.lit(value).cast("date")


def dim_age_band(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, AGE_BANDS, "age_band_key int, age_band string, min_age int, max_age int"
    )


def dim_date(usage: DataFrame) -> DataFrame:
    """Every day from the first of the first usage month to the last usage day; empty without usage."""
    bounds = usage.agg(F.min("usage_date").alias("first"), F.max("usage_date").alias("last"))
    days = day_frame(bounds, month_start(F.col("first")), F.col("last"))
    return days.select(*calendar_columns(F.col("calendar_date")))


def _dim_plan(plans: DataFrame, *extra: str) -> DataFrame:
    return plans.select(
        "plan_id", "plan_name", "plan_family", "plan_category", "monthly_fee", "data_limit_gb",
        "is_unlimited", *extra,
    )


def _dim_family(families: DataFrame, key: str) -> DataFrame:
    return families.select(
        key, "has_bundle", "bundle_type", "has_home_internet", "internet_product_group",
        "internet_status",
    )


def segment(customer_usage: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """Usage by plan, age band and category from rows that are unique per customer and key."""
    attributes = customers.select("analysis_user_key", "plan_id", "age_band")
    totals = (
        customer_usage.join(attributes, "analysis_user_key")
        .groupBy(key, "plan_id", "age_band", "content_category")
        .agg(F.sum("usage_mb").cast(EXACT_MB).alias("total"), F.count("*").alias("users"))
    )
    return averaged_segment(totals, key)


def current_services(user_services: DataFrame, customer: str, reference_date: str) -> DataFrame:
    return user_services.where(F.col("start_date") <= day(reference_date)).select(
        customer, "service_id", "benefit_type", "start_date"
    )


def current_discounts(user_discounts: DataFrame, customer: str, reference_date: str) -> DataFrame:
    """Latest entitlement in force per customer and discount; only its start is carried."""
    return (
        user_discounts.where(active_on(day(reference_date)))
        .groupBy(customer, "discount_id")
        .agg(F.max("start_date").alias("start_date"))
    )


def operations_mart(dw: Tables, *, reference_date: str) -> Tables:
    spark = dw.users.sparkSession

    def dim_customer() -> DataFrame:
        families = dw.families.select("analysis_family_key")
        return dw.users.select(
            "analysis_user_key", F.col("current_plan_id").alias("plan_id"), "age_band", "gender",
            "subscription_start_date", "analysis_family_key",
        ).join(
            families.withColumn("_known", F.lit(True)), "analysis_family_key", "left"
        ).select(
            "analysis_user_key", "plan_id", "age_band", "gender", "subscription_start_date",
            F.when(F.col("_known"), F.col("analysis_family_key")).alias("analysis_family_key"),
        )

    def daily_segment() -> DataFrame:
        usage = dw.content_usage.select(
            date_key(F.col("usage_date")).alias("date_key"), "analysis_user_key",
            "content_category", F.col("data_usage_mb").alias("usage_mb"),
        )
        return segment(usage, mart.dim_customer, "date_key")

    def customer_daily() -> DataFrame:
        return dw.content_usage.groupBy(
            "analysis_user_key", date_key(F.col("usage_date")).alias("date_key")
        ).agg(F.sum("data_usage_mb").cast(CUSTOMER_MB).alias("total_usage_mb"))

    def customer_monthly_category() -> DataFrame:
        return dw.content_usage.groupBy(
            "analysis_user_key", month_key(F.col("usage_date")).alias("month_key"),
            "content_category",
        ).agg(F.sum("data_usage_mb").cast(CUSTOMER_MB).alias("total_usage_mb"), F.count("*").alias(COUNTER))

    def monthly_segment() -> DataFrame:
        usage = mart.customer_monthly_category_usage.withColumnRenamed("total_usage_mb", "usage_mb")
        return segment(usage, mart.dim_customer, "month_key")

    def customer_month_totals() -> DataFrame:
        return month_totals(mart.customer_monthly_category_usage)

    def subscribers() -> DataFrame:
        return mart.dim_customer.where(
            F.col("subscription_start_date") <= day(reference_date)
        ).select(day(reference_date).alias("as_of_date"), "analysis_user_key")

    def family_current() -> DataFrame:
        members = (
            mart.dim_customer.where(F.col("analysis_family_key").isNotNull())
            .groupBy("analysis_family_key")
            .agg(F.count("*").cast("int").alias("member_count"))
        )
        return mart.dim_family.join(members, "analysis_family_key", "left").select(
            "analysis_family_key",
            F.coalesce("member_count", F.lit(0)).alias("member_count"),
            "has_bundle",
            "has_home_internet",
        )

    mart = Tables(
        dim_age_band=lambda: dim_age_band(spark),
        dim_date=lambda: dim_date(dw.content_usage),
        dim_plan=lambda: _dim_plan(dw.plans),
        dim_content_category=lambda: dw.content_usage.select("content_category").distinct(),
        dim_service=lambda: dw.additional_services.drop("source_batch_id"),
        dim_discount=lambda: dw.discounts.drop("source_batch_id"),
        dim_family=lambda: _dim_family(dw.families, "analysis_family_key"),
        dim_customer=dim_customer,
        daily_usage_segment=daily_segment,
        monthly_usage_segment=monthly_segment,
        customer_daily_usage=customer_daily,
        **counted_fact("customer_monthly_category_usage", customer_monthly_category, lambda: mart),
        customer_month_totals=customer_month_totals,
        month_usage_bins=lambda: month_bins(mart.customer_month_totals),
        subscriber_current=subscribers,
        family_current=family_current,
        customer_service_current=lambda: current_services(
            dw.user_services, "analysis_user_key", reference_date
        ),
        customer_discount_current=lambda: current_discounts(
            dw.user_discounts, "analysis_user_key", reference_date
        ),
    )
    return mart


def month_totals(category_months: DataFrame) -> DataFrame:
    """Usage of each customer and month, and the bin of the order statistics that it lies in."""
    totals = category_months.groupBy("month_key", "analysis_user_key").agg(F.sum("total_usage_mb").cast(EXACT_MB).alias("total_usage_mb"))
    return totals.withColumn("bin", selection.bin_of(F.col("total_usage_mb")))


def month_bins(totals: DataFrame) -> DataFrame:
    """Customers and usage of each bin of a month: what medians and top shares are located by."""
    counts = totals.select("month_key", F.col("total_usage_mb").alias("value"), F.lit(1).cast("bigint").alias("n"), "bin")
    return selection.summed_bins(counts, "month_key")


def counted_fact(name: str, build, mart) -> dict:
    """Entries of a monthly fact: with the number of days or detail rows behind each row, as loads need it, and without."""
    counted = COUNTED + name
    return {counted: build, name: lambda: mart()[counted].drop(COUNTER)}


def averaged_month(totals: DataFrame) -> DataFrame:
    """Customer months from `total` and the number of days."""
    return totals.select(
        "user_id", "month_key", F.col("total").cast(CUSTOMER_MB).alias("total_usage_mb"),
        (F.col("total") / F.col(COUNTER).cast("decimal(10,0)")).cast(CUSTOMER_MB).alias("average_daily_usage_mb"), COUNTER,
    )


def averaged_segment(totals: DataFrame, key: str) -> DataFrame:
    """Segments from `total` and `users`."""
    average = F.col("total") / F.nullif(F.col("users"), F.lit(0)).cast("decimal(10,0)")
    return totals.select(
        key, "plan_id", "age_band", "content_category", F.col("total").cast(SEGMENT_MB).alias("total_usage_mb"),
        F.col("users").cast("int").alias("usage_user_count"), average.cast(SEGMENT_MB).alias("average_usage_mb"),
    )


def month_to_date(daily: DataFrame) -> DataFrame:
    """Running usage of each customer within a month; a window holds at most 31 rows."""
    running = (
        W.partitionBy("user_id", month_start(F.col("usage_date")))
        .orderBy("usage_date")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return daily.withColumn("month_to_date_usage_mb", F.sum("total_usage_mb").over(running))


def personalization_mart(
    dw: Tables, *, reference_date: str, service_details: Sequence[tuple[str, str]] = SERVICE_DETAILS
) -> Tables:
    spark = dw.users.sparkSession

    def dim_customer() -> DataFrame:
        families = dw.families.select("family_id", F.lit(True).alias("_known"))
        return dw.users.join(families, "family_id", "left").select(
            "user_id", "name", F.col("current_plan_id").alias("plan_id"), "age", "gender",
            "subscription_start_date",
            F.when(F.col("_known"), F.col("family_id")).alias("family_id"),
        )

    def bridge() -> DataFrame:
        pairs = literal_frame(spark, service_details, "service_id string, content_detail string")
        return (
            mart.dim_content.join(F.broadcast(pairs), "content_detail")
            .join(mart.dim_service.select("service_id"), "service_id")
            .select("service_id", "content_category", "content_detail")
        )

    def customer_daily() -> DataFrame:
        daily = dw.content_usage.groupBy("user_id", "usage_date").agg(
            F.sum("data_usage_mb").cast(CUSTOMER_MB).alias("total_usage_mb")
        )
        return month_to_date(daily).select(
            "user_id",
            date_key(F.col("usage_date")).alias("date_key"),
            "total_usage_mb",
            F.col("month_to_date_usage_mb").cast(CUSTOMER_MB).alias("month_to_date_usage_mb"),
        )

    def customer_monthly() -> DataFrame:
        # One row per day already: the number of days is a row count.
        month = (F.floor(F.col("date_key") / 100) * 100 + 1).cast("int")
        return averaged_month(
            mart.customer_daily_usage.groupBy("user_id", month.alias("month_key")).agg(
                F.sum("total_usage_mb").cast(EXACT_MB).alias("total"), F.count("*").alias(COUNTER)
            )
        )

    def customer_monthly_content() -> DataFrame:
        return dw.content_usage.groupBy(
            "user_id", month_key(F.col("usage_date")).alias("month_key"), "content_category",
            "content_detail",
        ).agg(F.sum("data_usage_mb").cast(CUSTOMER_MB).alias("total_usage_mb"), F.count("*").alias(COUNTER))

    def content_daily() -> DataFrame:
        # The detail rows are not copied: this is a projection of the warehouse table.
        return dw.content_usage.select(
            "user_id", date_key(F.col("usage_date")).alias("date_key"), "content_category",
            "content_detail", "data_usage_mb",
        )

    mart = Tables(
        dim_date=lambda: dim_date(dw.content_usage),
        dim_plan=lambda: _dim_plan(dw.plans, "choice_tier", "network_type"),
        dim_content=lambda: dw.content_usage.select(
            "content_category", "content_detail"
        ).distinct(),
        dim_service=lambda: dw.additional_services.drop("source_batch_id"),
        dim_discount=lambda: dw.discounts.drop("source_batch_id"),
        dim_family=lambda: _dim_family(dw.families, "family_id"),
        dim_customer=dim_customer,
        bridge_service_content=bridge,
        customer_daily_usage=customer_daily,
        **counted_fact("customer_monthly_usage", customer_monthly, lambda: mart),
        **counted_fact("customer_monthly_content_usage", customer_monthly_content, lambda: mart),
        customer_content_daily_usage=content_daily,
        customer_service_current=lambda: current_services(
            dw.user_services, "user_id", reference_date
        ),
        customer_discount_current=lambda: current_discounts(
            dw.user_discounts, "user_id", reference_date
        ),
        customer_family_current=lambda: mart.dim_customer.where(
            F.col("family_id").isNotNull()
        ).select("user_id", "family_id"),
    )
    return mart
