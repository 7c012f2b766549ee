"""Detail layer of the two areas.

The operations area drops names, bands ages, replaces customer ids by pseudonyms and sums usage to the
category. The personalization area keeps ids, names and detail. Both keep only usage from the
subscription start up to the day before the reference date.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.keys import analysis_key
from meterline.functions.measures import CUSTOMER_MB, age_band
from meterline.operators.relations import eligible_usage
from meterline.plans.tables import Tables
from meterline.schemas import PUBLIC_MASTERS, SOURCE_SCHEMAS

PREMIUM_AGES = ["enrollment_min_age", "enrollment_max_age", "benefit_end_age"]


def with_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return df.select(F.lit(batch_id).alias("source_batch_id"), *df.columns)


def public_master(stage: Tables, name: str, batch_id: str) -> DataFrame:
    """Copy of a master table; checked premium ages become integers."""
    table = stage[name]
    if name == "premium_family_discount_rules":
        table = table.withColumns({age: F.col(age).cast("int") for age in PREMIUM_AGES})
    return with_batch(table, batch_id)


def _masters(stage: Tables, batch_id: str) -> dict:
    return {name: partial(public_master, stage, name, batch_id) for name in PUBLIC_MASTERS}


def operations_warehouse(
    stage: Tables, *, secret: str, reference_date: str | None, batch_id: str
) -> Tables:
    """Pseudonymous detail layer. Without a reference date only the subscription start bounds usage."""

    def key(domain: str, column: str) -> Column:
        return analysis_key(domain, F.col(column), secret)

    user_key = key("user", "user_id").alias("analysis_user_key")
    family_key = key("family", "family_id").alias("analysis_family_key")
    bundle_key = key("bundle_composition", "bundle_composition_id").alias(
        "analysis_bundle_composition_key"
    )

    def families() -> DataFrame:
        attributes = [c for c in SOURCE_SCHEMAS["families"].names if c != "family_id"]
        return with_batch(stage.families.select(family_key, *attributes), batch_id)

    def users() -> DataFrame:
        return with_batch(
            stage.users.select(
                user_key,
                age_band(F.col("age")).alias("age_band"),
                "gender",
                "subscription_start_date",
                "current_plan_id",
                family_key,
            ),
            batch_id,
        )

    def compositions() -> DataFrame:
        return with_batch(
            stage.bundle_discount_compositions.select(
                bundle_key, family_key, "component_type", user_key, "component_role", "status",
                "start_date", "end_date",
            ),
            batch_id,
        )

    def user_discounts() -> DataFrame:
        own_key = key("user_discount", "user_discount_id").alias("analysis_user_discount_key")
        return with_batch(
            stage.user_discounts.select(
                own_key, user_key, bundle_key, "discount_id", "status", "start_date", "end_date"
            ),
            batch_id,
        )

    def user_services() -> DataFrame:
        own_key = key("user_service", "user_service_id").alias("analysis_user_service_key")
        return with_batch(
            stage.user_services.select(
                own_key, user_key, "service_id", "benefit_type", "start_date"
            ),
            batch_id,
        )

    def content_usage() -> DataFrame:
        # Usage is dealt by customer once, for the sums and for the join, which bounds what one customer brings
        # into it to days x categories. The pseudonym is derived once per customer instead of once per usage row.
        usage = stage.content_usage
        if reference_date is not None:
            usage = usage.where(F.col("usage_date") < F.lit(reference_date).cast("date"))
        summed = usage.repartition("user_id").groupBy("user_id", "usage_date", "content_category").agg(
            F.sum("data_usage_mb").cast(CUSTOMER_MB).alias("data_usage_mb")
        )
        owners = stage.users.select("user_id", "subscription_start_date", user_key)
        return with_batch(
            eligible_usage(summed, owners).select(
                "analysis_user_key", "usage_date", "content_category", "data_usage_mb"
            ),
            batch_id,
        )

    return Tables(
        **_masters(stage, batch_id),
        families=families,
        users=users,
        bundle_discount_compositions=compositions,
        user_discounts=user_discounts,
        user_services=user_services,
        content_usage=content_usage,
    )


def personalization_warehouse(
    stage: Tables, *, reference_date: str | None, batch_id: str
) -> Tables:
    """Named detail layer with all keys and content detail."""

    def content_usage() -> DataFrame:
        starts = stage.users.select("user_id", "subscription_start_date")
        usage = eligible_usage(stage.content_usage, starts, reference_date)
        return with_batch(usage.select(*SOURCE_SCHEMAS["content_usage"].names), batch_id)

    named = [
        "families", "users", "bundle_discount_compositions", "user_discounts", "user_services",
    ]
    return Tables(
        **_masters(stage, batch_id),
        **{name: (lambda name=name: with_batch(stage[name], batch_id)) for name in named},
        content_usage=content_usage,
    )
