"""Pseudonymised copy of the source tables with coarsened dates."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import month_cohort, tenure_months
from meterline.functions.keys import analysis_key
from meterline.functions.measures import age_band
from meterline.plans.marts import day
from meterline.plans.tables import Tables
from meterline.sources import paths

#: What happens to each kind of field in a release, in the words that go with it.
TRANSFORMATIONS = {
    "ids": "users, families and bundle compositions carry keyed pseudonyms instead of their ids",
    "dropped": "names, and the ids of usage, discount and service rows",
    "ages": "given as age bands",
    "subscription": "given as month of start and months since then",
    "start_and_end": "of discounts, services and bundle parts given as months",
    "usage": "kept by day",
}


def analysis_release(stage: Tables, *, secret: str, reference_date: str) -> Tables:
    """The 14 tables without names, exact ages, exact lifecycle dates and row ids."""

    def key(domain: str, column: str, name: str) -> Column:
        return analysis_key(domain, F.col(column), secret).alias(name)

    user = key("user", "user_id", "analysis_user_key")
    family = key("family", "family_id", "analysis_family_key")
    bundle = key("bundle_composition", "bundle_composition_id", "analysis_bundle_composition_key")
    start = month_cohort(F.col("start_date")).alias("start_month")
    end = month_cohort(F.col("end_date")).alias("end_month")
    subscribed = F.col("subscription_start_date")
    return stage.replace(
        users=lambda: stage.users.select(
            user,
            age_band(F.col("age"), below=None, lowest=7).alias("age_band"),
            "gender",
            month_cohort(subscribed).alias("subscription_cohort"),
            tenure_months(subscribed, day(reference_date)).alias("tenure_months"),
            "current_plan_id",
            family,
        ),
        families=lambda: stage.families.select(
            family, *[c for c in stage.families.columns if c != "family_id"]
        ),
        bundle_discount_compositions=lambda: stage.bundle_discount_compositions.select(
            bundle, family, "component_type", user, "component_role", "status", start, end
        ),
        user_discounts=lambda: stage.user_discounts.select(
            user, bundle, "discount_id", "status", start, end
        ),
        user_services=lambda: stage.user_services.select(
            user, "service_id", "benefit_type", start
        ),
        content_usage=lambda: stage.content_usage.select(
            user, "usage_date", "content_category", "content_detail", "data_usage_mb"
        ),
    )


def row_counts(tables: Tables) -> DataFrame:
    """(table_name, row_count) in one job."""
    counts = [
        tables[name].agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in tables
    ]
    result = counts[0]
    for frame in counts[1:]:
        result = result.unionByName(frame)
    return result


def write_analysis_release(tables: Tables, folder: str, *, reference_date: str) -> dict:
    """Each table as a CSV folder, then a manifest counted from what was written."""
    spark = tables.users.sparkSession
    written = {}
    for name in tables:
        target = paths.join(folder, name)
        schema = tables[name].schema
        tables[name].write.option("header", True).mode("overwrite").csv(target)
        written[name] = spark.read.schema(schema).option("header", True).csv(target)
    counts = {row["table_name"]: row["row_count"] for row in row_counts(Tables(**written)).collect()}
    manifest = {
        "dataset_type": "pseudonymized_analysis_release",
        "reference_date": reference_date,
        "transformations": TRANSFORMATIONS,
        "tables": {name: {"row_count": counts[name]} for name in tables},
    }
    text = json.dumps(manifest, ensure_ascii=False, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option(
        "lineSep", "\n"
    ).text(paths.join(folder, "manifest"))
    return manifest
