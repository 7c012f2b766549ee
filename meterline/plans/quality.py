"""Data-quality rules: each counts failing rows; a batch stops when a count is not zero.

A rule is a one-row frame (rule_name, failed_rows). Row rules on one table share a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline import fixed_values as fixed
from meterline.functions.calendar import date_key, month_key, month_start
from meterline.functions.keys import key_pattern
from meterline.functions.measures import EXACT_MB, active_on, changed
from meterline.operators.frames import date_steps, literal_frame, single_value
from meterline.operators.lookup import matching_rules, with_rules
from meterline.operators.membership import held_keys
from meterline.operators.relations import eligible_usage, orphans, reconcile, symmetric_difference
from meterline.plans import discount_policy as policy
from meterline.plans.marts import day
from meterline.plans.tables import Tables
from meterline.schemas import REQUIRED_COLUMNS, USAGE_GRAIN


class QualityError(RuntimeError):
    """One or more rules counted failing rows."""


def rule(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.lit(name).alias("rule_name"), F.count("*").alias("failed_rows"))


def fk_rule(
    name: str, child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
    optional: bool = False,
) -> DataFrame:
    """Child rows without a parent, among them those without a key unless that is optional. Rows are counted per key before the join, so that a key with many
    rows crosses the network once."""
    counted = child.groupBy(key).agg(F.count("*").alias("n"))
    return orphans(counted, parent, key, parent_key, optional).agg(
        F.lit(name).alias("rule_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows")
    )


def row_rules(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Several row conditions counted in one pass over the table."""
    counted = df.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule_name"), F.count_if(failing).alias("failed_rows"))
                for name, failing in conditions.items()
            ]
        ).alias("rules")
    )
    return counted.select(F.inline("rules"))


def totals_agree(name: str, left: DataFrame, left_sum: str, right: DataFrame, right_sum: str) -> DataFrame:
    """One failing row if two totals differ; an empty side counts as zero."""
    a = left.agg(F.coalesce(F.sum(left_sum), F.lit(0)).cast("decimal(38,3)").alias("v")).scalar()
    both = right.agg(F.coalesce(F.sum(right_sum), F.lit(0)).cast("decimal(38,3)").alias("v"))
    return both.select(
        F.lit(name).alias("rule_name"),
        F.when(changed(F.col("v"), a), 1).otherwise(0).cast("bigint").alias("failed_rows"),
    )


def counts_agree(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    a = left.agg(F.count("*")).scalar()
    return right.agg(F.count("*").alias("n")).select(
        F.lit(name).alias("rule_name"),
        F.when(F.col("n") != a, 1).otherwise(0).cast("bigint").alias("failed_rows"),
    )


def union_rules(*rules: DataFrame) -> DataFrame:
    result = rules[0]
    for frame in rules[1:]:
        result = result.unionByName(frame)
    return result


def duplicates(df: DataFrame, *keys: str | Column) -> DataFrame:
    """One row per key that occurs more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)


def assert_zero(rules: DataFrame) -> list[tuple[str, int]]:
    """Run the rules; raise with every failing rule. There is one result row per rule."""
    results = [(row["rule_name"], row["failed_rows"]) for row in rules.collect()]
    failed = [f"{name}: {count}" for name, count in results if count]
    if failed:
        raise QualityError("; ".join(sorted(failed)))
    return results


def not_whole(age: Column) -> Column:
    return age.isNotNull() & (
        ~age.between(-2147483648, 2147483647) | (age != F.floor(age))
    )


# --- source tables -----------------------------------------------------------------------------


def _missing(table: str) -> Column:
    """Some required column is null."""
    found = [F.col(column).isNull() for column in REQUIRED_COLUMNS[table]]
    return reduce(lambda a, b: a | b, found)


def _usage_constraints(prefix: str, usage: DataFrame) -> list[DataFrame]:
    """Repeated ids, and repeated customer, day, category and detail."""
    return [
        rule(f"{prefix}_content_usage_key", duplicates(usage.dropna(subset=["content_usage_id"]), "content_usage_id")),
        rule(f"{prefix}_content_usage_grain", duplicates(usage.dropna(subset=USAGE_GRAIN), *USAGE_GRAIN)),
    ]


def source_constraints(stage: Tables, further: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Required columns and keys of all source tables, and further row rules, in one pass over the rows of each.

    A key rule counts the keys that occur more than once.
    """
    rules = []
    for table, columns in REQUIRED_COLUMNS.items():
        conditions = {f"staging_{table}_required": _missing(table), **further.get(table, {})}
        rules.append(row_rules(stage[table], conditions))
        if table != "content_usage":
            rules.append(rule(f"staging_{table}_key", duplicates(stage[table].dropna(subset=columns[:1]), columns[0])))
    return union_rules(*rules, *_usage_constraints("staging", stage.content_usage))


def staging_rules(stage: Tables) -> DataFrame:
    """Checks of a full snapshot before anything is stored."""
    fractional = (
        not_whole(F.col("enrollment_min_age"))
        | not_whole(F.col("enrollment_max_age"))
        | not_whole(F.col("benefit_end_age"))
    )
    bundles = stage.bundle_discount_compositions.select("bundle_composition_id", "family_id", "user_id")
    bundle_failures = orphans(bundles, stage.families, "family_id").unionByName(
        orphans(bundles, stage.users, "user_id", optional=True)
    ).select("bundle_composition_id").distinct()
    offers = stage.plan_benefits.select("plan_benefit_id", "plan_id", "service_id")
    offer_failures = orphans(offers, stage.plans, "plan_id").unionByName(
        orphans(offers, stage.additional_services, "service_id")
    ).select("plan_benefit_id").distinct()
    picks = stage.user_services.select("user_service_id", "user_id", "service_id")
    pick_failures = orphans(picks, stage.users, "user_id").unionByName(
        orphans(picks, stage.additional_services, "service_id")
    ).select("user_service_id").distinct()
    rows = stage.user_discounts.select(
        "user_discount_id", "user_id", "bundle_composition_id", "discount_id"
    )
    discount_failures = (
        orphans(rows, stage.users, "user_id")
        .unionByName(orphans(rows, stage.bundle_discount_compositions, "bundle_composition_id"))
        .unionByName(orphans(rows, stage.discounts, "discount_id"))
        .select("user_discount_id")
        .distinct()
    )
    return union_rules(
        source_constraints(stage, {
            "premium_family_discount_rules": {"staging_premium_family_age_integer": fractional},
            "age_benefits": {"staging_age_benefit_range": F.col("max_age") < F.col("min_age")},
            "content_usage": {"staging_usage_negative": F.col("data_usage_mb") < 0},
        }),
        fk_rule("staging_users_plan_fk", stage.users, stage.plans, "current_plan_id", "plan_id"),
        fk_rule("staging_users_family_fk", stage.users, stage.families, "family_id", optional=True),
        fk_rule("staging_usage_user_fk", stage.content_usage, stage.users, "user_id"),
        rule("staging_bundle_fk", bundle_failures),
        rule("staging_plan_benefit_fk", offer_failures),
        rule("staging_user_service_fk", pick_failures),
        rule("staging_user_discount_fk", discount_failures),
    )


def incremental_staging_rules(
    usage: DataFrame, users: DataFrame, manifest: DataFrame, first: str, last: str,
    history: DataFrame | None = None,
) -> DataFrame:
    """Checks of day partitions; `usage` carries partition_event_date.

    `history` is the stored detail: an id is the key of all of it, so the batch may not bring one that a day outside
    its own range holds. (The days of the range are replaced.)
    """
    staged = usage.agg(F.count("*")).scalar()
    listed = manifest.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    return union_rules(
        row_rules(
            usage,
            {
                "incremental_partition_date_match":
                    F.col("partition_event_date") != F.col("usage_date"),
                "incremental_date_range": ~F.col("usage_date").between(day(first), day(last)),
                "incremental_content_usage_required": _missing("content_usage"),
                "incremental_usage_negative": F.col("data_usage_mb") < 0,
            },
        ),
        *_usage_constraints("incremental", usage),
        fk_rule("incremental_user_fk", usage, users, "user_id"),
        listed.select(
            F.lit("incremental_manifest_rows").alias("rule_name"),
            F.when(F.col("n") != staged, 1).otherwise(0).cast("bigint").alias("failed_rows"),
        ),
        *([] if history is None else [known_ids_rule(usage, history, first, last)]),
    )


def known_ids_rule(usage: DataFrame, history: DataFrame, first: str, last: str) -> DataFrame:
    """Ids of the batch that the stored detail has on a day outside the batch's range."""
    other_days = history.where(~F.col("usage_date").between(day(first), day(last)))
    return rule("incremental_content_usage_known", held_keys(usage, other_days, "content_usage_id"))


# --- warehouse and marts ------------------------------------------------------------------------

_COUNTED = [
    "users", "families", "bundle_discount_compositions", "plans", "age_benefits",
    "plan_age_benefits", "additional_services", "plan_benefits", "discounts",
    "internet_bundle_discount_rules", "premium_family_discount_rules", "user_discounts",
    "user_services",
]


def table_count_differences(dw: Tables, stage: Tables, names: Sequence[str] = _COUNTED) -> DataFrame:
    """Tables whose warehouse row count differs from the source."""
    def counts(tables: Tables, column: str) -> DataFrame:
        return union_rules(
            *[
                tables[name].agg(F.lit(name).alias("table_name"), F.count("*").alias(column))
                for name in names
            ]
        )

    joined = counts(dw, "stored").join(counts(stage, "staged"), "table_name")
    return joined.where(F.col("stored") != F.col("staged"))


def _bounds_lost(dw: Tables, stage: Tables) -> DataFrame:
    return reconcile(dw.age_benefits, stage.age_benefits, "age_benefit_id", ["min_age", "max_age"])


def _eligible(usage: DataFrame, users: DataFrame, reference_date: str | None = None) -> DataFrame:
    """Eligible usage per customer and day, as rows `n` and usage `mb`.

    Rows are dealt by customer before they are summed, so that the join finds the sums where they are.
    """
    per_day = usage.repartition("user_id").groupBy("user_id", "usage_date").agg(
        F.count("*").alias("n"), F.sum("data_usage_mb").alias("mb")
    )
    return eligible_usage(per_day, users.select("user_id", "subscription_start_date"), reference_date)


def _detail_rules(
    dw: Tables, key: str, grain: Sequence[str], eligible: DataFrame, names: Mapping[str, str]
) -> DataFrame:
    """Rules on the stored detail in one pass over it; `names` gives the rules wanted and their names.

    `total` and `rows` fail once if usage or row count differ from those of `eligible`; `early` counts the rows before
    a subscription start, once for each row of the customer in users; `grain` counts the keys that occur more than once.
    The detail is dealt by customer once, for its sums and for the join with the starts.
    """
    start, date = "subscription_start_date", F.col("usage_date")
    # A repeated customer has one row with the numbers of its starts: the join repeats no detail.
    starts = (
        dw.users.where(F.col(key).isNotNull()).select(key, start).repartition(key)
        .groupBy(key, start).agg(F.count("*").alias("c"))
        .groupBy(key).agg(F.collect_list(F.struct(start, "c")).alias("_starts"))
    )
    groups = dw.content_usage.repartition(key).groupBy(*grain).agg(
        F.count("*").alias("n"), F.sum("data_usage_mb").alias("mb")
    )
    later = F.aggregate(
        F.filter("_starts", lambda s: s[start] > date), F.lit(0).cast("bigint"), lambda found, s: found + s["c"]
    )
    nothing = F.lit(0)
    counted = groups.join(starts, key, "left").agg(
        F.coalesce(F.sum("mb"), nothing).cast("decimal(38,3)").alias("mb"),
        F.coalesce(F.sum("n"), nothing).alias("n"),
        F.coalesce(F.sum(F.col("n") * F.coalesce(later, nothing)), nothing).alias("early"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    wanted = single_value(eligible, F.struct(
        F.coalesce(F.sum("mb"), nothing).cast("decimal(38,3)").alias("mb"), F.coalesce(F.sum("n"), nothing).alias("n"),
    ))
    failed = {
        "total": F.when(changed(F.col("mb"), wanted["mb"]), 1).otherwise(0).cast("bigint"),
        "rows": F.when(F.col("n") != wanted["n"], 1).otherwise(0).cast("bigint"),
        "early": F.col("early"),
        "grain": F.col("repeated"),
    }
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule_name"), failed[measure].alias("failed_rows")) for measure, name in names.items()
    ])))


def operations_warehouse_rules(dw: Tables, stage: Tables, reference_date: str) -> DataFrame:
    return union_rules(
        rule("operations_dw_14_table_counts", table_count_differences(dw, stage)),
        rule("operations_dw_age_benefit_bounds_preserved", _bounds_lost(dw, stage)),
        _detail_rules(
            dw, "analysis_user_key", ["analysis_user_key", "usage_date", "content_category"],
            _eligible(stage.content_usage, stage.users, reference_date),
            {
                "total": "operations_dw_usage_total",
                "early": "operations_dw_pre_subscription_usage",
                "grain": "operations_dw_category_grain",
            },
        ),
        row_rules(
            dw.users,
            {"operations_dw_key_format": ~F.col("analysis_user_key").rlike(key_pattern("user"))},
        ),
    )


def _names_changed(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.select("user_id", F.col("name").alias("other_name"))
    return left.join(other, "user_id").where(F.col("name") != F.col("other_name"))


def personalization_warehouse_rules(dw: Tables, stage: Tables, reference_date: str) -> DataFrame:
    return union_rules(
        rule("personalization_dw_14_table_counts", table_count_differences(dw, stage)),
        rule("personalization_dw_age_benefit_bounds_preserved", _bounds_lost(dw, stage)),
        rule("personalization_dw_name_preserved", _names_changed(dw.users, stage.users)),
        _detail_rules(
            dw, "user_id", ["user_id", "usage_date", "content_category", "content_detail"],
            _eligible(stage.content_usage, stage.users, reference_date),
            {
                "rows": "personalization_dw_usage_rows",
                "early": "personalization_dw_pre_subscription_usage",
                "grain": "personalization_dw_detail_grain",
            },
        ),
    )


def operations_mart_rules(mart: Tables, dw: Tables, reference_date: str) -> DataFrame:
    subscribed = dw.users.where(F.col("subscription_start_date") <= day(reference_date))
    return union_rules(
        totals_agree(
            "operations_dm_usage_total", mart.daily_usage_segment, "total_usage_mb",
            dw.content_usage, "data_usage_mb",
        ),
        totals_agree(
            "operations_dm_monthly_total", mart.monthly_usage_segment, "total_usage_mb",
            dw.content_usage, "data_usage_mb",
        ),
        counts_agree("operations_dm_active_subscriber", mart.subscriber_current, subscribed),
        column_rule(mart, "operations_dm_no_detail_dimension", lambda t, c: c == "content_detail"),
    )


def column_rule(tables: Tables, name: str, failing) -> DataFrame:
    """Count columns that a schema must not have."""
    spark = tables[next(iter(tables))].sparkSession
    count = sum(bool(failing(table, column)) for table in tables for column in tables[table].columns)
    return literal_frame(spark, [(name, count)], "rule_name string, failed_rows bigint")


NAMED_VIEWS = [
    "v_customer_month_daily_usage", "v_customer_day_content_usage", "v_customer_monthly_usage",
    "v_customer_monthly_category_usage", "v_customer_monthly_detail_usage",
    "v_customer_current_plan",
]


def personalization_mart_rules(mart: Tables, dw: Tables, views: Tables) -> DataFrame:
    spark = dw.users.sparkSession
    unnamed = sum("name" not in views[view].columns for view in NAMED_VIEWS)
    return union_rules(
        rule("personalization_dm_customer_name", _names_changed(mart.dim_customer, dw.users)),
        totals_agree(
            "personalization_dm_daily_total", mart.customer_daily_usage, "total_usage_mb",
            dw.content_usage, "data_usage_mb",
        ),
        totals_agree(
            "personalization_dm_monthly_total", mart.customer_monthly_usage, "total_usage_mb",
            dw.content_usage, "data_usage_mb",
        ),
        totals_agree(
            "personalization_dm_detail_view_total", mart.customer_content_daily_usage,
            "data_usage_mb", dw.content_usage, "data_usage_mb",
        ),
        literal_frame(
            spark, [("personalization_ai_name_present", unnamed)],
            "rule_name string, failed_rows bigint",
        ),
    )


def incremental_warehouse_rules(
    dw: Tables, staged: DataFrame, users: DataFrame, key: str, first: str, last: str, area: str
) -> DataFrame:
    """Replaced days keep the eligible total, start after the subscription and stay unique.

    `users` has user_id and subscription_start_date; `dw` is limited to nothing, the window is applied
    here.
    """
    window = dw.replace(
        content_usage=dw.content_usage.where(F.col("usage_date").between(day(first), day(last)))
    )
    grain = [key, "usage_date", "content_category"]
    names = {
        "total": f"{area}_dw_incremental_total",
        "early": f"{area}_dw_incremental_pre_subscription_usage",
        "grain": f"{area}_dw_incremental_grain",
    }
    if area == "personalization":
        grain.append("content_detail")
        names["rows"] = "personalization_dw_incremental_rows"
    return _detail_rules(window, key, grain, _eligible(staged, users), names)


def incremental_mart_rules(
    mart: Tables, dw: Tables, first: str, last: str, area: str
) -> DataFrame:
    """Rebuilt days and months agree with the warehouse."""
    daily, monthly = (
        ("daily_usage_segment", "monthly_usage_segment")
        if area == "operations"
        else ("customer_daily_usage", "customer_monthly_usage")
    )
    a, b = day(first), day(last)
    in_days = F.col("date_key").between(date_key(a), date_key(b))
    in_months = F.col("month_key").between(month_key(a), month_key(b))
    usage = dw.content_usage
    return union_rules(
        totals_agree(
            f"{area}_dm_incremental_daily_total", mart[daily].where(in_days), "total_usage_mb",
            usage.where(F.col("usage_date").between(a, b)), "data_usage_mb",
        ),
        totals_agree(
            f"{area}_dm_incremental_monthly_total", mart[monthly].where(in_months),
            "total_usage_mb",
            usage.where(F.col("usage_date").between(month_start(a), b)), "data_usage_mb",
        ),
    )


# --- view contract and pre-aggregate ------------------------------------------------------------

PREAGGREGATE_COLUMNS = [
    (1, "analysis_user_key", "string"),
    (2, "calendar_month", "date"),
    (3, "total_usage_mb", "decimal"),
    (4, "month_key", "int"),
]


def column_frame(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) of a frame."""
    rows = [
        (number, field.name, field.dataType.typeName().replace("integer", "int"))
        for number, field in enumerate(df.schema.fields, 1)
    ]
    return literal_frame(df.sparkSession, rows, "position int, column_name string, data_type string")


def contract_differences(df: DataFrame, expected: Sequence[tuple]) -> DataFrame:
    wanted = literal_frame(
        df.sparkSession, expected, "position int, column_name string, data_type string"
    )
    return symmetric_difference(wanted, column_frame(df))


def preaggregate_report(mart: Tables, views: Tables) -> DataFrame:
    """PASS/FAIL report of the customer-month view against its fact."""
    view = views.v_customer_monthly_usage_preaggregated
    fact = mart.customer_monthly_category_usage

    # Both sides come down to one row a month with all that the rules count, so that each is read once.
    total = F.sum("total_usage_mb").alias("mb")
    by_customer = view.groupBy("analysis_user_key", "month_key").agg(F.count("*").alias("n"), total)
    of_view = by_customer.groupBy("month_key").agg(
        F.sum("mb").cast(EXACT_MB).alias("view_mb"), F.count_if(F.col("n") > 1).alias("repeated"), F.lit(True).alias("_in_view")
    )
    of_fact = fact.groupBy("month_key").agg(
        F.sum("total_usage_mb").cast(EXACT_MB).alias("fact_mb"), F.count("*").alias("rows"), F.lit(True).alias("_in_fact")
    )
    differs = (
        F.col("_in_view").isNull() | F.col("_in_fact").isNull() | changed(F.col("view_mb"), F.col("fact_mb"))
    )
    months = of_fact.join(of_view, "month_key", "full").agg(
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("customer_month_grain"),
        F.count_if(differs).alias("monthly_usage_reconciliation"),
        F.coalesce(F.sum(F.when(F.col("month_key") % 100 != 1, F.col("rows"))), F.lit(0)).alias("month_first_key"),
    )
    rules = union_rules(
        rule("view_column_contract", contract_differences(view, PREAGGREGATE_COLUMNS)),
        months.unpivot([], months.columns, "rule_name", "failed_rows"),
    )
    return rules.select(
        "rule_name",
        "failed_rows",
        F.when(F.col("failed_rows") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("result"),
    ).orderBy("rule_name")


def layer_totals(ops_dw: Tables, pers_dw: Tables, ops_mart: Tables, pers_mart: Tables) -> DataFrame:
    """Usage total of four layers against the personalization warehouse."""
    layers = [
        ("dw_operations", ops_dw.content_usage, "data_usage_mb"),
        ("dw_personalization", pers_dw.content_usage, "data_usage_mb"),
        ("dm_operations_daily", ops_mart.daily_usage_segment, "total_usage_mb"),
        ("dm_personalization_daily", pers_mart.customer_daily_usage, "total_usage_mb"),
    ]
    totals = union_rules(
        *[
            df.agg(
                F.lit(name).alias("layer"),
                F.count("*").alias("row_count"),
                F.coalesce(F.sum(column), F.lit(0)).cast(EXACT_MB).alias("total_usage_mb"),
            )
            for name, df, column in layers
        ]
    )
    # One row a layer: the window holds four rows, and no layer is summed again for what it is compared with.
    four = W.partitionBy()
    base = F.max(F.when(F.col("layer") == "dw_personalization", F.col("total_usage_mb"))).over(four)
    anything = F.max("row_count").over(four)
    verdict = (
        F.when(anything == 0, F.lit("NO_USAGE_DATA"))
        .when(F.col("total_usage_mb") == base, F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
    )
    return totals.select(
        "layer", "row_count", "total_usage_mb",
        (F.col("total_usage_mb") - base).alias("difference_mb"),
        verdict.alias("total_check"),
    ).orderBy("layer")


# --- run reports ---------------------------------------------------------------------------------


def recent_runs(runs: DataFrame, pipeline: str, latest: int = 10) -> DataFrame:
    return (
        runs.where(F.col("pipeline_name") == pipeline)
        .orderBy(F.col("started_at").desc_nulls_first(), "batch_id")
        .limit(latest)
        .select(
            "batch_id", "run_type", "event_date_from", "event_date_to", "status", "started_at",
            "ended_at",
        )
    )


def watermark_status(
    runs: DataFrame, watermarks: DataFrame, pipeline: str, yesterday: Column
) -> DataFrame:
    """Whether the watermark belongs to a successful incremental run; one row also without one."""
    last = F.col("last_successful_event_date")
    loaded = runs.select(
        F.col("batch_id").alias("last_successful_batch_id"),
        F.col("pipeline_name").alias("run_pipeline"),
        "run_type", "status", "event_date_to",
    )
    marks = watermarks.where(F.col("pipeline_name") == pipeline)
    good = (
        (F.col("run_pipeline") == pipeline)
        & (F.col("run_type") == "INCREMENTAL")
        & (F.col("status") == "SUCCEEDED")
        & (F.col("event_date_to") == last)
    )
    seed = runs.sparkSession.range(1).select(F.lit(pipeline).alias("pipeline_name"))
    return (
        seed.join(marks.withColumn("_found", F.lit(True)), "pipeline_name", "left")
        .join(loaded, "last_successful_batch_id", "left")
        .select(
            "last_successful_event_date",
            F.col("status").alias("watermark_batch_status"),
            "event_date_to",
            F.when(F.col("_found").isNull(), F.lit("NO_WATERMARK"))
            .when(good, F.lit("PASS"))
            .otherwise(F.lit("FAIL"))
            .alias("watermark_check"),
            yesterday.alias("yesterday"),
            (last >= yesterday).alias("caught_up_through_yesterday"),
        )
    )


def recorded_checks(runs: DataFrame, results: DataFrame, pipeline: str) -> DataFrame:
    """Recorded rules of every successful run."""
    good = runs.where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCEEDED"))
    counted = results.groupBy("batch_id").agg(
        F.count("rule_name").alias("rules"), F.sum("failed_row_count").alias("failures")
    )
    rules, failures = F.coalesce("rules", F.lit(0)), F.coalesce("failures", F.lit(0))
    return (
        good.join(counted, "batch_id", "left")
        .orderBy(F.desc("started_at"), "batch_id")
        .select(
            "batch_id", "run_type", "event_date_from", "event_date_to",
            rules.alias("checked_rules"),
            failures.alias("failed_rows"),
            F.when(rules == 0, F.lit("MISSING_QUALITY_RESULTS"))
            .when(failures == 0, F.lit("PASS"))
            .otherwise(F.lit("FAIL"))
            .alias("recorded_quality_check"),
        )
    )


# --- business rules of the source tables ---------------------------------------------------------


def user_rules(users: DataFrame, plans: DataFrame) -> DataFrame:
    """`users` also has subscription_months, has_family and has_family_bundle."""
    limit = F.greatest(F.greatest(F.col("age") - 8, F.lit(0)) * 12 + 11, F.lit(1))
    alone = ~F.col("has_family")
    return union_rules(
        fk_rule("users_plan_fk", users, plans, "current_plan_id", "plan_id"),
        row_rules(
            users,
            {
                "users_tenure_within_age": F.col("subscription_months") > limit,
                "users_no_family_id_without_family": alone & F.col("family_id").isNotNull(),
                "users_no_bundle_without_family": alone & F.col("has_family_bundle"),
            },
        ),
    )


def relationship_rules(relations: DataFrame, users: DataFrame, families: DataFrame) -> DataFrame:
    """`relations` has user_id, related_user_id, family_id and type; families declare family_size."""
    def person(prefix: str, key: str) -> DataFrame:
        return users.select(
            F.col("user_id").alias(key),
            F.col("age").alias(prefix + "age"),
            F.col("family_id").alias(prefix + "family"),
            F.lit(True).alias(prefix + "known"),
        )

    joined = relations.join(person("a_", "user_id"), "user_id", "left").join(
        person("b_", "related_user_id"), "related_user_id", "left"
    )
    gap = F.col("a_age") - F.col("b_age")
    kind = F.col("relationship_type")
    members = users.where(F.col("family_id").isNotNull()).groupBy("family_id").agg(
        F.count("*").alias("members")
    )
    sizes = members.join(families.select("family_id", "family_size"), "family_id", "left")
    outside = changed(F.col("a_family"), F.col("family_id")) | changed(
        F.col("b_family"), F.col("family_id")
    )
    known = F.col("a_known") & F.col("b_known")
    return union_rules(
        row_rules(
            joined,
            {
                "relationship_user_fk": ~F.coalesce(known, F.lit(False)),
                "relationship_same_family": outside,
                "relationship_not_self": F.col("user_id") == F.col("related_user_id"),
                "relationship_parent_gap": (kind == "PARENT") & (gap < 18),
                "relationship_grandparent_gap": (kind == "GRANDPARENT") & (gap < 36),
                "relationship_spouse_gap": (kind == "SPOUSE") & (F.abs(gap) > 15),
                "relationship_sibling_gap": (kind == "SIBLING") & (F.abs(gap) > 15),
            },
        ),
        row_rules(sizes, {"family_size": changed(F.col("members"), F.col("family_size"))}),
    )


def bundle_rules(stage: Tables, guardians: DataFrame, reference_date: str) -> DataFrame:
    """Consistency of bundles, their components and the entitlements of each line."""
    families = stage.families.where(F.col("has_bundle"))
    threshold = policy.high_fee(stage)
    premium_type = F.col("bundle_type") == "PREMIUM_FAMILY"
    counted_role = F.col("component_role").isin("BASE_MOBILE", "LOW_MOBILE")

    def no(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    total_method = F.col("bundle_discount_method") == "TOTAL"
    allocation = F.col("total_discount_allocation_method")
    family_checks = row_rules(
        families,
        {
            "bundle_active_internet": no(
                F.col("has_home_internet") & (F.col("internet_status") == "ACTIVE")
            ),
            "bundle_internet_group": no(F.col("internet_product_group").isin(*fixed.INTERNET_GROUPS)),
            "bundle_contract_term": no(
                F.col("internet_contract_months").isin(*fixed.CONTRACT_MONTHS)
            ),
            "bundle_type_known": no(F.col("bundle_type").isin("PREMIUM_FAMILY", "INTERNET_MOBILE")),
            "bundle_method_known": no(F.col("bundle_discount_method").isin("TOTAL", "FIXED")),
            "bundle_allocation": F.when(
                total_method, no(allocation.isin("EQUAL", "CONTRIBUTION"))
            ).otherwise(allocation.isNotNull()),
            "bundle_internet_benefit": no(F.col("internet_benefit_discount_id") == "D005"),
        },
    )
    internet_checks = row_rules(
        stage.families,
        {
            "internet_group_supported": F.col("has_home_internet")
            & no(F.col("internet_product_group").isin(*fixed.INTERNET_GROUPS)),
            "no_group_without_internet": ~F.col("has_home_internet")
            & F.col("internet_product_group").isNotNull(),
        },
    )
    lines = policy.family_lines(stage)
    components = stage.bundle_discount_compositions
    mobile = components.where(F.col("component_type") == "MOBILE")
    own = mobile.join(
        lines.select("user_id", "monthly_fee", "network_type", "age", F.col("family_id").alias("home")),
        "user_id", "left",
    )
    per_family = own.groupBy("family_id").agg(
        F.count_if(F.col("component_role") == "BASE_MOBILE").alias("base_lines"),
        F.count_if(F.col("component_role") == "PREMIUM_MOBILE").alias("premium_lines"),
        F.count_if(F.col("home") == F.col("family_id")).alias("own_lines"),
        F.count("*").alias("mobile_components"),
        F.max(F.when(F.col("component_role") == "BASE_MOBILE", F.col("monthly_fee"))).alias("base_fee"),
        F.sum(F.when(counted_role, F.col("monthly_fee"))).alias("pool_fee"),
        F.count_if(counted_role).alias("counted_lines"),
        F.count_if(counted_role & (F.col("monthly_fee") >= fixed.PAYING_LINE_FEE)).alias("paying_lines"),
    )
    internet = components.where(F.col("component_role") == "BASE_INTERNET").groupBy(
        "family_id"
    ).agg(F.count("*").alias("internet_lines"))
    counts = policy.line_counts(stage).select("family_id", "mobile_lines", "high_lines")
    entitled = (
        stage.user_discounts.join(
            components.select(
                "bundle_composition_id", "family_id", "component_role", "component_type",
                F.col("user_id").alias("component_user"),
            ),
            "bundle_composition_id", "left",
        )
    )
    base_rows = entitled.where(counted_role).groupBy("family_id").agg(
        F.count_if(F.col("discount_id") == "D001").alias("d001_rows"),
        F.count_if(F.col("discount_id") == "D002").alias("d002_rows"),
    )
    structure = (
        families.join(counts, "family_id")
        .join(per_family, "family_id", "left")
        .join(internet, "family_id", "left")
        .join(base_rows, "family_id", "left")
        .na.fill(0)
    )
    group, months = F.col("internet_product_group"), F.col("internet_contract_months")
    structure = with_rules(
        structure, stage.internet_bundle_discount_rules, _pool=policy.TOTAL_POOL
    )
    pools = matching_rules("_pool", group, months, mobile_total=F.col("pool_fee"))
    recipients = F.when(
        F.coalesce(F.get(pools, 0)["discount_amount"] > 0, F.lit(False)), F.col("counted_lines")
    ).otherwise(0)
    expected = F.when(total_method, recipients).otherwise(F.col("paying_lines"))
    actual = F.when(total_method, F.col("d001_rows")).otherwise(F.col("d002_rows"))
    structure_checks = row_rules(
        structure.withColumn("_expected", expected).withColumn("_actual", actual),
        {
            "bundle_one_base_internet": F.col("internet_lines") != 1,
            "bundle_all_members": (F.col("own_lines") != F.col("mobile_lines"))
            | (F.col("mobile_components") != F.col("mobile_lines")),
            "bundle_one_base_mobile": F.col("base_lines") != 1,
            "premium_two_high_lines": premium_type & (F.col("high_lines") < 2),
            "premium_internet_group": premium_type & no(group == fixed.HIGHER_INTERNET_GROUP),
            "premium_base_fee": premium_type & (F.col("base_fee") < threshold),
            "general_not_premium": ~premium_type
            & (F.col("high_lines") >= 2)
            & no(group == "SLIM"),
            "general_no_premium_line": ~premium_type & (F.col("premium_lines") > 0),
            "bundle_recipients": F.col("_actual") != F.col("_expected"),
        },
    )
    held = entitled.groupBy("bundle_composition_id").agg(
        F.collect_set("discount_id").alias("held"),
        F.min(F.when(F.col("discount_id") == "D004", F.col("start_date"))).alias("youth_start"),
    )
    per_line = (
        own.join(
            families.select("family_id", "bundle_type", "bundle_discount_method"), "family_id"
        )
        .join(held, "bundle_composition_id", "left")
        .withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    )

    def has(discount: str) -> Column:
        return F.array_contains("held", discount)

    other = F.when(total_method, has("D002")).otherwise(has("D001"))
    line_checks = row_rules(
        per_line,
        {
            "counted_line_without_rate": counted_role & has("D003"),
            "counted_line_method": counted_role & other,
            "premium_line_rate": ~counted_role
            & no((F.col("monthly_fee") >= threshold) & has("D003")),
            "premium_line_no_method": ~counted_role & (has("D001") | has("D002")),
        },
    )
    youth_checks = row_rules(
        _youth_lines(stage, per_line, lines, guardians, reference_date),
        {
            "youth_eligibility": has("D004") & ~F.col("youth_allowed"),
            "youth_guardian": has("D004") & ~F.col("guarded"),
        },
    )
    bundled = stage.families.select("family_id", "has_bundle")
    owner_checks = row_rules(
        entitled.join(bundled, "family_id", "left"),
        {
            "entitlement_own_line": no(
                (F.col("component_type") == "MOBILE")
                & (F.col("component_user") == F.col("user_id"))
            ),
            "entitlement_bundled_family": no(F.col("has_bundle")),
        },
    )
    key_checks = union_rules(
        rule("discount_master", symmetric_difference(
            stage.discounts.select("discount_id"),
            literal_frame(
                stage.users.sparkSession,
                [("D001",), ("D002",), ("D003",), ("D004",), ("D005",)], "discount_id string",
            ),
        )),
        rule("entitlement_unique", duplicates(
            stage.user_discounts, "user_id", "discount_id", "bundle_composition_id", "start_date"
        )),
    )
    return union_rules(
        family_checks, internet_checks, structure_checks, line_checks, youth_checks, owner_checks,
        key_checks,
    )


def _youth_lines(
    stage: Tables, per_line: DataFrame, lines: DataFrame, guardians: DataFrame, reference_date: str
) -> DataFrame:
    """Lines with the policy conditions of the youth benefit."""
    def value(column: str) -> Column:
        return policy.premium_rule(stage, "D004", column)

    guarded = (
        lines.join(guardians.select("user_id"), "user_id", "left_semi")
        .where(
            (F.col("monthly_fee") >= value("guardian_minimum_plan_fee"))
            & (F.col("network_type") == value("guardian_required_network_type"))
        )
        .select("family_id").distinct().withColumn("_guarded", F.lit(True))
    )
    over = F.greatest((F.col("age") - value("enrollment_max_age")).cast("int"), F.lit(0))
    in_time = (over == 0) | (F.col("youth_start") <= F.add_months(day(reference_date), -12 * over))
    allowed = (
        (F.col("bundle_type") == "PREMIUM_FAMILY")
        & (F.col("age") >= value("enrollment_min_age"))
        & (F.col("age") < value("benefit_end_age"))
        & in_time
        & (F.col("monthly_fee") >= value("minimum_plan_fee"))
        & (F.col("network_type") == value("required_network_type"))
    )
    return per_line.join(guarded, "family_id", "left").select(
        "held",
        F.coalesce(allowed, F.lit(False)).alias("youth_allowed"),
        F.coalesce("_guarded", F.lit(False)).alias("guarded"),
    )


def discount_amount_rules(stage: Tables, reference_date: str) -> DataFrame:
    """Users with an active entitlement are exactly those with a positive discount."""
    amounts = policy.current_discount_amounts(stage, reference_date)
    active = stage.user_discounts.where(active_on(day(reference_date))).select("user_id").distinct()
    positive = amounts.where(F.col("current_total_discount_amount") > 0).select("user_id")
    return union_rules(
        row_rules(
            amounts, {"discount_not_negative": F.col("current_total_discount_amount") < 0}
        ),
        rule("active_users_are_positive", symmetric_difference(active, positive)),
    )


def policy_rules(stage: Tables) -> DataFrame:
    """Discount policy tables: references, uniqueness, terms and core amounts."""
    rules, premium = stage.internet_bundle_discount_rules, stage.premium_family_discount_rules
    kind = F.col("discount_id")
    kinds = literal_frame(
        rules.sparkSession, [("D003",), ("D004",)], "discount_id string"
    )
    return union_rules(
        fk_rule("internet_rule_discount_fk", rules, stage.discounts, "discount_id"),
        fk_rule("premium_rule_discount_fk", premium, stage.discounts, "discount_id"),
        rule("internet_rule_unique", duplicates(
            rules, "discount_id", "bundle_discount_method", "rule_type", "internet_product_group",
            "contract_months", "mobile_total_fee_min", "mobile_line_fee_min",
        )),
        row_rules(
            rules,
            {
                "internet_rule_term": ~F.col("contract_months").isin(*fixed.CONTRACT_MONTHS),
                "internet_rule_amount": F.col("discount_amount") < 0,
            },
        ),
        rule("premium_rule_kinds", symmetric_difference(premium.select("discount_id"), kinds)),
        row_rules(
            premium,
            {
                "premium_rate": (kind == "D003") & changed(F.col("discount_rate"), F.lit("0.25").cast("decimal(8,5)")),
                "youth_amount": (kind == "D004") & changed(F.col("discount_amount"), F.lit(5500).cast("decimal(12,2)")),
                "youth_ages": (kind == "D004")
                & ((F.col("enrollment_max_age") != 18) | (F.col("benefit_end_age") != 20)),
            },
        ),
    )


def taxonomy_frame(spark: SparkSession) -> DataFrame:
    rows = [
        (detail, category)
        for category, details in fixed.CONTENT_TAXONOMY.items()
        for detail in details
    ]
    return literal_frame(spark, rows, "content_detail string, parent string")


def usage_rules(usage: DataFrame, daily: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Detail adds up to the daily usage; categories and details follow the taxonomy; unique grain.

    `daily` has user_id, usage_date and total_data_mb.
    """
    summed = usage.groupBy("user_id", "usage_date").agg(F.sum("data_usage_mb").alias("mb"))
    keys = ["user_id", "usage_date"]
    joined = daily.select(*keys, "total_data_mb").join(summed, keys, "full")
    gap = F.abs(F.col("total_data_mb") - F.col("mb"))
    off = F.col("total_data_mb").isNull() | F.col("mb").isNull() | (gap > F.lit(tolerance).cast("decimal(9,6)"))
    placed = usage.join(F.broadcast(taxonomy_frame(usage.sparkSession)), "content_detail", "left")
    return union_rules(
        row_rules(joined, {"daily_equals_detail": off}),
        row_rules(
            placed,
            {
                "category_known": ~F.col("content_category").isin(*fixed.CONTENT_TAXONOMY),
                "detail_known": F.col("parent").isNull(),
                "detail_in_category": F.col("parent") != F.col("content_category"),
            },
        ),
        rule("usage_grain_unique", duplicates(
            usage, "user_id", "usage_date", "content_category", "content_detail"
        )),
    )


def master_rules(stage: Tables, assigned_benefits: DataFrame) -> DataFrame:
    """Relations between plans, services, benefits and what users chose.

    `assigned_benefits` has user_id and current_age_benefit_id.
    """
    plans, offers, picks = stage.plans, stage.plan_benefits, stage.user_services
    prefix = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in fixed.PLAN_PREFIXES.items() for x in pair]),
        F.col("plan_family"),
    )
    selectable = offers.where(F.col("is_selectable"))

    def without_offer(family: str, benefit: str) -> DataFrame:
        offering = selectable.where(F.col("benefit_type") == benefit).select("plan_id")
        return plans.where(F.col("plan_family") == family).join(offering, "plan_id", "left_anti")

    user_plans = stage.users.select("user_id", F.col("current_plan_id").alias("plan_id"))
    chosen = picks.join(user_plans, "user_id")
    not_offered = chosen.join(
        selectable.select("plan_id", "service_id", "benefit_type"),
        ["plan_id", "service_id", "benefit_type"], "left_anti",
    )
    counts = picks.groupBy("user_id").agg(
        F.count_if(F.col("benefit_type") == "DOUBLE_CHOICE").alias("double_picks"),
        F.count_if(F.col("benefit_type") == "CHOICE").alias("single_picks"),
        F.count("*").alias("picks"),
    )
    family = F.col("plan_family")
    selections = (
        user_plans.join(plans.select("plan_id", "plan_family"), "plan_id")
        .join(counts, "user_id", "left")
        .na.fill(0)
    )
    supported = stage.plan_age_benefits.select(
        "plan_id", F.col("age_benefit_id").alias("current_age_benefit_id")
    )
    assigned = assigned_benefits.where(F.col("current_age_benefit_id").isNotNull()).select(
        "user_id", "current_age_benefit_id"
    )
    ages = stage.age_benefits.select(
        F.col("age_benefit_id").alias("current_age_benefit_id"), "min_age", "max_age"
    )
    aged = assigned.join(stage.users.select("user_id", "age"), "user_id").join(
        ages, "current_age_benefit_id"
    )
    return union_rules(
        fk_rule("plan_benefits_plan_fk", offers, plans, "plan_id"),
        fk_rule("plan_benefits_service_fk", offers, stage.additional_services, "service_id"),
        fk_rule("plan_age_benefits_plan_fk", stage.plan_age_benefits, plans, "plan_id"),
        fk_rule("plan_age_benefits_age_fk", stage.plan_age_benefits, stage.age_benefits, "age_benefit_id"),
        rule("plan_age_benefits_unique", duplicates(stage.plan_age_benefits, "plan_id", "age_benefit_id")),
        row_rules(plans, {"plan_prefix": ~F.coalesce(F.col("plan_id").startswith(prefix), F.lit(False))}),
        rule("choice_plan_offer", without_offer("CHOICE", "CHOICE")),
        rule("double_choice_plan_offer", without_offer("CHOICE_DOUBLE", "DOUBLE_CHOICE")),
        fk_rule("user_services_user_fk", picks, stage.users, "user_id"),
        fk_rule("user_services_service_fk", picks, stage.additional_services, "service_id"),
        rule("user_services_unique", duplicates(picks, "user_id", "service_id")),
        rule("user_services_offered", not_offered),
        row_rules(
            selections,
            {
                "double_choice_two_services": (family == "CHOICE_DOUBLE") & (F.col("double_picks") != 2),
                "choice_one_service": (family == "CHOICE") & (F.col("single_picks") != 1),
                "other_plan_no_service": ~family.isin(*fixed.CHOICE_FAMILIES) & (F.col("picks") > 0),
            },
        ),
        rule("age_benefit_supported", assigned.join(user_plans, "user_id").join(
            supported, ["plan_id", "current_age_benefit_id"], "left_anti"
        )),
        row_rules(
            aged,
            {
                "age_benefit_min_age": F.col("age") < F.col("min_age"),
                "age_benefit_max_age": F.col("age") > F.col("max_age"),
            },
        ),
    )


def partition_rules(usage: DataFrame, users: DataFrame) -> DataFrame:
    """Integrity of day partitions; `usage` carries partition_event_date.

    Identifiers and grain are compared within a day, as partitions are loaded one by one.
    """
    required = ["content_usage_id", "user_id", "usage_date", "content_category", "content_detail", "data_usage_mb"]
    missing = F.lit(False)
    for column in required:
        missing = missing | F.col(column).isNull()
    bounds = usage.agg(
        F.min("partition_event_date").alias("first"), F.max("partition_event_date").alias("last")
    )
    expected = bounds.select(
        F.explode(date_steps(F.col("first"), F.col("last"), "1 day")).alias("partition_event_date")
    )
    present = usage.select("partition_event_date").distinct()

    def extra(name: str, *keys: str) -> DataFrame:
        return duplicates(usage, "partition_event_date", *keys).agg(
            F.lit(name).alias("rule_name"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failed_rows"),
        )

    return union_rules(
        rule("partition_gaps", expected.join(present, "partition_event_date", "left_anti")),
        row_rules(
            usage,
            {
                "partition_wrong_date": F.col("usage_date") != F.col("partition_event_date"),
                "usage_null": missing,
                "usage_not_positive": F.col("data_usage_mb") <= 0,
            },
        ),
        extra("usage_duplicate_id", "content_usage_id"),
        extra(
            "usage_duplicate_grain", "user_id", "usage_date", "content_category", "content_detail"
        ),
        fk_rule("usage_orphan_user", usage, users, "user_id"),
    )


def schema_report(tables: Tables, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per table: rows, columns, missing expected columns, leaked internal columns of users."""
    def describe(name: str) -> DataFrame:
        columns = tables[name].columns
        leaked = [c for c in fixed.INTERNAL_USER_COLUMNS if name == "users" and c in columns]
        return tables[name].agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.lit(len(columns)).cast("bigint").alias("column_count"),
            F.lit(", ".join(c for c in expected.get(name, []) if c not in columns)).alias("missing_columns"),
            F.lit(", ".join(sorted(leaked))).alias("internal_columns"),
        )

    return union_rules(*[describe(name) for name in tables])


def reference_rules(stage: Tables) -> DataFrame:
    """References and allowed values of the exported tables; one base line per bundle."""
    components, rows = stage.bundle_discount_compositions, stage.user_discounts
    mobile = components.where(F.col("component_type") == "MOBILE")
    unknown_user = mobile.select(F.coalesce("user_id", F.lit("")).alias("user_id"))
    families = stage.families
    roles = components.groupBy("family_id").agg(
        F.count_if(F.col("component_role") == "BASE_MOBILE").alias("base_mobile"),
        F.count_if(F.col("component_role") == "BASE_INTERNET").alias("base_internet"),
    )
    bundled = families.where(F.col("has_bundle")).join(roles, "family_id", "left").na.fill(0)
    allocation = F.col("total_discount_allocation_method")
    return union_rules(
        fk_rule("ref_users_plan", stage.users, stage.plans, "current_plan_id", "plan_id"),
        fk_rule("ref_users_family", stage.users, families, "family_id", optional=True),
        fk_rule("ref_component_family", components, families, "family_id"),
        fk_rule("ref_mobile_user", unknown_user, stage.users, "user_id"),
        fk_rule("ref_entitlement_user", rows, stage.users, "user_id"),
        fk_rule("ref_entitlement_component", rows, components, "bundle_composition_id"),
        fk_rule("ref_entitlement_discount", rows, stage.discounts, "discount_id"),
        fk_rule("ref_internet_rule_discount", stage.internet_bundle_discount_rules, stage.discounts, "discount_id"),
        fk_rule("ref_premium_rule_discount", stage.premium_family_discount_rules, stage.discounts, "discount_id"),
        fk_rule("ref_usage_user", stage.content_usage, stage.users, "user_id"),
        row_rules(
            families,
            {
                "value_contract_months": F.col("internet_contract_months").isNotNull()
                & ~F.col("internet_contract_months").isin(*fixed.CONTRACT_MONTHS),
                "value_bundle_type": F.col("bundle_type").isNotNull()
                & ~F.col("bundle_type").isin("INTERNET_MOBILE", "PREMIUM_FAMILY"),
                "value_allocation": (F.col("bundle_discount_method") == "TOTAL")
                & ~F.coalesce(allocation.isin("EQUAL", "CONTRIBUTION"), F.lit(False)),
            },
        ),
        row_rules(
            stage.internet_bundle_discount_rules,
            {"value_rule_months": ~F.coalesce(F.col("contract_months").isin(*fixed.CONTRACT_MONTHS), F.lit(False))},
        ),
        row_rules(
            bundled,
            {
                "one_base_mobile": F.col("base_mobile") != 1,
                "one_base_internet": F.col("base_internet") != 1,
            },
        ),
    )
