"""Customer features for recommendation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.fixed_values import CHOICE_FAMILIES, HIGH_PLAN_FEE, QUOTA_THRESHOLDS
from meterline.functions.calendar import month_start
from meterline.functions.measures import EXACT_MB
from meterline.operators.relations import first_per_group
from meterline.plans.discount_policy import family_features, family_fees
from meterline.plans.marts import month_to_date
from meterline.plans.recipes import chosen_service_usage, daily_usage
from meterline.plans.rollover import rollover_rows, rollover_users, used_by_month
from meterline.plans.tables import Tables


#: Ages from this one on are alike for open age ranges.
OLDEST_AGE = 150


def with_age_benefit(users: DataFrame, stage: Tables) -> DataFrame:
    """users with the benefit of their age; of ranges that overlap, the first by id.

    Ranges become single ages and are joined on them; an open range ends at an age that all higher ones share.
    """
    last = F.coalesce("max_age", F.greatest("min_age", F.lit(OLDEST_AGE)))
    ages = stage.age_benefits.where(F.col("min_age") <= last).select(
        F.explode(F.sequence(F.col("min_age").cast("int"), last.cast("int"))).alias("_age"),
        F.struct("age_benefit_id", "benefit_name", "includes_safety_box").alias("_own"),
    )
    first = ages.groupBy("_age").agg(F.min("_own").alias("_own"))
    own = F.least(F.col("age"), F.lit(OLDEST_AGE)) == F.col("_age")
    return users.join(first, own, "left").select("*", "_own.*").drop("_age", "_own")


def age_benefits(stage: Tables) -> DataFrame:
    """Age benefit of every user that the current plan supports, with effective data allowances."""
    plans = stage.plans.select(
        F.col("plan_id").alias("current_plan_id"), "is_unlimited", "data_limit_gb",
        "base_shared_data_gb",
    )
    values = stage.plan_age_benefits.select(
        F.col("plan_id").alias("current_plan_id"), "age_benefit_id",
        "bonus_data_gb", "bonus_shared_data_gb", "bonus_voice_minutes", "bonus_sms_count",
        "bonus_video_minutes", F.lit(True).alias("_offered"),
    )
    users = with_age_benefit(stage.users.select("user_id", "age", "current_plan_id"), stage).drop("age")

    def bonus(column: str) -> Column:
        return F.coalesce(column, F.lit(0))

    offered = F.coalesce("_offered", F.lit(False))
    base = F.coalesce("data_limit_gb", F.lit(0))
    return (
        users.join(plans, "current_plan_id")
        .join(values, ["current_plan_id", "age_benefit_id"], "left")
        .select(
            "user_id",
            F.when(offered, F.col("age_benefit_id")).alias("current_age_benefit_id"),
            F.when(offered, F.col("benefit_name")).alias("current_age_benefit_name"),
            bonus("bonus_data_gb").alias("age_bonus_data_gb"),
            bonus("bonus_shared_data_gb").alias("age_bonus_shared_data_gb"),
            bonus("bonus_voice_minutes").alias("age_bonus_voice_minutes"),
            bonus("bonus_sms_count").alias("age_bonus_sms_count"),
            bonus("bonus_video_minutes").alias("age_bonus_video_minutes"),
            (offered & F.coalesce("includes_safety_box", F.lit(False))).alias(
                "age_benefit_safety_box"
            ),
            F.when(~F.col("is_unlimited"), base + bonus("bonus_data_gb")).alias(
                "effective_data_gb"
            ),
            (F.coalesce("base_shared_data_gb", F.lit(0)) + bonus("bonus_shared_data_gb")).alias(
                "effective_shared_data_gb"
            ),
            F.col("is_unlimited").alias("effective_data_unlimited"),
        )
    )


def usage_features(stage: Tables) -> DataFrame:
    """Mean daily MB, 30-day GB and top category of every user; ties take the first name."""
    mean = F.sum("daily_data_mb").cast(EXACT_MB) / F.count("*").cast("decimal(9,0)")
    average = daily_usage(stage).groupBy("user_id").agg(
        F.round(mean, 2).alias("avg_daily_data_mb")
    )
    sums = stage.content_usage.groupBy("user_id", "content_category").agg(
        F.sum("data_usage_mb").alias("mb")
    )
    top = first_per_group(sums, "user_id", -F.col("mb"), F.col("content_category"))
    monthly = F.col("avg_daily_data_mb") * F.lit(30).cast("decimal(2,0)")
    return (
        stage.users.select("user_id")
        .join(average, "user_id", "left")
        .join(top, "user_id", "left")
        .select(
            "user_id",
            "avg_daily_data_mb",
            F.round(monthly.cast("decimal(30,2)") / F.lit(1024).cast("decimal(4,0)"), 2).alias(
                "monthly_estimated_data_gb"
            ),
            F.col("content_category").alias("top_content_category"),
        )
    )


def chosen_service_value(stage: Tables) -> DataFrame:
    """Normal monthly price of a user's chosen services, zero without any."""
    prices = stage.additional_services.select("service_id", "normal_monthly_price")
    values = stage.user_services.select("user_id", "service_id").join(prices, "service_id").groupBy(
        "user_id"
    ).agg(F.sum("normal_monthly_price").alias("value"))
    return stage.users.select("user_id").join(values, "user_id", "left").select(
        "user_id", F.coalesce("value", F.lit(0)).alias("current_benefit_value")
    )


def quota_stage(used: Column, allowance: Column, thresholds: Sequence[float]) -> Column:
    watch, save, critical = thresholds
    share = F.when(allowance > 0, used / allowance)
    return (
        F.when((allowance <= 0) | (share >= 1.0), F.lit("DEPLETED"))
        .when(share >= critical, F.lit("CRITICAL"))
        .when(share >= save, F.lit("SAVE"))
        .when(share >= watch, F.lit("WATCH"))
        .otherwise(F.lit("NORMAL"))
    )


def daily_quota_stages(
    stage: Tables, thresholds: Sequence[float] = QUOTA_THRESHOLDS["NORMAL"]
) -> DataFrame:
    """Quota stage of each usage day from the usage of earlier days of the month."""
    plans = stage.plans.select(
        F.col("plan_id").alias("current_plan_id"), "is_unlimited", "data_limit_gb"
    )
    limits = stage.users.select("user_id", "current_plan_id").join(plans, "current_plan_id")
    daily = daily_usage(stage).withColumnRenamed("daily_data_mb", "total_usage_mb")
    running = month_to_date(daily).withColumn(
        "used_before", (F.col("month_to_date_usage_mb") - F.col("total_usage_mb")).cast("double")
    )
    allowance = F.coalesce("data_limit_gb", F.lit(0)).cast("double") * 1024.0
    limited = quota_stage(F.col("used_before"), allowance, thresholds)
    share = F.when(
        ~F.col("is_unlimited") & (allowance > 0), F.round(F.col("used_before") / allowance, 6)
    )
    return running.join(limits, "user_id").select(
        "user_id",
        "usage_date",
        "total_usage_mb",
        F.when(F.col("is_unlimited"), F.lit("NORMAL")).otherwise(limited).alias("quota_stage"),
        share.alias("quota_usage_ratio"),
    )


def rollover_allowances(stage: Tables) -> DataFrame:
    """Monthly allowance of users on limited rollover plans, with the unused part carried over."""
    return rollover_rows(rollover_users(stage), used_by_month(stage.content_usage))


#: Plans that are scored together.
PLAN_BLOCK = 512


def plan_fit(
    stage: Tables, traits: DataFrame, *, top: int,
    heavy_plan_names: Sequence[str] = (),
) -> DataFrame:
    """The `top` best-fitting plans of every user, best first.

    `traits` has (user_id, plan_spending_score, content_affinity). Plans are dealt into blocks of about
    PLAN_BLOCK; a user meets each block as one array, scores it in place and takes only its best plans on, so
    pairs are neither joined nor shuffled. A user without usage or traits counts as using and spending nothing.
    `heavy_plan_names` are the unlimited plans favoured by very heavy users.
    """
    bonus = F.struct("age_benefit_id", F.coalesce("bonus_data_gb", F.lit(0)))
    bonuses = stage.plan_age_benefits.groupBy("plan_id").agg(
        F.map_from_entries(F.collect_list(bonus)).alias("bonuses")
    )
    row = F.struct(
        "plan_id", "plan_name", "plan_family", "monthly_fee", "data_limit_gb", "is_unlimited", "is_rollover", "bonuses"
    )
    n_blocks = stage.plans.agg(F.ceil(F.count("*") / F.lit(PLAN_BLOCK)).alias("n")).scalar()
    blocks = (
        stage.plans.join(bonuses, "plan_id", "left")
        .groupBy(F.pmod(F.xxhash64("plan_id"), n_blocks).alias("_block"))
        .agg(F.collect_list(row).alias("_plans"))
    )
    age = F.col("age")
    mean = F.sum("daily_data_mb").cast("double") / F.count("*")
    need = daily_usage(stage).groupBy("user_id").agg((mean * 30.0 / 1024.0).alias("need_gb"))
    users = (
        with_age_benefit(stage.users.select("user_id", "age", "family_id"), stage)
        .withColumnRenamed("age_benefit_id", "benefit")
        .join(need, "user_id", "left")
        .join(traits.select("user_id", "plan_spending_score", "content_affinity"), "user_id", "left")
        .withColumns({
            "need_gb": F.coalesce("need_gb", F.lit(0.0)),
            "plan_spending_score": F.coalesce(F.col("plan_spending_score").cast("double"), F.lit(0.0)),
        })
    )
    need_gb, spending = F.col("need_gb"), F.col("plan_spending_score").cast("double")
    target = 30000.0 + 25000.0 * spending + F.least(F.lit(40000.0), need_gb * 300.0)

    def when(condition: Column, points: Column | float) -> Column:
        value = points if isinstance(points, Column) else F.lit(points)
        return F.when(condition, value).otherwise(F.lit(0.0))

    def score(plan: Column) -> Column:
        fee = plan["monthly_fee"].cast("double")
        extra = F.coalesce(
            F.try_element_at(plan["bonuses"], F.col("benefit")), F.lit(0)
        ).cast("double")
        cap = F.coalesce(plan["data_limit_gb"], F.lit(0)).cast("double") + extra
        unlimited = plan["is_unlimited"]
        used = need_gb / F.greatest(cap, F.lit(0.05))
        family = plan["plan_family"]
        choice = family.isin(*CHOICE_FAMILIES)
        distance = F.abs(F.log(F.greatest(fee, F.lit(1.0))) - F.log(F.greatest(target, F.lit(1.0))))
        data = F.when(
            unlimited,
            F.when(need_gb >= 80, F.lit(2.0)).when(need_gb >= 40, F.lit(0.8))
            .when(need_gb < 10, F.lit(-1.6)).otherwise(F.lit(0.0)),
        ).otherwise(
            F.when((used >= 0.55) & (used <= 1.15), F.lit(2.2))
            .when((used >= 0.25) & (used < 0.55), F.lit(0.9))
            .when((used > 1.15) & (used <= 1.50), F.lit(-0.4))
            .when(used > 1.50, F.lit(-2.2)).otherwise(F.lit(-0.8))
        )
        voice = when(
            family == "VOICE",
            F.when(
                unlimited | (need_gb <= F.greatest(cap, F.lit(0.6)) * 1.3), F.lit(1.2)
            ).otherwise(F.lit(-2.0)),
        )
        rollover = when(
            plan["is_rollover"] & (unlimited | (need_gb < F.greatest(cap, F.lit(1.0)))), 0.10
        )
        taste = when(
            choice,
            when((age >= 19) & (age <= 39), 0.30)
            + when(F.coalesce(F.col("content_affinity").isin("video", "music", "short_form"), F.lit(False)), 0.50)
            + 0.45 * spending,
        )
        double = when(
            family == "CHOICE_DOUBLE",
            F.when(spending >= 0.70, F.lit(0.15)).otherwise(F.lit(-0.15)),
        )
        heavy = when(plan["plan_name"].isin(*heavy_plan_names) & (need_gb > 90), 0.45)
        with_family = when(F.col("family_id").isNotNull() & (fee >= 77000), 0.12)
        return -2.6 * distance + data + voice + rollover + taste + double + heavy + with_family

    def best(scored: Column) -> Column:
        """The best `top` of an array of (negated score, plan)."""
        return F.slice(F.array_sort(scored), 1, top)

    # Scores that agree to nine digits are equal: the smaller plan_id comes first, whatever the order of additions.
    scored = F.transform(
        "_plans", lambda plan: F.struct((-F.round(score(plan), 9)).alias("worse"), plan["plan_id"].alias("plan_id"))
    )
    of_block = (
        users.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)))
        .join(blocks, "_block")
        .select("user_id", best(scored).alias("_best"))
    )
    of_user = of_block.groupBy("user_id").agg(best(F.flatten(F.collect_list("_best"))).alias("_best"))
    return of_user.select("user_id", F.posexplode("_best").alias("_at", "_own")).select(
        "user_id", (F.col("_at") + 1).alias("fit_rank"), F.col("_own.plan_id").alias("plan_id"),
        (-F.col("_own.worse")).alias("fit_score"),
    )


def case_flags(stage: Tables, *, low_share: float = 0.05) -> DataFrame:
    """Advisory flags of every user.

    A: heavy use on a small allowance. B: light use on a high fee. C: family without a bundle.
    D: video-heavy use outside the choice families. E: a chosen service whose content takes less than
    `low_share` of the user's usage.
    """
    usage = usage_features(stage).select("user_id", "monthly_estimated_data_gb")
    allowance = age_benefits(stage).select(
        "user_id", "effective_data_gb", "effective_data_unlimited"
    )
    families = family_features(stage).select("user_id", "eligible_for_family_bundle")
    plans = stage.plans.select(
        F.col("plan_id").alias("current_plan_id"),
        F.col("plan_family").isin(*CHOICE_FAMILIES).alias("is_choice"),
    )
    video = stage.content_usage.groupBy("user_id").agg(
        F.sum("data_usage_mb").alias("all_mb"),
        F.sum(F.when(F.col("content_category") == "video", F.col("data_usage_mb"))).alias("video_mb"),
    )
    underused = _underused_services(stage, low_share)
    gb = F.col("monthly_estimated_data_gb")
    video_share = F.coalesce(
        F.col("video_mb").cast("double") / F.nullif(F.col("all_mb"), F.lit(0)).cast("double"),
        F.lit(0.0),
    )
    choice = F.col("is_choice")

    def flag(condition: Column, name: str) -> Column:
        return F.coalesce(condition, F.lit(False)).alias(name)

    return (
        stage.users.select("user_id", "current_plan_id")
        .join(plans, "current_plan_id")
        .join(family_fees(stage), "user_id")
        .join(usage, "user_id", "left")
        .join(allowance, "user_id", "left")
        .join(families, "user_id", "left")
        .join(video, "user_id", "left")
        .join(underused, "user_id", "left")
        .select(
            "user_id",
            flag(
                (gb > 80) & ~F.col("effective_data_unlimited") & (F.col("effective_data_gb") <= 30),
                "case_a",
            ),
            flag((gb < 15) & (F.col("monthly_fee") >= HIGH_PLAN_FEE), "case_b"),
            flag(F.col("eligible_for_family_bundle"), "case_c"),
            flag((video_share >= 0.25) & (gb >= 30) & ~choice, "case_d"),
            flag(choice & F.col("underused"), "case_e"),
        )
    )


def _underused_services(stage: Tables, low_share: float) -> DataFrame:
    total = stage.content_usage.groupBy("user_id").agg(F.sum("data_usage_mb").alias("all_mb"))
    services = chosen_service_usage(stage).groupBy("user_id", "service_id").agg(
        F.coalesce(F.sum("usage_mb"), F.lit(0)).alias("service_mb")
    )
    small = F.col("service_mb").cast("double") < F.lit(low_share) * F.col("all_mb").cast("double")
    return services.join(total, "user_id").groupBy("user_id").agg(
        F.bool_or(small).alias("underused")
    )


def case_counts(flags: DataFrame) -> DataFrame:
    names = [column for column in flags.columns if column.startswith("case_")]
    return flags.agg(*[F.count_if(F.col(name)).alias(name) for name in names])
