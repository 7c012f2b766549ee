"""Bundle discount policy as set-based jobs over families and lines.

Rules reach each row as a small array, so a lookup needs no shuffle; family figures are combinable
aggregates, so a family of any size is reduced before it meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.fixed_values import HIGHER_INTERNET_GROUP
from meterline.functions.measures import active_on
from meterline.operators.lookup import matching_rules, only_amount, with_amounts, with_rules
from meterline.plans.marts import day
from meterline.plans.tables import Tables

EXACT_WON = "decimal(20,8)"

TOTAL_POOL = ("D001", "TOTAL", "MOBILE_TOTAL_POOL")
FIXED_LINE = ("D002", "FIXED", "MOBILE_LINE")


def _amount(rules: str, **facts: Column) -> Column:
    """Amount of the rule that fits a row's internet group and contract term."""
    found = matching_rules(
        rules, F.col("internet_product_group"), F.col("internet_contract_months"), **facts
    )
    return only_amount(found, rules.strip("_"))


def premium_rule(stage: Tables, discount_id: str, column: str) -> Column:
    """One value of the single premium-family rule of a discount."""
    rule = stage.premium_family_discount_rules.where(F.col("discount_id") == discount_id)
    return rule.select(column).scalar()


def high_fee(stage: Tables) -> Column:
    return premium_rule(stage, "D003", "minimum_plan_fee")


def family_lines(stage: Tables) -> DataFrame:
    """Mobile lines of families with fee and network of the current plan."""
    plans = stage.plans.select(
        F.col("plan_id").alias("current_plan_id"), "monthly_fee", "network_type"
    )
    users = stage.users.where(F.col("family_id").isNotNull()).select(
        "user_id", "family_id", "age", "subscription_start_date", "current_plan_id"
    )
    return users.join(plans, "current_plan_id").drop("current_plan_id")


def line_counts(stage: Tables) -> DataFrame:
    """Families with their number of lines and of high-fee lines, zero without members."""
    counted = family_lines(stage).groupBy("family_id").agg(
        F.count("*").alias("mobile_lines"),
        F.count_if(F.col("monthly_fee") >= high_fee(stage)).alias("high_lines"),
    )
    return stage.families.join(counted, "family_id", "left").na.fill(
        0, ["mobile_lines", "high_lines"]
    )


def premium_eligible(stage: Tables) -> Column:
    """Condition on `line_counts` rows: enough high-fee lines, not too many lines, right internet."""
    return (
        (F.col("high_lines") >= premium_rule(stage, "D003", "minimum_high_line_count"))
        & (F.col("mobile_lines") <= premium_rule(stage, "D003", "maximum_mobile_line_count"))
        & F.coalesce(F.col("internet_product_group") == HIGHER_INTERNET_GROUP, F.lit(False))
    )


def bundle_types(stage: Tables) -> DataFrame:
    """Eligibility of every family and the bundle type that an enrolled family has by policy."""
    eligible = premium_eligible(stage)
    return line_counts(stage).select(
        "family_id",
        "mobile_lines",
        "high_lines",
        eligible.alias("premium_eligible"),
        F.when(
            F.col("has_bundle"),
            F.when(eligible, F.lit("PREMIUM_FAMILY")).otherwise(F.lit("INTERNET_MOBILE")),
        ).alias("policy_bundle_type"),
    )


def base_lines(stage: Tables) -> DataFrame:
    """Base line per family: a high-fee line if there is one, then lowest fee, oldest, earliest, id."""
    order = F.struct(
        (F.col("monthly_fee") < high_fee(stage)).alias("below"),
        "monthly_fee",
        (-F.col("age")).alias("oldest"),
        "subscription_start_date",
        "user_id",
    )
    return family_lines(stage).groupBy("family_id").agg(
        F.min(order)["user_id"].alias("base_user_id"),
        F.max("subscription_start_date").alias("bundle_start"),
    )


def counted_lines(stage: Tables, families: DataFrame) -> DataFrame:
    """Lines that enter the total or fixed discount of the given families (with `bundle_type`).

    A premium bundle counts its base line and the lines below the high fee; without enough high-fee
    lines it is skipped. Other families count every line.
    """
    premium = F.coalesce(F.col("bundle_type") == "PREMIUM_FAMILY", F.lit(False))
    counts = line_counts(stage).select("family_id", "high_lines")
    usable = (
        families.join(counts, "family_id")
        .where(
            ~premium
            | (F.col("high_lines") >= premium_rule(stage, "D003", "minimum_high_line_count"))
        )
        .join(base_lines(stage), "family_id")
    )
    return (
        family_lines(stage)
        .join(usable, "family_id")
        .where(
            ~premium
            | (F.col("user_id") == F.col("base_user_id"))
            | (F.col("monthly_fee") < high_fee(stage))
        )
    )


def method_savings(stage: Tables) -> DataFrame:
    """Saving of each family with active internet under the total and the fixed method."""
    rules = stage.internet_bundle_discount_rules
    families = stage.families.where(
        (F.col("internet_status") == "ACTIVE")
        & F.col("internet_product_group").isNotNull()
        & F.col("internet_contract_months").isNotNull()
    ).select("family_id", "bundle_type", "internet_product_group", "internet_contract_months")
    lines = with_amounts(
        counted_lines(stage, families), rules, fixed_line=(FIXED_LINE, "monthly_fee", "mobile_line_fee")
    )
    summed = lines.groupBy("family_id", "internet_product_group", "internet_contract_months").agg(
        F.sum("monthly_fee").alias("mobile_total"), F.sum("fixed_line").alias("fixed_mobile")
    )
    return with_amounts(
        summed,
        rules,
        total_pool=(TOTAL_POOL, "mobile_total", "mobile_total_fee"),
        total_internet=(("D005", "TOTAL", "INTERNET_BASE"), "mobile_total", "mobile_total_fee"),
        total_extra=(("D005", "TOTAL", "INTERNET_ADDITIONAL"), None, None),
        fixed_internet=(("D005", "FIXED", "INTERNET_BASE"), None, None),
        fixed_extra=(("D005", "FIXED", "INTERNET_ADDITIONAL"), None, None),
    ).select(
        "family_id",
        "mobile_total",
        (F.col("total_pool") + F.col("total_internet") + F.col("total_extra")).alias("total_saving"),
        (F.col("fixed_mobile") + F.col("fixed_internet") + F.col("fixed_extra")).alias("fixed_saving"),
    )


def preferred_methods(stage: Tables) -> DataFrame:
    """Method with the larger saving; equal savings prefer FIXED."""
    better = F.col("total_saving") > F.col("fixed_saving")
    return method_savings(stage).select(
        "family_id",
        F.when(better, F.lit("TOTAL")).otherwise(F.lit("FIXED")).alias("preferred_method"),
    )


def method_mismatch(stage: Tables) -> DataFrame:
    """Enrolled families on a method other than the preferred one."""
    enrolled = stage.families.where(F.col("has_bundle")).select(
        "family_id", "bundle_discount_method"
    )
    differs = ~F.coalesce(
        F.col("bundle_discount_method") == F.col("preferred_method"), F.lit(False)
    )
    count = F.count("*").cast("decimal(18,0)")
    worse = F.count_if(differs).cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return enrolled.join(preferred_methods(stage), "family_id", "left").agg(
        F.count("*").alias("enrolled_families"),
        F.count_if(~differs).alias("matching_families"),
        F.count_if(differs).alias("mismatched_families"),
        F.round(worse / F.nullif(count, F.lit(0).cast("decimal(1,0)")), 1).alias("mismatch_pct"),
    )


def enrolment_funnel(stage: Tables) -> DataFrame:
    """Family counts along eligibility, internet state and enrolment."""
    eligible = F.col("high_lines") >= premium_rule(stage, "D003", "minimum_high_line_count")
    active = F.coalesce(F.col("internet_status") == "ACTIVE", F.lit(False))
    bundled = F.col("has_bundle")
    kind = F.col("bundle_type")
    return line_counts(stage).agg(
        F.count_if(eligible).alias("eligible"),
        F.count_if(eligible & active & bundled).alias("eligible_active_enrolled"),
        F.count_if(eligible & active & ~bundled).alias("eligible_active_not_enrolled"),
        F.count_if(eligible & ~active).alias("eligible_inactive_internet"),
        F.count_if(bundled & (kind == "INTERNET_MOBILE")).alias("general_enrolled"),
        F.count_if(bundled & (kind == "PREMIUM_FAMILY")).alias("premium_enrolled"),
        F.count_if(bundled).alias("enrolled"),
    )


def current_discount_amounts(stage: Tables, reference_date: str) -> DataFrame:
    """Current monthly mobile discount of every user, zero without an entitlement.

    The total-method pool is looked up for the fee sum of its recipients and split equally or by
    fee; fixed amounts follow the line fee; the premium line gets a rate and the youth line a fixed
    amount. An entitlement that none of these covers, or without a family, fails the job.
    """
    rules = stage.internet_bundle_discount_rules
    families = stage.families.select(
        "family_id", "internet_product_group", "internet_contract_months",
        "total_discount_allocation_method",
    )
    owners = stage.bundle_discount_compositions.select("bundle_composition_id", "family_id")
    fees = family_fees(stage)
    active = (
        stage.user_discounts.where(active_on(day(reference_date)))
        .select("user_id", "bundle_composition_id", "discount_id")
        .join(owners, "bundle_composition_id", "left")
        .withColumn(
            "family_id",
            F.coalesce("family_id", F.raise_error(F.lit("entitlement without a bundle component"))),
        )
        .join(families, "family_id")
        .join(fees, "user_id")
    )
    pools = (
        active.where(F.col("discount_id") == "D001")
        .groupBy("family_id")
        .agg(F.sum("monthly_fee").alias("pool_fee"), F.count("*").alias("recipients"))
    )
    rows = with_rules(
        active.join(pools, "family_id", "left"), rules, _total_pool=TOTAL_POOL,
        _fixed_line=FIXED_LINE,
    )
    fee = F.col("monthly_fee").cast(EXACT_WON)
    pool = _amount("_total_pool", mobile_total=F.col("pool_fee"))
    method = F.col("total_discount_allocation_method")
    split = (
        F.when(method == "EQUAL", pool / F.col("recipients").cast("decimal(9,0)"))
        .when(method == "CONTRIBUTION", pool * F.col("monthly_fee") / F.col("pool_fee"))
        .otherwise(F.raise_error(F.lit("unknown allocation method")).cast(EXACT_WON))
    )
    fixed = _amount("_fixed_line", line_fee=F.col("monthly_fee"))
    kind = F.col("discount_id")
    amount = (
        F.when(kind == "D001", split.cast(EXACT_WON))
        .when(kind == "D002", fixed.cast(EXACT_WON))
        .when(kind == "D003", (fee * premium_rule(stage, "D003", "discount_rate")).cast(EXACT_WON))
        .when(kind == "D004", premium_rule(stage, "D004", "discount_amount").cast(EXACT_WON))
        .otherwise(F.raise_error(F.lit("entitlement without an amount")).cast(EXACT_WON))
    )
    summed = rows.select("user_id", amount.alias("amount")).groupBy("user_id").agg(
        F.sum("amount").alias("amount")
    )
    return stage.users.select("user_id").join(summed, "user_id", "left").select(
        "user_id",
        F.round(F.coalesce("amount", F.lit(0).cast(EXACT_WON)), 2).alias(
            "current_total_discount_amount"
        ),
    )


def family_fees(stage: Tables) -> DataFrame:
    """Monthly fee of every user's current plan."""
    plans = stage.plans.select(F.col("plan_id").alias("current_plan_id"), "monthly_fee")
    return stage.users.select("user_id", "current_plan_id").join(plans, "current_plan_id").select(
        "user_id", "monthly_fee"
    )


def family_features(stage: Tables) -> DataFrame:
    """Family size of every user and whether the family could still join a bundle."""
    sizes = (
        stage.users.where(F.col("family_id").isNotNull())
        .groupBy("family_id")
        .agg(F.count("*").alias("members"))
    )
    families = stage.families.join(sizes, "family_id").select(
        "family_id",
        "members",
        (
            F.coalesce(F.col("internet_status") == "ACTIVE", F.lit(False)) & ~F.col("has_bundle")
        ).alias("open_for_bundle"),
    )
    return stage.users.select("user_id", "family_id").join(families, "family_id", "left").select(
        "user_id",
        F.coalesce("members", F.lit(0)).alias("family_member_count"),
        F.coalesce("open_for_bundle", F.lit(False)).alias("eligible_for_family_bundle"),
    )


def _enrolled(stage: Tables) -> DataFrame:
    return stage.families.where(
        F.col("has_bundle") & F.col("internet_product_group").isNotNull()
    ).select(
        "family_id", "bundle_type", "bundle_discount_method", "internet_product_group",
        "internet_contract_months",
    )


def bundle_components(stage: Tables) -> DataFrame:
    """Composition of every enrolled family: one internet line and every mobile line with its role."""
    bundles = _enrolled(stage).select("family_id", "bundle_type").join(
        base_lines(stage), "family_id"
    )
    internet = bundles.select(
        F.concat_ws("-", "family_id", F.lit("INTERNET")).alias("bundle_composition_id"),
        "family_id",
        F.lit("INTERNET").alias("component_type"),
        F.lit(None).cast("string").alias("user_id"),
        F.lit("BASE_INTERNET").alias("component_role"),
        F.col("bundle_start").alias("start_date"),
    )
    role = (
        F.when(F.col("user_id") == F.col("base_user_id"), F.lit("BASE_MOBILE"))
        .when(
            (F.col("bundle_type") == "PREMIUM_FAMILY")
            & (F.col("monthly_fee") >= high_fee(stage)),
            F.lit("PREMIUM_MOBILE"),
        )
        .otherwise(F.lit("LOW_MOBILE"))
    )
    mobile = family_lines(stage).join(bundles, "family_id").select(
        F.concat_ws("-", "family_id", "user_id").alias("bundle_composition_id"),
        "family_id",
        F.lit("MOBILE").alias("component_type"),
        "user_id",
        role.alias("component_role"),
        F.col("bundle_start").alias("start_date"),
    )
    return internet.unionByName(mobile)


def mobile_entitlements(stage: Tables, reference_date: str, guardians: DataFrame) -> DataFrame:
    """Discounts each mobile line of an enrolled family is entitled to.

    Base and low lines get the total pool or the fixed line amount when that is positive, premium
    lines the rate. `guardians` lists the user ids of legal guardians; a young line of a premium
    bundle needs one in its family with the required fee and network.
    """
    rules = stage.internet_bundle_discount_rules
    lines = family_lines(stage)
    components = bundle_components(stage).where(F.col("component_type") == "MOBILE")
    fees = lines.select("user_id", "monthly_fee", "network_type", "age")
    counted = F.col("component_role").isin("BASE_MOBILE", "LOW_MOBILE")
    rows = components.join(fees, "user_id").join(_enrolled(stage), "family_id")
    totals = rows.where(counted).groupBy("family_id").agg(
        F.sum("monthly_fee").alias("pool_fee")
    )
    rows = with_rules(
        rows.join(totals, "family_id", "left"), rules, _total_pool=TOTAL_POOL,
        _fixed_line=FIXED_LINE,
    )
    pool = _amount("_total_pool", mobile_total=F.col("pool_fee"))
    fixed = _amount("_fixed_line", line_fee=F.col("monthly_fee"))
    total_method = F.col("bundle_discount_method") == "TOTAL"
    mobile = (
        F.when(~counted, F.lit("D003"))
        .when(total_method, F.when(pool > 0, F.lit("D001")))
        .otherwise(F.when(fixed > 0, F.lit("D002")))
    )
    youth = {
        name: premium_rule(stage, "D004", name)
        for name in (
            "minimum_plan_fee", "required_network_type", "guardian_minimum_plan_fee",
            "guardian_required_network_type", "enrollment_min_age", "enrollment_max_age",
            "benefit_end_age",
        )
    }
    guarded = (
        lines.join(guardians.select("user_id"), "user_id", "left_semi")
        .where(
            (F.col("monthly_fee") >= youth["guardian_minimum_plan_fee"])
            & (F.col("network_type") == youth["guardian_required_network_type"])
        )
        .select("family_id")
        .distinct()
        .withColumn("guarded", F.lit(True))
    )
    over = (F.col("age") - youth["enrollment_max_age"]).cast("int")
    enrolled_in_time = (over <= 0) | (
        F.col("start_date") <= F.add_months(day(reference_date), -12 * F.greatest(over, F.lit(0)))
    )
    young = (
        (F.col("bundle_type") == "PREMIUM_FAMILY")
        & F.coalesce("guarded", F.lit(False))
        & (F.col("age") >= youth["enrollment_min_age"])
        & (F.col("age") < youth["benefit_end_age"])
        & enrolled_in_time
        & (F.col("monthly_fee") >= youth["minimum_plan_fee"])
        & (F.col("network_type") == youth["required_network_type"])
    )
    kinds = F.array_compact(F.array(mobile, F.when(young, F.lit("D004"))))
    return rows.join(guarded, "family_id", "left").select(
        "user_id", "bundle_composition_id", F.explode(kinds).alias("discount_id"), "start_date"
    )


def internet_benefits(stage: Tables) -> DataFrame:
    """Internet benefit per family: one for an enrolled family, none per member."""
    return stage.families.select(
        "family_id",
        F.when(F.col("has_bundle"), F.lit("D005")).alias("internet_benefit_discount_id"),
    )
