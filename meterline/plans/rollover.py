"""Unused allowance carried from month to month, as states that a load continues.

A month turns what is carried into it into what is carried out of it: carry + (base - used), held between nothing and
the base allowance. Months in a row combine into a map of the same form, whatever the grouping, so a span of months is
one row for each user, and a load needs the last state and the new months only, not the months before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import month_start
from meterline.functions.measures import EXACT_MB
from meterline.plans.tables import Tables


def month_range(first: str, last: str) -> Column:
    return F.sequence(first, last, F.expr("interval 1 month"))


def rollover_users(stage: Tables) -> DataFrame:
    """user_id and base_mb of users on limited rollover plans."""
    plans = stage.plans.where(F.col("is_rollover") & ~F.col("is_unlimited")).select(
        F.col("plan_id").alias("current_plan_id"),
        (F.coalesce("data_limit_gb", F.lit(0)) * F.lit(1024)).cast(EXACT_MB).alias("base_mb"),
    )
    return stage.users.select("user_id", "current_plan_id").join(plans, "current_plan_id").select("user_id", "base_mb")


def used_by_month(usage: DataFrame) -> DataFrame:
    """user_id, month and used_mb of the months with usage."""
    return usage.groupBy("user_id", month_start(F.col("usage_date")).alias("month")).agg(
        F.sum("data_usage_mb").cast(EXACT_MB).alias("used_mb")
    )


# --- maps of months ---------------------------------------------------------------------------------------


def carry_map(shift: Column, least: Column, most: Column) -> Column:
    named = {"shift": shift, "least": least, "most": most}
    return F.struct(*[value.cast(EXACT_MB).alias(name) for name, value in named.items()])


def month_map(base: Column, used: Column) -> Column:
    return carry_map(base - used, F.lit(0), base)


def unused_months(base: Column) -> Column:
    """One or more months without usage: whatever was carried, the base is carried on."""
    return carry_map(F.lit(0), base, base)


def carried_out(months: Column, carry: Column) -> Column:
    """What is carried out of months when carry is carried into them."""
    return F.least(F.greatest((carry + months["shift"]).cast(EXACT_MB), months["least"]), months["most"])


def combined(first: Column, then: Column) -> Column:
    """The map of first and then one after the other."""
    return carry_map(
        first["shift"] + then["shift"], carried_out(then, first["least"]), carried_out(then, first["most"])
    )


def span_maps(users: DataFrame, months: DataFrame) -> DataFrame:
    """user_id, base_mb, first, last and map of all months between a user's first and last month with usage."""
    used = F.map_from_entries(F.collect_list(F.struct("month", "used_mb"))).alias("_used")
    spans = users.join(
        months.groupBy("user_id").agg(used, F.min("month").alias("first"), F.max("month").alias("last")), "user_id"
    )

    def one(month: Column) -> Column:
        return month_map(F.col("base_mb"), F.coalesce(F.try_element_at("_used", month), F.lit(0).cast(EXACT_MB)))

    later = F.filter(month_range("first", "last"), lambda month: month > F.col("first"))
    whole = F.aggregate(later, one(F.col("first")), lambda done, month: combined(done, one(month)))
    return spans.select("user_id", "base_mb", "first", "last", whole.alias("map"))


def joined_spans(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Spans of two sets of months, all of one before all of the other, as one span for each user.

    Months without usage between them count; a user that only one side has keeps its span.
    """
    sides = [df.select("user_id", F.struct("base_mb", "first", "last", "map").alias(n)) for df, n in ((earlier, "a"), (later, "b"))]
    a, b = F.col("a"), F.col("b")
    adjacent = F.add_months(a["last"], 1) >= b["first"]
    before = F.when(adjacent, a["map"]).otherwise(combined(a["map"], unused_months(a["base_mb"])))
    whole = F.when(a.isNull(), b["map"]).when(b.isNull(), a["map"]).otherwise(combined(before, b["map"]))
    return sides[0].join(sides[1], "user_id", "full").select(
        "user_id",
        F.coalesce(b["base_mb"], a["base_mb"]).alias("base_mb"),
        F.coalesce(a["first"], b["first"]).alias("first"),
        F.coalesce(b["last"], a["last"]).alias("last"),
        whole.alias("map"),
    )


# --- months with what they carry ---------------------------------------------------------------------------


def rollover_rows(users: DataFrame, months: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """user_id, usage_month, carryover_mb, allowance_mb and used_mb of a user's months in order.

    What is left of one month, at most the base allowance, adds to the next. Months without usage between the first
    and the last are filled in. With states, a user that has one goes on from the month after it; months up to it are
    left out, and the months between it and the first new one are filled in. A null month of usage is no month.
    """
    months = months.where(F.col("month").isNotNull())
    if states is None:
        begun = users.withColumns({"_after": F.lit(None).cast("date"), "_carry": F.lit(None).cast(EXACT_MB)})
    else:
        known = states.select("user_id", F.col("month").alias("_after"), F.col("carry_mb").alias("_carry"))
        begun = users.join(known, "user_id", "left")
    per_user = months.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("month", "used_mb"))).alias("_used"),
        F.min("month").alias("_first"),
        F.max("month").alias("_last"),
    )
    first = F.coalesce(F.add_months("_after", 1), "_first")
    open_users = begun.join(per_user, "user_id").withColumn("_first", first).where(F.col("_first") <= F.col("_last"))
    row_type = "array<struct<month:date,carry:decimal(26,3),allowance:decimal(26,3),used:decimal(26,3)>>"
    start = F.struct(
        F.coalesce("_carry", F.lit(0)).cast(EXACT_MB).alias("carry"), F.array().cast(row_type).alias("rows")
    )

    def step(state: Column, month: Column) -> Column:
        used = F.coalesce(F.try_element_at("_used", month), F.lit(0).cast(EXACT_MB))
        allowance = (F.col("base_mb") + state["carry"]).cast(EXACT_MB)
        row = F.struct(
            month.alias("month"), state["carry"].alias("carry"), allowance.alias("allowance"), used.alias("used")
        )
        return F.struct(
            carried_out(month_map(F.col("base_mb"), used), state["carry"]).alias("carry"),
            F.concat(state["rows"], F.array(row)).alias("rows"),
        )

    rows = F.aggregate(month_range("_first", "_last"), start, step)["rows"]
    return open_users.select("user_id", F.explode(rows).alias("r")).select(
        "user_id",
        F.col("r.month").alias("usage_month"),
        F.col("r.carry").alias("carryover_mb"),
        F.col("r.allowance").alias("allowance_mb"),
        F.col("r.used").alias("used_mb"),
    )


def states_of(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """user_id, month and carry_mb after the last month of each user; users without rows keep the state before.

    Rows of an earlier time give the state of that time, from which a corrected month starts again.
    """
    base = F.col("allowance_mb") - F.col("carryover_mb")
    out = carried_out(month_map(base, F.col("used_mb")), F.col("carryover_mb"))
    states = rows.select("user_id", F.col("usage_month").alias("month"), out.alias("carry_mb"))
    if before is not None:
        states = states.unionByName(before.select("user_id", "month", "carry_mb"))
    return states.groupBy("user_id").agg(F.max("month").alias("month"), F.max_by("carry_mb", "month").alias("carry_mb"))
