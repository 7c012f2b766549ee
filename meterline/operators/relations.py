"""Joins, set comparisons and per-group picks used by the marts and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.measures import changed


def eligible_usage(usage: DataFrame, users: DataFrame, reference_date: str | None = None) -> DataFrame:
    """Usage from the subscription start on and, if given, before the reference date.

    The upper bound is a plain filter on the usage side, so that it reaches the scan.
    """
    if reference_date is not None:
        usage = usage.where(F.col("usage_date") < F.lit(reference_date).cast("date"))
    return usage.join(users, "user_id").where(
        F.col("usage_date") >= F.col("subscription_start_date")
    )


def orphans(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, optional: bool = False
) -> DataFrame:
    """Child rows whose key has no parent; a null key is one unless the reference is optional."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    if optional:
        child = child.where(F.col(key).isNotNull())
    return child.join(parents, key, "left_anti")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two frames has, one row per distinct difference."""
    right = right.select(*left.columns)
    return left.subtract(right).unionByName(right.subtract(left))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys missing on one side or with a differing value."""
    a = left.select(key, F.lit(True).alias("_in_left"), *[F.col(c).alias("l_" + c) for c in columns])
    b = right.select(key, F.lit(True).alias("_in_right"), *[F.col(c).alias("r_" + c) for c in columns])
    differs = F.col("_in_left").isNull() | F.col("_in_right").isNull()
    for column in columns:
        differs = differs | changed(F.col("l_" + column), F.col("r_" + column))
    return a.join(b, key, "full").where(differs)


def replace_range(current: DataFrame, rebuilt: DataFrame, key: str, first, last) -> DataFrame:
    """Rows of the range are taken from the rebuilt frame only, also where it has none."""
    kept = current.where(~F.col(key).between(first, last))
    return kept.unionByName(rebuilt.where(F.col(key).between(first, last)).select(*current.columns))


def add_missing(current: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-if-absent."""
    fresh = candidates.join(current.select(*keys), list(keys), "left_anti")
    return current.unionByName(fresh.select(*current.columns))


def first_per_group(df: DataFrame, group: str | Sequence[str], *order: Column) -> DataFrame:
    """The row of each group with the smallest ordering tuple.

    A minimum over a struct combines before the shuffle, so a group of any size is never sorted in
    one task. The ordering must be total for the pick to be repeatable.
    """
    keys = [group] if isinstance(group, str) else list(group)
    rank = [column.alias(f"_o{i}") for i, column in enumerate(order)]
    carried = [F.col(name) for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*carried), F.struct(*rank)).alias("_row"))
    return picked.select(*keys, "_row.*")


def value_distribution(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """(value, row_count, pct) with missing values as their own group."""
    counted = df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count("*").alias("row_count")
    )
    whole = df.agg(F.count("*").alias("n")).scalar().cast("decimal(18,0)")
    part = F.col("row_count").cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return counted.select(
        F.lit(column).alias("column_name"),
        "value",
        "row_count",
        F.round(part / whole, digits).alias("pct"),
    )


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Row counts by two attributes, one column per listed value."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)
