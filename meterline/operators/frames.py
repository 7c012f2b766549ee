"""Calendar frames, dense grids and one-row context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_steps(first: Column, last: Column, step: str) -> Column:
    """Array of dates from first to last, empty when first lies after last, null on a null bound."""
    guarded = F.sequence(first, F.greatest(first, last), F.expr(f"interval {step}"))
    return F.filter(guarded, lambda day: day <= last)


def month_array(start: Column, end_exclusive: Column) -> Column:
    return date_steps(start, F.add_months(end_exclusive, -1), "1 month")


def month_frame(spark: SparkSession, start: str, end_exclusive: str) -> DataFrame:
    """One row per month, in one partition; no rows for an empty range."""
    months = month_array(F.lit(start).cast("date"), F.lit(end_exclusive).cast("date"))
    return spark.range(0, 1, 1, 1).select(F.explode(months).alias("calendar_month"))


def day_frame(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day between two columns of a one-row frame."""
    return bounds.select(F.explode(date_steps(first, last, "1 day")).alias("calendar_date"))


def per_month(df: DataFrame, start: str, end_exclusive: str) -> DataFrame:
    """Repeat each row for every month of the range."""
    months = month_array(F.lit(start).cast("date"), F.lit(end_exclusive).cast("date"))
    return df.withColumn("calendar_month", F.explode(months))


def with_groups(df: DataFrame, groups: Sequence[Column]) -> DataFrame:
    """Repeat each row for every struct of a fixed list, as columns of the struct."""
    return df.withColumn("_group", F.explode(F.array(*groups))).select("*", "_group.*").drop("_group")


def fill_grid(grid: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """Grid rows with what was found for them. Both sides hold one row per period and group.

    The keys compare null-safe, which leaves no not-null filter to push into the found side, so that
    plans it is built from stay shared.
    """
    renamed = found.select(
        *[F.col(key).alias("_" + key) for key in keys],
        *[column for column in found.columns if column not in keys],
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col("_" + key))
    return grid.join(F.broadcast(renamed), same, "left").drop(*["_" + key for key in keys])


def single_value(df: DataFrame, value: Column) -> Column:
    """Aggregate of a frame as a scalar that is computed once per query."""
    return df.agg(value.alias("value")).scalar()


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
