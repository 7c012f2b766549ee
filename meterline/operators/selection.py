"""Exact order statistics without sorting a group in one task.

A coarse pass counts bins of a fixed width, which tasks sum before anything is shuffled, and locates the bin
that holds each wanted rank; a fine pass then shuffles only the rows inside those bins, as counts of equal values.
Usage is kept at three decimals, so a bin of 1,024 MB has at most 1,024,000 distinct values however many
customers fall into it, and one customer group of any size never meets in a single task.

Groups are months, categories or whole columns: a few thousand at most. One row per group and wanted rank
is broadcast to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.functions.measures import EXACT_MB
from meterline.operators.frames import literal_frame

BIN_MB = 1024


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n, bin) of each row; n is 1, since usage at three decimals is next to unique."""
    rows = df.select(group, F.col(value).alias("value"), F.lit(1).cast("bigint").alias("n"))
    return rows.withColumn("bin", bin_of(F.col("value")))


def bin_of(value: Column) -> Column:
    return F.floor(value / BIN_MB).cast("bigint")


def _mb(count: Column, value: Column) -> Column:
    return (count.cast("decimal(15,0)") * value.cast("decimal(22,3)")).cast("decimal(38,3)")


def summed_bins(counts: DataFrame, group: str) -> DataFrame:
    """(group, bin, n, mb): rows and usage of each bin. Bins of parts of a group add up to those of the whole."""
    return counts.groupBy(group, "bin").agg(
        F.sum("n").alias("n"), F.sum(_mb(F.col("n"), F.col("value"))).alias("mb")
    )


def ranked_bins(counts: DataFrame, group: str) -> DataFrame:
    return ranked(summed_bins(counts, group), group)


def ranked(bins: DataFrame, group: str) -> DataFrame:
    """(group, bin) with rows and usage of the bin, of the bins below it and of the group."""
    whole = W.partitionBy(group)
    upto = whole.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    return bins.select(
        group,
        "bin",
        "n",
        "mb",
        F.sum("n").over(upto).alias("n_upto"),
        (F.sum("mb").over(upto) - F.col("mb")).alias("mb_before"),
        F.sum("n").over(whole).alias("customers"),
        F.sum("mb").over(whole).cast(EXACT_MB).alias("total_mb"),
    ).withColumn("n_before", F.col("n_upto") - F.col("n"))


def wanted(target: str, rank: Column) -> Column:
    """A named rank, counted from the smallest value; may use the column `customers`."""
    return F.struct(F.lit(target).alias("target"), rank.cast("bigint").alias("rank"))


def values_at_ranks(
    counts: DataFrame, bins: DataFrame, group: str, ranks: Sequence[Column], kept: bool = False
) -> DataFrame:
    """(group, target) with the value at each wanted rank.

    `n_le` and `mb_le` are the rows and the usage up to and including all rows of that value. With `kept` bins, which are
    read and not counted, the wanted bins are looked up first (a row per group and rank), so that the scan
    of the rows can leave out what lies in others.
    """
    inside_bin = F.filter(
        F.array(*ranks),
        lambda t: (t["rank"] > F.col("n_before")) & (t["rank"] <= F.col("n_upto")),
    )
    located = bins.select(
        F.col(group).alias("_group"), F.col("bin").alias("_bin"), "n_before", "mb_before", "customers", "total_mb",
        F.inline(inside_bin).alias("target", "rank"),
    )
    if kept:
        rows = located.collect()
        located = literal_frame(counts.sparkSession, [tuple(row) for row in rows], located.schema.simpleString()[7:-1].replace(":", " "))
        counts = counts.where(F.col("bin").isin(sorted({row["_bin"] for row in rows})))
    within = W.partitionBy(group, "bin", "target").orderBy("value")
    # Null-safe on both keys: a missing group is a group too, and without a not-null filter on one
    # side both uses of the counts are the same exchange.
    same_bin = F.col(group).eqNullSafe(F.col("_group")) & F.col("bin").eqNullSafe(F.col("_bin"))
    inside = (
        counts.join(F.broadcast(located), same_bin)
        .groupBy(
            group, "bin", "target", "rank", "n_before", "mb_before", "customers", "total_mb", "value"
        )
        .agg(F.sum("n").alias("n"))
        .withColumn("n_le", F.col("n_before") + F.sum("n").over(within))
        .withColumn(
            "mb_le", F.col("mb_before") + F.sum(_mb(F.col("n"), F.col("value"))).over(within)
        )
    )
    hit = (F.col("rank") <= F.col("n_le")) & (F.col("rank") > F.col("n_le") - F.col("n"))
    return inside.where(hit).select(
        group, "target", "rank", "value", "n_le", "mb_le", "customers", "total_mb"
    )


def medians(counts: DataFrame, bins: DataFrame, group: str, kept: bool = False) -> DataFrame:
    """(group, customers, total_mb, median); an even count takes the mean of the two middle values."""
    half = F.floor(F.col("customers") / 2)
    lower = F.when(F.col("customers") % 2 == 0, half).otherwise(half + 1)
    middle = values_at_ranks(
        counts, bins, group, [wanted("low", lower), wanted("high", half + 1)], kept
    )
    return middle.groupBy(group).agg(
        F.max("customers").alias("customers"),
        F.max("total_mb").alias("total_mb"),
        (F.sum("value").cast(EXACT_MB) / F.lit(2).cast("decimal(1,0)")).alias("median"),
    )


def top_count(percent: int) -> Column:
    """ceil(customers * percent / 100) in decimal arithmetic."""
    share = F.col("customers").cast("decimal(18,0)") * F.lit(percent).cast("decimal(5,0)")
    return F.ceil(share / F.lit(100).cast("decimal(3,0)")).cast("bigint")


def top_shares(
    counts: DataFrame, bins: DataFrame, group: str, percents: dict[str, int], kept: bool = False
) -> DataFrame:
    """(group, target, top_customers, top_mb, customers, total_mb) of the highest rows by percentage.

    Rows of equal usage contribute equally, so which of them is cut does not change the totals.
    """
    cut = values_at_ranks(
        counts, bins, group,
        [wanted(name, F.col("customers") - top_count(p) + 1) for name, p in percents.items()],
        kept,
    )
    top = F.col("customers") - F.col("rank") + 1
    above = F.col("customers") - F.col("n_le")
    mb = F.col("total_mb") - F.col("mb_le") + _mb(top - above, F.col("value"))
    return cut.select(
        group, "target", top.alias("top_customers"), mb.cast(EXACT_MB).alias("top_mb"),
        "customers", "total_mb",
    )
