"""Joins of values with ranges, by equality on buckets of disjoint pieces.

Ranges that share a key are cut at all their bounds into pieces that do not overlap; a piece knows how many ranges
cover it and the sum of their amounts. So a value meets one piece at most, however many ranges there are, and the count
says whether exactly one range holds it. A piece is listed under each bucket of values that it touches. Buckets are as
many as a key has bounds on average, so pieces and buckets together stay within a small multiple of the ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pieces(ranges: DataFrame, keys: list[str], lower: str, upper: str, amount: str) -> DataFrame:
    """keys, n, total, and the piece [start, stop): start, start_after, stop, stop_after.

    Both bounds of a range belong to it and a missing one is open; a range whose bounds are reversed is empty. A point
    with `after` 1 lies just behind its value. The first piece may start, the last may stop at null: open.
    """
    real = ranges.where(F.col(lower).isNull() | F.col(upper).isNull() | (F.col(lower) <= F.col(upper)))
    begin = real.select(*keys, F.col(lower).alias("start"), F.lit(0).alias("start_after"), F.lit(1).alias("n"), F.col(amount).alias("total"))
    end = real.where(F.col(upper).isNotNull()).select(
        *keys, F.col(upper).alias("start"), F.lit(1).alias("start_after"), F.lit(-1).alias("n"), (-F.col(amount)).alias("total")
    )
    points = begin.unionByName(end).groupBy(*keys, "start", "start_after").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    order = Window.partitionBy(*keys).orderBy(F.col("start").asc_nulls_first(), "start_after")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.select(
        *keys, "start", "start_after", F.lead("start").over(order).alias("stop"), F.lead("start_after").over(order).alias("stop_after"),
        F.sum("n").over(so_far).alias("n"), F.sum("total").over(so_far).alias("total"),
    ).where("n > 0")


def bucketed(cut: DataFrame, keys: list[str]) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Pieces under each of their buckets (column bucket), and the bucket of a value; it never falls as values rise."""
    found = cut.agg(
        F.min("start").cast("double").alias("low"), F.greatest(F.max("start"), F.max("stop")).cast("double").alias("high"),
        F.count("*").alias("n"), F.countDistinct(*keys).alias("keys"),
    ).first()
    low, last = found["low"] or 0.0, -(-found["n"] // max(found["keys"], 1))
    width = ((found["high"] or 0.0) - low) / max(last, 1) or 1.0

    def bucket(value: Column) -> Column:
        place = F.least(F.greatest(F.floor((value.cast("double") - low) / width), F.lit(0)), F.lit(last))
        return F.when(value.isNotNull(), place.cast("long"))

    stop = F.when(F.col("stop").isNull(), F.lit(last)).otherwise(bucket(F.col("stop")))
    first = F.when(F.col("start").isNull(), F.lit(0)).otherwise(bucket(F.col("start")))
    return cut.withColumn("bucket", F.explode(F.sequence(first.cast("long"), stop.cast("long")))), bucket


def covering(
    df: DataFrame, ranges: DataFrame, on: dict[str, str], value: Column | None, lower: str, upper: str, amount: str, name: str
) -> DataFrame:
    """df with `<name>_n` ranges (0 if none) that hold value, and `<name>_total`, the sum of their amounts (0 if none).

    on maps columns of df to key columns of ranges. Without a value all ranges of the key count. A null value or key is
    held by no range. Rows of df are neither lost nor repeated.
    """
    keys = [f"{name}_key{k}" for k in range(len(on))]
    named = ranges.select(*[F.col(old).alias(new) for old, new in zip(on.values(), keys)], *dict.fromkeys([lower, upper, amount]))
    same = [F.col(mine) == F.col(key) for mine, key in zip(on, keys)]
    if value is None:
        found = named.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
    else:
        found, bucket = bucketed(pieces(named, keys, lower, upper, amount), keys)
        from_ = F.col(f"{name}_start").isNull() | (value > F.col(f"{name}_start")) | ((value == F.col(f"{name}_start")) & (F.col(f"{name}_start_after") == 0))
        to = F.col(f"{name}_stop").isNull() | (value < F.col(f"{name}_stop")) | ((value == F.col(f"{name}_stop")) & (F.col(f"{name}_stop_after") == 1))
        same += [bucket(value) == F.col(f"{name}_bucket"), from_, to]
    own = [c for c in found.columns if c not in keys]
    found = found.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in own])
    out = df.join(found, same, "left").drop(*keys, *[f"{name}_{c}" for c in own if c not in ("n", "total")])
    return out.withColumns({f"{name}_{c}": F.coalesce(f"{name}_{c}", F.lit(0)) for c in ("n", "total")})
