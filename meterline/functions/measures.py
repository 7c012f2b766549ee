"""Quantities, ratios, bands and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.fixed_values import AGE_BANDS, SERVICE_DETAILS

# Stored precision of usage figures, in MB.
RAW_MB = "decimal(14,3)"
CUSTOMER_MB = "decimal(18,3)"
SEGMENT_MB = "decimal(20,3)"
# Widest operand that still leaves nine digits of scale after a division.
EXACT_MB = "decimal(26,3)"
COUNT = "decimal(18,0)"


def total_mb(usage: Column) -> Column:
    return F.sum(usage).cast(EXACT_MB)


def mb_to_gb(usage: Column, digits: int | None = None) -> Column:
    """1 GB is 1024 MB. Without digits the value is not rounded (double, exact divisor)."""
    if digits is None:
        return usage.cast("double") / F.lit(1024.0)
    return F.round(usage.cast(EXACT_MB) / F.lit(1024).cast("decimal(4,0)"), digits)


def ratio(part: Column, whole: Column) -> Column:
    """Division that yields null for a zero divisor."""
    return part / F.nullif(whole, F.lit(0).cast("decimal(1,0)"))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of two usage figures or counts, rounded half up."""
    hundredfold = part.cast(EXACT_MB) * F.lit(100).cast("decimal(3,0)")
    return F.round(ratio(hundredfold.cast("decimal(28,3)"), whole.cast("decimal(24,3)")), digits)


def age_band(age: Column, below: str | None = "65+", lowest: int = 8) -> Column:
    """Band label of an age.

    Ages under `lowest` and missing ages take `below`: the warehouse sends them to the open band,
    the analysis release uses `below=None, lowest=7`.
    """
    band = F.when(age.isNull() | (age < lowest), F.lit(below))
    for _, label, _, upper in AGE_BANDS[:-1]:
        band = band.when(age <= upper, F.lit(label))
    return band.otherwise(F.lit(AGE_BANDS[-1][1]))


def decade(age: Column) -> Column:
    """Ten-year group: 0-9, 10-19, ..., 70-79, 80+."""
    tens = F.floor(age / 10) * 10
    label = F.concat(tens.cast("string"), F.lit("-"), (tens + 9).cast("string"))
    return F.when(age >= 80, F.lit("80+")).otherwise(label)


def list_position(value: Column, order: Sequence[str]) -> Column:
    """Position of a value in a fixed order, null when it is not listed."""
    position = F.array_position(F.array(*[F.lit(item) for item in order]), value)
    return F.nullif(position, F.lit(0).cast("bigint"))


def age_band_position(band: Column) -> Column:
    return list_position(band, [label for _, label, _, _ in AGE_BANDS])


def service_of_detail(detail: Column, mapping: Sequence[tuple[str, str]] = SERVICE_DETAILS) -> Column:
    """Chosen service that a content detail counts towards, else null."""
    pairs = [F.lit(item) for service, name in mapping for item in (name, service)]
    return F.try_element_at(F.create_map(*pairs), detail)


def top_share_label(percent: Column) -> Column:
    return F.format_string("top_%d_pct", percent)


def active_on(reference: Column) -> Column:
    """Entitlement rows in force on a day."""
    return (
        (F.col("status") == "ACTIVE")
        & (F.col("start_date") <= reference)
        & (F.col("end_date").isNull() | (F.col("end_date") >= reference))
    )


def in_force(reference: Column, start: str, end: str) -> Column:
    """Rules in force on a day; open bounds are null."""
    return (F.col(start).isNull() | (F.col(start) <= reference)) & (
        F.col(end).isNull() | (F.col(end) >= reference)
    )


def changed(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)
