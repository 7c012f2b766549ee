"""Incremental loads and corrections: which days, which rebuild window, which rows change."""

from __future__ import annotations

import calendar
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import date_key, month_key
from meterline.functions.measures import CUSTOMER_MB, EXACT_MB
from meterline.operators.relations import add_missing, replace_range
from meterline.plans.area import Area
from meterline.plans.marts import (
    COUNTED, COUNTER, averaged_month, averaged_segment, dim_date, month_bins, month_to_date,
    month_totals, operations_mart, personalization_mart,
)
from meterline.plans.tables import Tables

INCREMENTAL, CORRECTION = "INCREMENTAL", "CORRECTION"
ONE_DAY = timedelta(days=1)


class LoadRejected(ValueError):
    """The requested days may not be loaded now."""


def business_today(now: datetime | None = None, zone: str = "Asia/Seoul") -> date:
    return (now or datetime.now(ZoneInfo("UTC"))).astimezone(ZoneInfo(zone)).date()


@dataclass(frozen=True)
class Window:
    """Days to replace and the last day that derived facts are rebuilt for."""

    run_type: str
    first: date
    last: date
    rebuild_to: date

    @property
    def month_first(self) -> date:
        return self.first.replace(day=1)


def month_end(value: date) -> date:
    return value.replace(day=calendar.monthrange(value.year, value.month)[1])


def days_between(first: date, last: date) -> list[date]:
    return [first + ONE_DAY * n for n in range((last - first).days + 1)]


def eligible_days(available: Iterable[date], watermark: date | None, processing: date) -> list[date]:
    """Listed days after the watermark and before the processing day."""
    return sorted(
        {d for d in available if d < processing and (watermark is None or d > watermark)}
    )


def require_no_gap(days: Sequence[date], watermark: date | None, processing: date) -> None:
    """Every day from the first expected one to the day before processing must be present."""
    cutoff = processing - ONE_DAY
    if not days:
        if watermark is not None and watermark >= cutoff:
            return
        raise LoadRejected(f"no eligible day up to {cutoff}")
    present = set(days)
    expected = days[0] if watermark is None else watermark + ONE_DAY
    for day in days_between(expected, cutoff):
        if day not in present:
            raise LoadRejected(f"day {day} is missing")


def batches(days: Sequence[date], size: int = 7) -> list[list[date]]:
    if not 1 <= size <= 31:
        raise LoadRejected("a batch holds 1 to 31 days")
    return [list(days[i : i + size]) for i in range(0, len(days), size)]


def check_request(
    run_type: str, first: date, last: date, *, watermark: date | None, cutoff: date,
    initialized: bool, first_day: date | None = None, max_days: int | None = None,
) -> None:
    """Preconditions of one batch."""
    if run_type not in (INCREMENTAL, CORRECTION):
        raise LoadRejected(f"unsupported run type {run_type}")
    if not initialized:
        raise LoadRejected("the dataset is not initialized")
    if last < first:
        raise LoadRejected("the range is empty")
    if max_days is not None and (last - first).days + 1 > max_days:
        raise LoadRejected(f"a request holds at most {max_days} days")
    if last > cutoff:
        raise LoadRejected(f"{last} lies after the cutoff {cutoff}")
    if first_day is not None and first < first_day:
        raise LoadRejected(f"usage starts at {first_day}")
    if run_type == CORRECTION:
        if watermark is None or last > watermark:
            raise LoadRejected("a correction must not go beyond the loaded days")
        return
    expected = watermark + ONE_DAY if watermark is not None else first_day
    if expected is not None and first != expected:
        raise LoadRejected(f"the next day to load is {expected}")


def already_covered(run_type: str, last: date, watermark: date | None) -> bool:
    """An incremental request for days that are loaded needs nothing; changes need a correction."""
    return run_type == INCREMENTAL and watermark is not None and last <= watermark


def rebuild_window(run_type: str, first: date, last: date, watermark: date | None) -> Window:
    """A correction also rebuilds later days of its month, whose running totals depend on it."""
    to = last
    if run_type == CORRECTION:
        to = min(month_end(last), watermark) if watermark else last
    return Window(run_type, first, last, to)


def _key(value: date) -> int:
    return value.year * 10000 + value.month * 100 + value.day


def replace_usage(current: DataFrame, rebuilt: DataFrame, window: Window) -> DataFrame:
    """Warehouse usage with the days of the window taken from the new rows only."""
    return replace_range(current, rebuilt, "usage_date", F.lit(window.first), F.lit(window.last))


DAILY_FACTS = {
    "operations": ["daily_usage_segment", "customer_daily_usage"],
    "personalization": ["customer_daily_usage"],
}
MONTHLY_FACTS = {
    "operations": [
        "monthly_usage_segment", "customer_monthly_category_usage", "customer_month_totals", "month_usage_bins",
    ],
    "personalization": ["customer_monthly_usage", "customer_monthly_content_usage"],
}
GROWING_DIMENSIONS = {
    "operations": {"dim_content_category": ["content_category"]},
    "personalization": {"dim_content": ["content_category", "content_detail"]},
}


def day_range(window: Window) -> tuple[int, int]:
    return _key(window.first), _key(window.rebuild_to)


def month_range(window: Window) -> tuple[int, int]:
    return _key(window.month_first), _key(window.rebuild_to.replace(day=1))


def _month_of(date_key_column) -> Column:
    return (F.floor(date_key_column / 100) * 100 + 1).cast("int")


def _inside(usage: DataFrame, window: Window) -> DataFrame:
    return usage.where(F.col("usage_date").between(F.lit(window.first), F.lit(window.last)))


def signed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, mb, n: what the window's days add to the month of each key, the old rows taken back and the new ones added."""
    def side(rows: DataFrame, sign: int) -> DataFrame:
        names = [F.col(k) if k != "month_key" else month_key(F.col("usage_date")).alias(k) for k in keys]
        return rows.select(*names, (F.col("data_usage_mb") * sign).cast(EXACT_MB).alias("mb"), F.lit(sign).cast("bigint").alias("n"))

    both = side(old, -1).unionByName(side(new, 1))
    return both.groupBy(*keys).agg(F.sum("mb").cast(EXACT_MB).alias("mb"), F.sum("n").alias("n"))


def after(fact: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, total, counter before and after, of every row of a counted fact that exists before or after the changes."""
    held = fact.select(*keys, F.col("total_usage_mb").cast(EXACT_MB).alias("mb"), F.col(COUNTER).alias("n"), F.col(COUNTER).alias("before"))
    both = held.unionByName(changes.select(*keys, "mb", "n", F.lit(0).cast("bigint").alias("before")))
    return both.groupBy(*keys).agg(
        F.sum("mb").cast(EXACT_MB).alias("total"), F.sum("before").alias("before"), F.sum("n").alias(COUNTER)
    )


def monthly_totals(fact: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A counted fact after the changes; a row ends when its counter does, whatever its total."""
    rows = after(fact, changes, keys).where(F.col(COUNTER) > 0)
    return rows.select(*keys, F.col("total").cast(CUSTOMER_MB).alias("total_usage_mb"), COUNTER)


def segments_after(segments: DataFrame, fact: DataFrame, changes: DataFrame, customers: DataFrame) -> DataFrame:
    """Monthly segments after the changes of their customers' months; a customer counts while they have a row."""
    keys = ["analysis_user_key", "month_key", "content_category"]
    touched = after(fact.join(changes.select(*keys), keys, "left_semi"), changes, keys)
    users = (F.col(COUNTER) > 0).cast("bigint") - (F.col("before") > 0).cast("bigint")
    moves = touched.withColumn("users", users).drop("total").join(changes.select(*keys, "mb"), keys).join(
        customers.select("analysis_user_key", "plan_id", "age_band"), "analysis_user_key"
    )
    names = ["month_key", "plan_id", "age_band", "content_category"]
    held = segments.select(*names, F.col("total_usage_mb").cast(EXACT_MB).alias("mb"), F.col("usage_user_count").cast("bigint").alias("users"))
    both = held.unionByName(moves.select(*names, "mb", "users")).groupBy(*names).agg(
        F.sum("mb").cast(EXACT_MB).alias("total"), F.sum("users").alias("users")
    )
    return averaged_segment(both.where(F.col("users") > 0), "month_key")


def customer_days(usage: DataFrame) -> DataFrame:
    return usage.groupBy("user_id", "usage_date").agg(F.sum("data_usage_mb").cast(EXACT_MB).alias("data_usage_mb"))


def running_after(daily: DataFrame, old: DataFrame, new: DataFrame, window: Window) -> DataFrame:
    """Rows of a customer's days from the window's first day to the last one that depends on it.

    Days of the window come from their new rows, on top of what the month held before; on later days of the same month the
    running total moves by what the window has changed. `old` and `new` are the window's customer days.
    """
    first, last = _key(window.first), _key(window.last)
    months = daily.where(F.col("date_key").between(_key(window.month_first), _key(window.rebuild_to)))
    months = months.withColumn("month_key", _month_of(F.col("date_key")))
    earlier = months.where(F.col("date_key") < first).groupBy("user_id", "month_key").agg(
        F.max("month_to_date_usage_mb").cast(EXACT_MB).alias("held")
    )
    inside = month_to_date(new.withColumnRenamed("data_usage_mb", "total_usage_mb")).select(
        "user_id", date_key(F.col("usage_date")).alias("date_key"), month_key(F.col("usage_date")).alias("month_key"),
        "total_usage_mb", F.col("month_to_date_usage_mb").alias("running"),
    )
    rows = inside.join(earlier, ["user_id", "month_key"], "left").select(
        "user_id", "date_key", F.col("total_usage_mb").cast(CUSTOMER_MB).alias("total_usage_mb"),
        (F.col("running") + F.coalesce("held", F.lit(0).cast(EXACT_MB))).cast(CUSTOMER_MB).alias("month_to_date_usage_mb"),
    )
    if window.rebuild_to == window.last:
        return rows
    moves = signed(old, new, ["user_id", "month_key"])
    later = months.where(F.col("date_key") > last).join(moves, ["user_id", "month_key"], "left").select(
        "user_id", "date_key", "total_usage_mb",
        (F.col("month_to_date_usage_mb") + F.coalesce("mb", F.lit(0).cast(EXACT_MB))).cast(CUSTOMER_MB).alias("month_to_date_usage_mb"),
    )
    return rows.unionByName(later)


def changed_facts(
    name: str, mart: Tables, old: DataFrame, dw: Tables, window: Window, reference_date: str,
    keep: Callable[[str, DataFrame], DataFrame] = lambda fact, rows: rows,
) -> dict[str, DataFrame]:
    """New rows of the facts for the window's days and months, by signed differences of its days.

    `mart` is the mart before, with counted facts; `old` the detail before, `dw` the warehouse after. Of the detail only the
    window's days are read; months are taken from the stored facts, whatever they were summed from. `keep` is given
    each fact and its rows once and returns them as they are to be read on: a load writes them, and builds the next on that.
    """
    before, now = _inside(old, window), _inside(dw.content_usage, window)
    in_months = F.col("month_key").between(*month_range(window))

    def month(fact: str) -> DataFrame:
        return mart[fact].where(in_months)

    if name == "operations":
        today = operations_mart(dw.replace(content_usage=now), reference_date=reference_date)
        today.settle("dim_customer", mart.dim_customer)
        keys = ["analysis_user_key", "month_key", "content_category"]
        fact, moves = COUNTED + "customer_monthly_category_usage", signed(before, now, keys)
        segments = segments_after(month("monthly_usage_segment"), month(fact), moves, mart.dim_customer)
        found = {
            "daily_usage_segment": keep("daily_usage_segment", today.daily_usage_segment),
            "customer_daily_usage": keep("customer_daily_usage", today.customer_daily_usage),
            fact: keep(fact, monthly_totals(month(fact), moves, keys)),
            "monthly_usage_segment": keep("monthly_usage_segment", segments),
        }
        found["customer_month_totals"] = keep("customer_month_totals", month_totals(found[fact]))
        found["month_usage_bins"] = keep("month_usage_bins", month_bins(found["customer_month_totals"]))
        return found
    keys = ["user_id", "month_key", "content_category", "content_detail"]
    content, months = COUNTED + "customer_monthly_content_usage", COUNTED + "customer_monthly_usage"
    old_days, new_days = customer_days(before), customer_days(now)
    totals = after(month(months), signed(old_days, new_days, ["user_id", "month_key"]), ["user_id", "month_key"])
    found = {
        "customer_daily_usage": running_after(mart.customer_daily_usage, old_days, new_days, window),
        content: monthly_totals(month(content), signed(before, now, keys), keys),
        months: averaged_month(totals.where(F.col(COUNTER) > 0)),
    }
    return {fact: keep(fact, rows) for fact, rows in found.items()}


def fact_range(fact: str, name: str, window: Window) -> tuple[int, int]:
    """Keys whose rows the changed fact replaces: of the operations days only those of the window change."""
    if fact not in DAILY_FACTS[name]:
        return month_range(window)
    return day_range(window) if name == "personalization" else (_key(window.first), _key(window.last))


def refreshed_mart(area: Area, dw: Tables, window: Window, reference_date: str) -> Tables:
    """Mart after the window is replaced; untouched days, months and customers keep their rows."""
    old = area.mart
    changed = {}
    for fact, rows in changed_facts(area.name, old, area.dw.content_usage, dw, window, reference_date).items():
        key = "date_key" if fact in DAILY_FACTS[area.name] else "month_key"
        changed[fact] = replace_range(old[fact], rows, key, *fact_range(fact, area.name, window))
        if fact.startswith(COUNTED):
            changed[fact.removeprefix(COUNTED)] = changed[fact].drop(COUNTER)
    inside = _inside(dw.content_usage, window)
    for table, keys in GROWING_DIMENSIONS[area.name].items():
        changed[table] = add_missing(old[table], inside.select(*keys).distinct(), keys)
    changed["dim_date"] = add_missing(old["dim_date"], dim_date(inside), ["date_key"])
    mart = old.replace(**changed)
    if area.name == "personalization":
        detail = personalization_mart(dw, reference_date=reference_date)
        detail.settle("dim_content", mart.dim_content)
        mart = mart.replace(
            customer_content_daily_usage=detail.customer_content_daily_usage,
            bridge_service_content=detail.bridge_service_content,
        )
    return mart


def apply_window(
    area: Area, rebuilt_usage: DataFrame, window: Window, reference_date: str
) -> Area:
    """The area after one batch, as a plan over the area before it."""
    usage = replace_usage(area.dw.content_usage, rebuilt_usage, window)
    dw = area.dw.replace(content_usage=usage)
    return Area(area.name, dw, refreshed_mart(area, dw, window, reference_date))


def missing_days(days: DataFrame, first: date, last: date) -> DataFrame:
    """Days of a range without any row in `days` (column usage_date)."""
    expected = days.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("usage_date")
    )
    return expected.join(days.select("usage_date").distinct(), "usage_date", "left_anti")
