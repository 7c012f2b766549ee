"""One area as the reports see it: detail layer, mart and views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import date_key, day_of_key, month_key
from meterline.operators.frames import single_value
from meterline.plans.marts import operations_mart, personalization_mart
from meterline.plans.tables import Tables
from meterline.plans.views import operations_views, personalization_views
from meterline.plans.warehouse import operations_warehouse, personalization_warehouse

_MONTHLY = [
    "monthly_usage_segment", "customer_monthly_category_usage", "customer_monthly_usage",
    "customer_monthly_content_usage", "customer_month_totals", "month_usage_bins",
]


@dataclass(frozen=True)
class Area:
    name: str
    dw: Tables
    mart: Tables
    #: Whether the marts are read from files, so that small ones may be looked up before others are read.
    stored: bool = False

    @property
    def views(self) -> Tables:
        build = operations_views if self.name == "operations" else personalization_views
        return build(self.mart, self.dw)

    def during_months(self, first: Column, end_exclusive: Column) -> Area:
        """Same area with monthly facts limited by key, where the filter can prune partitions."""
        key = F.col("month_key")
        chosen = (key >= month_key(first)) & (key < month_key(end_exclusive))
        facts = {name: self.mart[name].where(chosen) for name in _MONTHLY if name in self.mart}
        return Area(self.name, self.dw, self.mart.replace(**facts), self.stored)

    def during_days(self, first: Column, last: Column) -> Area:
        """Same area with daily facts limited by day."""
        key = F.col("date_key")
        chosen = (key >= date_key(first)) & (key <= date_key(last))
        facts = {
            name: self.mart[name].where(chosen)
            for name in ("daily_usage_segment", "customer_daily_usage")
            if name in self.mart
        }
        if "customer_content_daily_usage" in self.mart:
            days = self.dw.content_usage.where(
                (F.col("usage_date") >= first) & (F.col("usage_date") <= last)
            )
            facts["customer_content_daily_usage"] = days.select(
                "user_id", date_key(F.col("usage_date")).alias("date_key"), "content_category",
                "content_detail", "data_usage_mb",
            )
        return Area(self.name, self.dw, self.mart.replace(**facts), self.stored)

    def latest_day(self) -> Column:
        """Last day with usage of any customer, computed once."""
        return single_value(
            self.mart.customer_daily_usage, day_of_key(F.max("date_key"))
        )


def of_customer(df: DataFrame, user_id: str | None) -> DataFrame:
    """Rows of one customer, or of all customers for a batch run."""
    return df if user_id is None else df.where(F.col("user_id") == user_id)


def operations_area(
    stage: Tables, *, secret: str, reference_date: str, batch_id: str = "adhoc"
) -> Area:
    dw = operations_warehouse(
        stage, secret=secret, reference_date=reference_date, batch_id=batch_id
    )
    return Area("operations", dw, operations_mart(dw, reference_date=reference_date))


def personalization_area(
    stage: Tables, *, reference_date: str, batch_id: str = "adhoc", **options
) -> Area:
    dw = personalization_warehouse(stage, reference_date=reference_date, batch_id=batch_id)
    return Area(
        "personalization", dw, personalization_mart(dw, reference_date=reference_date, **options)
    )
