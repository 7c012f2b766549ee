"""Ingestion control and incremental rebuild (I-*), as plans over the area before the batch."""

from datetime import date

from pyspark.sql import functions as F

from checks.q_layers import MB
from checks.registry import SECRET, check, day_key, layer, month_of, rnd
from meterline.plans import refresh
from meterline.plans.area import Area, operations_area, personalization_area
from meterline.plans.quality import incremental_mart_rules, incremental_warehouse_rules
from meterline.plans.warehouse import operations_warehouse, personalization_warehouse
from meterline.sources.csv_tables import set_checksum

BASE = "2001-07-01"
NEW = (date(2001, 7, 1), date(2001, 7, 7))
CORRECTED = date(2001, 6, 10)
LAST = date(2001, 7, 7)


def _limited(stage, first, last, factor=1):
    usage = stage.content_usage.where(F.col("usage_date").between(F.lit(first), F.lit(last)))
    if factor != 1:
        usage = usage.withColumn(
            "data_usage_mb", (F.col("data_usage_mb") * factor).cast("decimal(14,3)")
        )
    return stage.replace(content_usage=usage)


def _base(c, name: str) -> Area:
    if name == "operations":
        return operations_area(c.stage, secret=SECRET, reference_date=BASE)
    return personalization_area(c.stage, reference_date=BASE)


def _rows(name: str, stage):
    if name == "operations":
        dw = operations_warehouse(stage, secret=SECRET, reference_date=None, batch_id="b2")
    else:
        dw = personalization_warehouse(stage, reference_date=None, batch_id="b2")
    return dw.content_usage


def _after_batch(c, name: str) -> Area:
    window = refresh.rebuild_window(refresh.INCREMENTAL, *NEW, date(2001, 6, 30))
    return refresh.apply_window(_base(c, name), _rows(name, _limited(c.stage, *NEW)), window, BASE)


def _after_correction(c, name: str) -> Area:
    """The day's usage comes again, doubled and without music; all of June is rebuilt from there."""
    window = refresh.rebuild_window(refresh.CORRECTION, CORRECTED, CORRECTED, LAST)
    again = _limited(c.stage, CORRECTED, CORRECTED, factor=2)
    again = again.replace(
        content_usage=again.content_usage.where(F.col("content_category") != "music")
    )
    return refresh.apply_window(_after_batch(c, name), _rows(name, again), window, BASE)


layer("n_usage", f"""
select user_id, usage_date, content_category, content_detail,
 {day_key("usage_date")} as date_key, {month_of("usage_date")} as calendar_month,
 {day_key(month_of("usage_date"))} as month_key,
 k from (select c.*, cast(c.data_usage_mb*1000 as bigint)*case when c.usage_date=date '{CORRECTED}' then 2 else 1 end as k
 from content_usage c, users u where u.user_id=c.user_id and c.usage_date>=u.subscription_start_date
 and c.usage_date<=date '{LAST}' and not (c.usage_date=date '{CORRECTED}' and c.content_category='music'))""")
layer("i_usage", f"""
select c.user_id, c.usage_date, c.content_category, c.content_detail,
 {day_key("c.usage_date")} as date_key, {month_of("c.usage_date")} as calendar_month,
 {day_key(month_of("c.usage_date"))} as month_key, cast(c.data_usage_mb*1000 as bigint) as k
from content_usage c, users u where u.user_id=c.user_id and c.usage_date>=u.subscription_start_date
 and c.usage_date<=date '{LAST}'""")


def daily_sql(source: str) -> str:
    return f"""
select user_id, date_key, cast(sum(k) as double)/1000 as total_usage_mb,
 cast(sum(sum(k)) over (partition by user_id, calendar_month order by date_key) as double)/1000
  as month_to_date_usage_mb from {source} group by user_id, date_key, calendar_month"""


def monthly_sql(source: str) -> str:
    return f"""
select user_id, month_key, cast(sum(k) as double)/1000 as total_usage_mb,
 {rnd("sum(k)", "count(distinct usage_date)*1000", 3)} as average_daily_usage_mb
from {source} group by user_id, month_key"""


def segment_sql(source: str, key: str) -> str:
    return f"""
select c.{key}, u.plan_id, u.age_band, c.content_category, cast(sum(c.k) as double)/1000 as total_usage_mb,
 count(distinct c.user_id) as usage_user_count,
 {rnd("sum(c.k)", "count(distinct c.user_id)*1000", 3)} as average_usage_mb
from {source} c, o_users u where u.user_id=c.user_id group by all"""


for _kind, _source, _build in (
    ("incremental", "i_usage", _after_batch), ("correction", "n_usage", _after_correction),
):
    @check(f"i09_{_kind}_usage", f"""
select user_id, usage_date, content_category, content_detail, {MB} as data_usage_mb from {_source}""")
    def _(c, build=_build):
        return build(c, "personalization").dw.content_usage.drop("source_batch_id", "content_usage_id")

    @check(f"i10_{_kind}_customer_daily", daily_sql(_source))
    def _(c, build=_build):
        return build(c, "personalization").mart.customer_daily_usage

    @check(f"i10_{_kind}_customer_monthly", monthly_sql(_source))
    def _(c, build=_build):
        return build(c, "personalization").mart.customer_monthly_usage

    @check(f"i10_{_kind}_monthly_content", f"""
select user_id, month_key, content_category, content_detail, cast(sum(k) as double)/1000 as total_usage_mb
from {_source} group by all""")
    def _(c, build=_build):
        return build(c, "personalization").mart.customer_monthly_content_usage

    @check(f"i10_{_kind}_daily_segment", segment_sql(_source, "date_key"))
    def _(c, build=_build):
        return build(c, "operations").mart.daily_usage_segment

    @check(f"i10_{_kind}_monthly_segment", segment_sql(_source, "month_key"))
    def _(c, build=_build):
        return build(c, "operations").mart.monthly_usage_segment

    @check(f"i10_{_kind}_monthly_category", f"""
select u.analysis_user_key, c.month_key, c.content_category, cast(sum(k) as double)/1000 as total_usage_mb
from {_source} c, o_users u where u.user_id=c.user_id group by all""")
    def _(c, build=_build):
        return build(c, "operations").mart.customer_monthly_category_usage


@check("i02_source_set_checksum", """
select sha256('INCREMENTAL'||chr(10)||string_agg(cast(d as varchar)||'|'||cast(n as varchar), chr(10) order by d))
 as checksum from (select usage_date as d, count(*) as n from content_usage group by 1)""")
def _(c):
    entries = c.stage.content_usage.groupBy("usage_date").agg(F.count("*").alias("n"))
    line = F.concat_ws("|", F.col("usage_date").cast("string"), F.col("n").cast("string"))
    checksum = set_checksum(entries, line, "usage_date", heading="INCREMENTAL")
    return c.spark.createDataFrame([(checksum,)], "checksum string")


@check("i05_missing_days", """
with d as (select cast(unnest(generate_series(timestamp '1994-01-01', timestamp '2002-12-31', interval 1 day)) as date) as usage_date)
select usage_date from d where not exists (select 1 from content_usage c where c.usage_date=d.usage_date)""")
def _(c):
    return refresh.missing_days(c.stage.content_usage, date(1994, 1, 1), date(2002, 12, 31))


@check("i11_grown_dimensions", """
select 'date' as dimension, cast(date_key as varchar) as member from (
 select cast(strftime(x,'%Y%m%d') as bigint) as date_key from (
  select cast(unnest(generate_series(date_trunc('month',min(usage_date)), cast(max(usage_date) as timestamp), interval 1 day)) as date) as x
  from i_usage))
union all select distinct 'category', content_category from i_usage""")
def _(c):
    mart = _after_batch(c, "operations").mart
    dates = mart.dim_date.select(F.lit("date").alias("dimension"), F.col("date_key").cast("string").alias("member"))
    return dates.unionByName(
        mart.dim_content_category.select(
            F.lit("category").alias("dimension"), F.col("content_category").alias("member")
        )
    )


@check("q15_incremental_rules", """
select rule_name, cast(0 as bigint) as failed_rows from (values
 ('operations_dw_incremental_total'),('operations_dw_incremental_pre_subscription_usage'),
 ('operations_dw_incremental_grain'),('operations_dm_incremental_daily_total'),
 ('operations_dm_incremental_monthly_total'),('personalization_dw_incremental_total'),
 ('personalization_dw_incremental_pre_subscription_usage'),('personalization_dw_incremental_rows'),
 ('personalization_dw_incremental_grain'),('personalization_dm_incremental_daily_total'),
 ('personalization_dm_incremental_monthly_total')) t(rule_name)""")
def _(c):
    staged = _limited(c.stage, *NEW).content_usage
    first, last = (d.isoformat() for d in NEW)
    result = None
    for name, key in (("operations", "analysis_user_key"), ("personalization", "user_id")):
        area = _after_batch(c, name)
        rules = incremental_warehouse_rules(
            area.dw, staged, c.stage.users, key, first, last, name
        ).unionByName(incremental_mart_rules(area.mart, area.dw, first, last, name))
        result = rules if result is None else result.unionByName(rules)
    return result
