"""A whole load run through the store (S-02, S-04, S-06, I-01 to I-15): its tables and its records.

All days of recent usage are written as files; the store is initialized, loaded in two batches, corrected on one day,
and offered a day of unknown customers, which it rejects. The run is made once for each session and folder.
"""

from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from checks.q_layers import MB
from checks.q_refresh import daily_sql, monthly_sql, segment_sql
from checks.registry import SECRET, check, day_key, layer, month_of
from meterline.plans import loading, quality
from meterline.plans.tables import Tables
from meterline.schemas import MASTER_TABLES, SOURCE_SCHEMAS
from meterline.session import shared_folder
from meterline.sources import csv_tables
from meterline.sources.paths import join
from meterline.sources.store import Store

FIRST, BATCH = date(2024, 1, 1), 16
CORRECTED, VERSION = date(2024, 1, 10), "v2"

_RUNS: dict[tuple[str, str], Store] = {}

layer("l_raw", f"""
select content_usage_id, user_id, usage_date, content_category, content_detail,
 cast(data_usage_mb*1000 as bigint)*case when usage_date=date '{CORRECTED}' then 2 else 1 end as k
from recent_usage where not (usage_date=date '{CORRECTED}' and content_category='music')""")
layer("l_usage", f"""
select c.*, {day_key("c.usage_date")} as date_key, {month_of("c.usage_date")} as calendar_month,
 {day_key(month_of("c.usage_date"))} as month_key
from l_raw c, users u where u.user_id=c.user_id and c.usage_date>=u.subscription_start_date""")


def _loaded(c) -> Store:
    key = c.spark.sparkContext.applicationId, c.folder
    if key not in _RUNS:
        _RUNS[key] = _run(c)
    return _RUNS[key]


def _run(c) -> Store:
    base = join(shared_folder(c.spark), f"load-run-{uuid4().hex}")
    root, store = join(base, "days"), Store(c.spark, join(base, "store"))
    usage, day = c.recent.content_usage, F.col("usage_date")
    csv_tables.write_usage_partitions(usage, root)
    masters = Tables(**{name: c.stage[name] for name in MASTER_TABLES})
    loading.initialize(store, masters, secret=SECRET, reference_date=str(FIRST), checksum="masters")
    last = csv_tables.partition_days(c.spark, root)[-1]
    today = last + timedelta(1)
    loading.run_incremental(store, root, secret=SECRET, processing=today, max_days=BATCH)

    doubled = (F.col("data_usage_mb") * 2).cast("decimal(14,3)")
    again = usage.where((day == F.lit(CORRECTED)) & (F.col("content_category") != "music")).withColumn("data_usage_mb", doubled)
    again.write.option("header", True).csv(join(root, f"event_date={CORRECTED}", f"run_id={VERSION}"))
    loading.run_correction(store, root, CORRECTED, VERSION, secret=SECRET, processing=today)

    unknown = usage.where(day == F.lit(CORRECTED)).select(
        F.concat(F.lit("X"), "content_usage_id").alias("content_usage_id"), F.concat(F.lit("X"), "user_id").alias("user_id"),
        F.lit(today).alias("usage_date"), "content_category", "content_detail", "data_usage_mb",
    )
    unknown.write.option("header", True).csv(join(root, f"event_date={today}"))
    try:
        loading.run_incremental(store, root, secret=SECRET, processing=today + timedelta(1), max_days=BATCH)
    except quality.QualityError:
        return store
    raise AssertionError("unknown customers were loaded")


def _area(c, name: str):
    return loading.published_area(_loaded(c), name)


@check("s06_i12_loaded_detail", f"""
select content_usage_id, user_id, usage_date, content_category, content_detail, {MB} as data_usage_mb from l_usage""")
def _(c):
    return _area(c, "personalization").dw.content_usage.drop("source_batch_id")


@check("i12_loaded_customer_days", daily_sql("l_usage"))
def _(c):
    return _area(c, "personalization").mart.customer_daily_usage


@check("i12_loaded_customer_months", monthly_sql("l_usage"))
def _(c):
    return _area(c, "personalization").mart.customer_monthly_usage


@check("i12_loaded_monthly_segment", segment_sql("l_usage", "month_key"))
def _(c):
    return _area(c, "operations").mart.monthly_usage_segment


@check("i12_g05_loaded_month_bins", """
select month_key, k//1024000 as bin, count(*) as n, cast(sum(k) as double)/1000 as mb
from (select user_id, month_key, sum(k) as k from l_usage group by all) x group by all""")
def _(c):
    """The summary that medians and top shares are located by, as batches and the correction leave it."""
    return _area(c, "operations").mart.month_usage_bins


@check("i12_loaded_daily_segment", segment_sql("l_usage", "date_key"))
def _(c):
    return _area(c, "operations").mart.daily_usage_segment


@check("i01_i04_i06_load_runs", f"""
with d as (select min(usage_date) as lo, max(usage_date) as hi, cast(date '{FIRST}' as date) as f from recent_usage),
 n as (select usage_date, count(*) as n from recent_usage group by 1),
 b as (select case when usage_date<lo+{BATCH} then lo else lo+{BATCH} end as first, max(usage_date) as last, sum(n) as n
  from n, d group by 1)
select 'DATASET_INITIALIZATION' as run_type, 'SUCCEEDED' as status, cast(null as date) as event_date_from,
 cast(null as date) as event_date_to, cast(null as bigint) as days, cast(null as bigint) as source_rows
union all select 'INCREMENTAL', 'SUCCEEDED', first, last, date_diff('day', first, last)+1, cast(n as bigint) from b
union all select 'CORRECTION', 'SUCCEEDED', date '{CORRECTED}', date '{CORRECTED}', 1,
 (select count(*) from l_raw where usage_date=date '{CORRECTED}')
union all select 'INCREMENTAL', 'FAILED', cast(hi+1 as date), cast(hi+1 as date), null, null from d""")
def _(c):
    store = _loaded(c)
    files = store.source_files().groupBy("batch_id").agg(
        F.countDistinct("event_date").alias("days"), F.sum("row_count").alias("source_rows")
    )
    return store.runs().join(files, "batch_id", "left").select(
        "run_type", "status", "event_date_from", "event_date_to", "days", "source_rows"
    )


@check("s04_i13_watermark", """
select 'content_usage_daily' as pipeline_name, max(usage_date) as last_successful_event_date, 'INCREMENTAL' as run_type from recent_usage""")
def _(c):
    """Neither the correction nor the rejected day moves it."""
    store = _loaded(c)
    runs = store.runs().select(F.col("batch_id").alias("last_successful_batch_id"), "run_type")
    return store.watermarks().join(runs, "last_successful_batch_id").select(
        "pipeline_name", "last_successful_event_date", "run_type"
    )


@check("i15_rejected_batch", f"""
select 'QualityError' as problem, 'incremental_user_fk' as rule_name, count(*) as failed_rows
from recent_usage where usage_date=date '{CORRECTED}'""")
def _(c):
    message = F.col("error_message")
    return _loaded(c).runs().where("status='FAILED'").select(
        F.regexp_extract(message, r"^(\w+):", 1).alias("problem"), F.regexp_extract(message, r": (\w+): \d+$", 1).alias("rule_name"),
        F.regexp_extract(message, r"(\d+)$", 1).cast("bigint").alias("failed_rows"),
    )


@check("i03_i07_i14_requests", f"""
with d as (select max(usage_date) as hi from recent_usage)
select * from (values ('again', 'not loaded'), ('covered', 'not loaded'), ('eight days', 'a request holds 1 to 7 days'),
 ('today', 'only complete days can be loaded')) t(request, answer)
union all select 'gap', 'day '||cast(hi+1 as date)||' is missing' from d
union all select 'late correction', 'a correction must target a loaded day'
union all select 'next', 'the next day to load is '||cast(hi+1 as date) from d""")
def _(c):
    """What the load answers to requests that it must not carry out."""
    store = _loaded(c)
    root = store.root.removesuffix("store") + "days"
    last = store.watermark(loading.USAGE_PIPELINE)
    one, secret = timedelta(1), {"secret": SECRET}

    def hosted(first, to, today=last + 30 * one):
        return loading.load_requested_days(store, root, first, to, today=today, first_day=FIRST, **secret)

    requests = {
        "again": lambda: loading.load_days(
            store, root, csv_tables.partition_days(c.spark, root)[:BATCH], processing=last + one, **secret),
        "covered": lambda: hosted(last, last),
        "eight days": lambda: hosted(last + one, last + 8 * one),
        "today": lambda: hosted(last + one, last + one, last + one),
        "gap": lambda: loading.refresh.require_no_gap([last + 2 * one], last, last + 3 * one),
        "late correction": lambda: loading.run_correction(store, root, last + one, "v1", processing=last + 2 * one, **secret),
        "next": lambda: hosted(last + 2 * one, last + 3 * one),
    }
    rows = []
    for name, request in requests.items():
        try:
            rows.append((name, "loaded" if request() else "not loaded"))
        except loading.LoadRejected as problem:
            rows.append((name, str(problem)))
    return c.spark.createDataFrame(rows, "request string, answer string")


@check("s02_usage_file", """
select content_usage_id, user_id, usage_date, content_category, content_detail, cast(data_usage_mb as double) as data_usage_mb
from content_usage""")
def _(c):
    folder = join(shared_folder(c.spark), f"usage-{uuid4().hex}")
    c.stage.content_usage.write.option("header", True).csv(join(folder, "content_usage.csv"))
    return csv_tables.read_usage_full(c.spark, folder)


def _typed(name: str) -> str:
    kinds = {"DecimalType": "double", "IntegerType": "bigint", "ShortType": "bigint"}
    columns = [
        f"cast({f.name} as {kinds[k]}) as {f.name}" if (k := type(f.dataType).__name__) in kinds else f.name
        for f in SOURCE_SCHEMAS[name].fields
    ]
    return f"select {', '.join(columns)} from {name}"


for _name in ("users", "plans", "families", "user_services", "user_discounts", "bundle_discount_compositions"):
    @check(f"s01_master_{_name}", _typed(_name))
    def _(c, name=_name):
        """Typed values of a table as it is read back from its file."""
        folder = join(shared_folder(c.spark), f"master-{uuid4().hex}")
        c.stage[name].write.option("header", True).csv(join(folder, name + ".csv"))
        return csv_tables.read_csv(c.spark, join(folder, name + ".csv"), name)
