"""Scalar functions, joins, aggregates, windows and sources (F-*, J-*, G-*, W-*, O-*, U-*, S-*)."""

from uuid import uuid4

from pyspark.sql import functions as F

from checks.fixtures import SOURCE_NAMES
from checks.q_layers import USER_KEY
from checks.registry import BAND_SQL, REFERENCE, SECRET, check, key_sql, layer, rnd
from meterline import fixed_values as fixed
from meterline.functions import calendar, keys, measures
from meterline.operators import fingerprints, frames, relations
from meterline.plans import profiling
from meterline.plans.marts import day
from meterline.plans.warehouse import public_master
from meterline.schemas import MASTER_TABLES
from meterline.session import shared_folder
from meterline.sources import csv_tables
from meterline.sources.analysis_release import analysis_release, row_counts, write_analysis_release
from meterline.sources.paths import join


@check("f01_pseudonyms", f"""
select user_id, {USER_KEY} as user_key, {key_sql("family", "AFAM_", "family_id")} as family_key,
 {key_sql("user", "AUSR_", "name")} as name_key from users""")
def _(c):
    return c.stage.users.select(
        "user_id",
        keys.analysis_key("user", F.col("user_id"), SECRET).alias("user_key"),
        keys.analysis_key("family", F.col("family_id"), SECRET).alias("family_key"),
        keys.analysis_key("user", F.col("name"), SECRET).alias("name_key"),
    )


@check("f03_age_bands", f"""
with a as (select user_id, age-10 as age from users)
select user_id, {BAND_SQL} as warehouse_band, case when age<7 then null when age<=12 then '8-12'
 when age<=18 then '13-18' when age<=24 then '19-24' when age<=34 then '25-34'
 when age<=49 then '35-49' when age<=64 then '50-64' else '65+' end as release_band from a""")
def _(c):
    younger = F.col("age") - 10
    return c.stage.users.select(
        "user_id",
        measures.age_band(younger).alias("warehouse_band"),
        measures.age_band(younger, below=None, lowest=7).alias("release_band"),
    )


@check("f04_f07_calendar", f"""
select distinct usage_date, strftime(usage_date,'%Y-%m') as cohort,
 (2001-year(usage_date))*12+9-month(usage_date) as tenure,
 cast(strftime(usage_date,'%Y%m%d') as bigint) as date_key,
 cast(strftime(usage_date,'%Y%m') as bigint)*100+1 as month_key,
 cast(date_trunc('month',usage_date) as date) as month_start, quarter(usage_date) as quarter_no,
 isodow(usage_date) as weekday, isodow(usage_date)>5 as weekend from content_usage""")
def _(c):
    date = F.col("usage_date")
    return c.stage.content_usage.select("usage_date").distinct().select(
        "usage_date",
        calendar.month_cohort(date).alias("cohort"),
        calendar.tenure_months(date, day(REFERENCE)).alias("tenure"),
        calendar.date_key(date).alias("date_key"),
        calendar.month_key(date).alias("month_key"),
        calendar.month_start(date).alias("month_start"),
        F.quarter(date).alias("quarter_no"),
        (F.weekday(date) + 1).alias("weekday"),
        (F.weekday(date) + 1 >= 6).alias("weekend"),
    )


@check("f08_f09_gb_and_ratio", f"""
with u as (select user_id, sum(cast(data_usage_mb*1000 as bigint)) as k,
 sum(cast(data_usage_mb*1000 as bigint)) filter (where content_category='video') as v
 from content_usage group by 1)
select user_id, {rnd("k", "1024000", 2)} as gb2, {rnd("k", "1024000", 1)} as gb1,
 {rnd("k", "1024000", 0)} as gb0, {rnd("coalesce(v,0)*100", "k", 2)} as video_pct from u""")
def _(c):
    video = F.when(F.col("content_category") == "video", F.col("data_usage_mb"))
    usage = c.stage.content_usage.groupBy("user_id").agg(
        measures.total_mb(F.col("data_usage_mb")).alias("mb"),
        F.coalesce(F.sum(video), F.lit(0)).alias("video"),
    )
    return usage.select(
        "user_id",
        measures.mb_to_gb(F.col("mb"), 2).alias("gb2"),
        measures.mb_to_gb(F.col("mb"), 1).alias("gb1"),
        measures.mb_to_gb(F.col("mb"), 0).alias("gb0"),
        measures.share_pct(F.col("video"), F.col("mb")).alias("video_pct"),
    )


@check("f11_key_format", f"""
select count(*) filter (where not regexp_matches({USER_KEY},'^AUSR_[0-9A-F]{{24}}$')) as bad_keys,
 count(*) as users from users""")
def _(c):
    bad = ~F.col("analysis_user_key").rlike(keys.key_pattern("user"))
    return c.ops.dw.users.agg(F.count_if(bad).alias("bad_keys"), F.count("*").alias("users"))


@check("f12_f13_order_and_labels", f"""
select user_id, list_position(['8-12','13-18','19-24','25-34','35-49','50-64','65+'],{BAND_SQL})::bigint
 as band_position, 'top_'||cast(age as varchar)||'_pct' as label,
 cast(strftime(subscription_start_date,'%Y-%m')||'-01' as date) as cohort_day from users""")
def _(c):
    cohort = calendar.month_cohort(F.col("subscription_start_date"))
    return c.stage.users.select(
        "user_id",
        measures.age_band_position(measures.age_band(F.col("age"))).alias("band_position"),
        measures.top_share_label(F.col("age")).alias("label"),
        calendar.month_of_text(cohort).alias("cohort_day"),
    )


@check("f15_service_of_detail", """
select c.content_detail, b.service_id, count(*) as usage_rows
from content_usage c left join bridge b on b.content_detail=c.content_detail group by all""")
def _(c):
    service = measures.service_of_detail(F.col("content_detail")).alias("service_id")
    return c.stage.content_usage.groupBy("content_detail", service).agg(
        F.count("*").alias("usage_rows")
    )


@check("f16_eligible_usage", f"""
select c.content_category, count(*) as eligible_rows,
 count(*) filter (where c.usage_date<date '{REFERENCE}') as snapshot_rows,
 cast(sum(cast(c.data_usage_mb*1000 as bigint)) as double)/1000 as eligible_mb
from content_usage c, users u where u.user_id=c.user_id and c.usage_date>=u.subscription_start_date
group by 1""")
def _(c):
    users = c.stage.users.select("user_id", "subscription_start_date")
    usage = relations.eligible_usage(c.stage.content_usage, users)
    return usage.groupBy("content_category").agg(
        F.count("*").alias("eligible_rows"),
        F.count_if(F.col("usage_date") < day(REFERENCE)).alias("snapshot_rows"),
        F.sum("data_usage_mb").alias("eligible_mb"),
    )


@check("f17_active_entitlements", f"""
select user_discount_id from user_discounts where status='ACTIVE' and start_date<=date '{REFERENCE}'
 and (end_date is null or end_date>=date '{REFERENCE}')""")
def _(c):
    return c.stage.user_discounts.where(measures.active_on(day(REFERENCE))).select("user_discount_id")


@check("f18_business_days", """
select cast(ts + interval 9 hour as date) as local_day,
 cast(ts + interval 9 hour as date)-1 as complete_day, count(*) as event_count
from events group by all""")
def _(c):
    instant = F.col("ts").cast("timestamp")
    events = c.spark.read.parquet(f"{c.folder}/events.parquet")
    return events.groupBy(
        calendar.local_day(instant).alias("local_day"),
        calendar.last_complete_day(instant).alias("complete_day"),
    ).agg(F.count("*").alias("event_count"))


# --- joins, sets, grids ------------------------------------------------------------------------------


@check("j03_reconcile_months", """
with a as (select calendar_month, count(*) as n from p_usage group by 1),
 b as (select cast(date_trunc('month',usage_date) as date) as calendar_month, count(*) as n
  from content_usage group by 1)
select coalesce(a.calendar_month,b.calendar_month) as calendar_month, a.n as l_n, b.n as r_n
from a full join b on a.calendar_month=b.calendar_month where a.n is distinct from b.n""")
def _(c):
    def monthly(df):
        month = calendar.month_start(F.col("usage_date")).alias("calendar_month")
        return df.groupBy(month).agg(F.count("*").alias("n"))

    return relations.reconcile(
        monthly(c.pers.dw.content_usage), monthly(c.stage.content_usage), "calendar_month", ["n"]
    ).select("calendar_month", "l_n", "r_n")


@check("j04_share_of_latest_day", """
select user_id, cast(k as double)/1000 as total_usage_mb from r_daily
where usage_date=(select max(usage_date) from r_daily)""")
def _(c):
    area = c.now
    latest = area.latest_day()
    return area.mart.customer_daily_usage.where(
        F.col("date_key") == calendar.date_key(latest)
    ).select("user_id", "total_usage_mb")


@check("j09_orphan_usage", """
select content_usage_id from recent_usage r
where not exists (select 1 from user_services s where s.user_id=r.user_id)""")
def _(c):
    return relations.orphans(c.recent.content_usage, c.stage.user_services, "user_id", optional=True).select(
        "content_usage_id"
    )


@check("j10_users_with_recent_usage", """
select user_id from users u where exists (select 1 from recent_usage r where r.user_id=u.user_id)""")
def _(c):
    return c.stage.users.join(c.recent.content_usage, "user_id", "left_semi").select("user_id")


@check("u02_changed_users", """
select distinct user_id from ((select user_id from content_usage except select user_id from recent_usage)
 union all (select user_id from recent_usage except select user_id from content_usage))""")
def _(c):
    return relations.symmetric_difference(
        c.stage.content_usage.select("user_id"), c.recent.content_usage.select("user_id")
    )


BROKEN_USAGE = """
with broken as (select content_usage_id, user_id, usage_date, content_category, content_detail,
   cast(data_usage_mb+case when content_category='video' and usage_date between date '1995-03-10' and date '1995-03-12'
    then 0.001 else 0 end as decimal(14,3)) as data_usage_mb
  from content_usage where usage_date<>date '1997-07-04')"""


def _broken_usage(c):
    """Stored usage with a thousandth more on three days, and without one day."""
    usage = c.stage.content_usage
    more = (F.col("content_category") == "video") & F.col("usage_date").between("1995-03-10", "1995-03-12")
    grown = (F.col("data_usage_mb") + F.when(more, F.lit("0.001").cast("decimal(14,3)")).otherwise(0)).cast("decimal(14,3)")
    return usage.where(F.col("usage_date") != F.lit("1997-07-04").cast("date")).withColumn("data_usage_mb", grown)


@check("u02_changed_usage", BROKEN_USAGE + """
(select content_usage_id, user_id, usage_date, cast(data_usage_mb as double) as data_usage_mb from content_usage
  except select content_usage_id, user_id, usage_date, cast(data_usage_mb as double) from broken)
union all (select content_usage_id, user_id, usage_date, cast(data_usage_mb as double) from broken
  except select content_usage_id, user_id, usage_date, cast(data_usage_mb as double) from content_usage)""")
def _(c):
    columns = ["content_usage_id", "user_id", "usage_date", "data_usage_mb"]
    old, new = c.stage.content_usage.select(*columns), _broken_usage(c).select(*columns)
    return fingerprints.changed_rows(old, new, ["content_usage_id"], part="usage_date")


@check("j03_changed_usage_ids", BROKEN_USAGE + """
select coalesce(a.content_usage_id,b.content_usage_id) as content_usage_id,
 cast(a.data_usage_mb as double) as l_data_usage_mb, cast(b.data_usage_mb as double) as r_data_usage_mb
from content_usage a full join broken b on a.content_usage_id=b.content_usage_id
where a.data_usage_mb is distinct from b.data_usage_mb""")
def _(c):
    return fingerprints.changed_keys(
        c.stage.content_usage, _broken_usage(c), "content_usage_id", ["data_usage_mb"]
    ).select("content_usage_id", "l_data_usage_mb", "r_data_usage_mb")


@check("u04_user_months", """
select u.user_id, cast(m as date) as calendar_month
from users u, unnest(generate_series(timestamp '1996-01-01', timestamp '1996-03-01', interval 1 month)) t(m)""")
def _(c):
    return frames.per_month(c.stage.users.select("user_id"), "1996-01-01", "1996-04-01")


@check("g08_plan_contents", """
select distinct u.current_plan_id, c.content_detail from content_usage c, users u
where u.user_id=c.user_id""")
def _(c):
    plans = c.stage.users.select("user_id", "current_plan_id")
    pairs = c.stage.content_usage.select("user_id", "content_detail").distinct()
    return pairs.join(plans, "user_id").select("current_plan_id", "content_detail").distinct()


@check("g11_category_columns", """
select user_id,
 cast(coalesce(sum(data_usage_mb) filter (where content_category='video'),0) as double) as video,
 cast(coalesce(sum(data_usage_mb) filter (where content_category='music'),0) as double) as music,
 cast(coalesce(sum(data_usage_mb) filter (where content_category='short_form'),0) as double) as short_form
from content_usage group by 1""")
def _(c):
    return profiling.category_columns(c.stage.content_usage, ["video", "music", "short_form"])


@check("g11_age_by_plan_family", """
with a as (select case when u.age>=80 then '80+' else cast(u.age//10*10 as varchar)||'-'||cast(u.age//10*10+9 as varchar) end
 as age_group, p.plan_family as f from users u, plans p where p.plan_id=u.current_plan_id)
select age_group, count(*) filter (where f='VOICE') as "VOICE",
 count(*) filter (where f='BASIC_ROLLOVER') as "BASIC_ROLLOVER",
 count(*) filter (where f='BASIC') as "BASIC", count(*) filter (where f='CHOICE') as "CHOICE",
 count(*) filter (where f='CHOICE_DOUBLE') as "CHOICE_DOUBLE" from a group by 1""")
def _(c):
    return profiling.age_by_plan_family(c.stage, list(fixed.PLAN_PREFIXES))


# --- sources ----------------------------------------------------------------------------------------


def _written_usage(c) -> str:
    root = join(shared_folder(c.spark), f"usage-by-day-{uuid4().hex}")
    csv_tables.write_usage_partitions(c.recent.content_usage, root)
    return root


def _days(c, root):
    return csv_tables.partition_days(c.spark, root)


@check("s01_master_tables", """
select * from (
 select 'users' as table_name, count(*) as row_count from users union all
 select 'families', count(*) from families union all
 select 'bundle_discount_compositions', count(*) from bundle_discount_compositions union all
 select 'plans', count(*) from plans union all select 'age_benefits', count(*) from age_benefits union all
 select 'plan_age_benefits', count(*) from plan_age_benefits union all
 select 'additional_services', count(*) from additional_services union all
 select 'plan_benefits', count(*) from plan_benefits union all select 'discounts', count(*) from discounts union all
 select 'internet_bundle_discount_rules', count(*) from internet_bundle_discount_rules union all
 select 'premium_family_discount_rules', count(*) from premium_family_discount_rules union all
 select 'user_discounts', count(*) from user_discounts union all
 select 'user_services', count(*) from user_services) t""")
def _(c):
    folder = join(shared_folder(c.spark), f"masters-{uuid4().hex}")
    for name in MASTER_TABLES:
        c.stage[name].write.option("header", True).mode("overwrite").csv(
            join(folder, name + ".csv")
        )
    return row_counts(csv_tables.read_master(c.spark, folder))


@check("s03_usage_by_day", """
select usage_date as partition_event_date, user_id, content_detail, cast(data_usage_mb as double) as data_usage_mb
from recent_usage""")
def _(c):
    root = _written_usage(c)
    return csv_tables.read_usage_partitions(c.spark, root, _days(c, root)).select(
        "partition_event_date", "user_id", "content_detail", "data_usage_mb"
    )


# A day's file holds a header and its rows by id; every line is named by its place in bytes and its content.
layer("day_lines", """
select usage_date as d, 0 as k, 'content_usage_id,user_id,usage_date,content_category,content_detail,data_usage_mb' as line
from recent_usage group by usage_date
union all select usage_date, row_number() over (partition by usage_date order by content_usage_id),
 concat_ws(',', content_usage_id, user_id, usage_date, content_category, content_detail, cast(data_usage_mb as decimal(14,3)))
from recent_usage""")
layer("day_places", """
select d, line, cast(coalesce(sum(strlen(line)+1) over (partition by d order by k rows between unbounded preceding and 1 preceding),0)
 as bigint) as place from day_lines""")
layer("day_ranges", f"""
select d, r, sha256(concat_ws(':', r, count(*), sum(cast('0x'||substr(n,1,15) as bigint)), sum(cast('0x'||substr(n,17,15) as bigint)))) as leaf
from (select d, place//{csv_tables.RANGE} as r, md5(place||':'||upper(md5(line))) as n from day_places) x group by d, r""")


@check("s07_source_manifest", """
select d as event_date, any_value(rows) as row_count, sha256(any_value(size)||':'||string_agg(leaf, ':' order by r)) as digest
from day_ranges join (select d, count(*)-1 as rows, sum(strlen(line)+1) as size from day_lines group by d) using (d) group by d""")
def _(c):
    root = join(shared_folder(c.spark), f"usage-by-day-{uuid4().hex}")
    # All rows of a day in one task, in order: the digest of a file needs a file whose bytes are known.
    days = c.recent.content_usage.withColumn("event_date", F.col("usage_date")).repartition("event_date")
    days.sortWithinPartitions("event_date", "content_usage_id").write.partitionBy("event_date").option("header", True).csv(root)
    files = csv_tables.usage_files(c.spark, root, _days(c, root))
    return csv_tables.source_manifest(c.spark, root, files).select("event_date", "row_count", "digest")


@check("s09_public_master", """
select 'b1' as source_batch_id, premium_family_rule_id, discount_id,
 cast(enrollment_min_age as bigint) as enrollment_min_age,
 cast(enrollment_max_age as bigint) as enrollment_max_age,
 cast(benefit_end_age as bigint) as benefit_end_age,
 (select count(*) from plans) as plans_kept from premium_family_discount_rules""")
def _(c):
    plans = public_master(c.stage, "plans", "b1").agg(F.count("*")).scalar()
    return public_master(c.stage, "premium_family_discount_rules", "b1").select(
        "source_batch_id", "premium_family_rule_id", "discount_id", "enrollment_min_age",
        "enrollment_max_age", "benefit_end_age", plans.alias("plans_kept"),
    )


def _release(c):
    return analysis_release(c.stage, secret=SECRET, reference_date=REFERENCE)


@check("b23_release_users", f"""
select {USER_KEY} as analysis_user_key, case when age<7 then null when age<=12 then '8-12'
 when age<=18 then '13-18' when age<=24 then '19-24' when age<=34 then '25-34'
 when age<=49 then '35-49' when age<=64 then '50-64' else '65+' end as age_band, gender,
 strftime(subscription_start_date,'%Y-%m') as subscription_cohort,
 (2001-year(subscription_start_date))*12+9-month(subscription_start_date) as tenure_months,
 current_plan_id, {key_sql("family", "AFAM_", "family_id")} as analysis_family_key from users""")
def _(c):
    return _release(c).users


@check("b23_release_entitlements", f"""
select {USER_KEY} as analysis_user_key,
 {key_sql("bundle_composition", "ABND_", "bundle_composition_id")} as analysis_bundle_composition_key,
 discount_id, status, strftime(start_date,'%Y-%m') as start_month,
 strftime(end_date,'%Y-%m') as end_month from user_discounts""")
def _(c):
    return _release(c).user_discounts


@check("b23_release_usage", f"""
select {USER_KEY} as analysis_user_key, usage_date, content_category, content_detail,
 cast(data_usage_mb as double) as data_usage_mb from content_usage""")
def _(c):
    return _release(c).content_usage


@check("s08_release_counts", " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {name}" for name in SOURCE_NAMES))
def _(c):
    folder = join(shared_folder(c.spark), f"release-{uuid4().hex}")
    manifest = write_analysis_release(_release(c), folder, reference_date=REFERENCE)
    rows = [(name, facts["row_count"]) for name, facts in manifest["tables"].items()]
    return c.spark.createDataFrame(rows, "table_name string, row_count long")
