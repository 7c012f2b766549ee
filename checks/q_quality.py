"""Data quality (Q-*) and profiling (P-*)."""

from pyspark.sql import functions as F

from checks.fixtures import content_usage
from checks.q_layers import USER_KEY
from checks.q_policy import rule_amount
from checks.registry import REFERENCE, check, layer, rnd
from meterline.plans import features, profiling, quality
from meterline.plans.area import personalization_area
from meterline.plans.recipes import daily_usage
from meterline.schemas import REQUIRED_COLUMNS, SOURCE_SCHEMAS, USAGE_GRAIN

GUARD_AGES = (20, 70)


def rules_sql(*rules: tuple[str, str]) -> str:
    """One row per (name, scalar SQL)."""
    return "\nunion all\n".join(
        f"select '{name}' as rule_name, cast(({sql}) as bigint) as failed_rows" for name, sql in rules
    )


def rows_where(table: str, condition: str) -> str:
    return f"select count(*) from {table} where {condition}"


def orphan_sql(child: str, parent: str, key: str, parent_key: str | None = None) -> str:
    return (f"select count(*) from {child} c where c.{key} is not null and not exists "
            f"(select 1 from {parent} p where p.{parent_key or key}=c.{key})")


def dup_sql(table: str, keys: str) -> str:
    return f"select count(*) from (select {keys} from {table} group by {keys} having count(*)>1)"


BUNDLE_FK = """select count(*) from bundle_discount_compositions b where
 not exists (select 1 from families f where f.family_id=b.family_id)
 or (b.user_id is not null and not exists (select 1 from users u where u.user_id=b.user_id))"""
OFFER_FK = """select count(*) from plan_benefits b where
 not exists (select 1 from plans p where p.plan_id=b.plan_id)
 or not exists (select 1 from additional_services s where s.service_id=b.service_id)"""
PICK_FK = """select count(*) from user_services b where
 not exists (select 1 from users p where p.user_id=b.user_id)
 or not exists (select 1 from additional_services s where s.service_id=b.service_id)"""
DISCOUNT_FK = """select count(*) from user_discounts b where
 not exists (select 1 from users p where p.user_id=b.user_id)
 or not exists (select 1 from discounts s where s.discount_id=b.discount_id)
 or not exists (select 1 from bundle_discount_compositions s where s.bundle_composition_id=b.bundle_composition_id)"""


def constraint_sql(broken: dict[str, str]) -> list[tuple[str, str]]:
    """Required columns and keys of all source tables, of which some are taken from other layers."""
    rules = []
    for table, columns in REQUIRED_COLUMNS.items():
        name = broken.get(table, table)
        rules.append((f"staging_{table}_required", rows_where(name, " or ".join(f"{c} is null" for c in columns))))
        keys = {"key": columns[0]} | ({"grain": ",".join(USAGE_GRAIN)} if table == "content_usage" else {})
        for kind, key in keys.items():
            present = " and ".join(f"{c} is not null" for c in key.split(","))
            rules.append((f"staging_{table}_{kind}", f"select count(*) from (select {key} from {name} "
                          f"where {present} group by {key} having count(*)>1)"))
    return rules


layer("broken_usage", """
select content_usage_id, case when day(usage_date)=3 then null else user_id end as user_id,
 case when day(usage_date)=5 then null else usage_date end as usage_date, content_category, content_detail,
 case when day(usage_date)=6 then null when day(usage_date)=8 then -data_usage_mb else data_usage_mb end as data_usage_mb
from content_usage union all
select content_usage_id||'-2', user_id, usage_date, content_category, content_detail, data_usage_mb
from content_usage where day(usage_date)=9 union all
select content_usage_id, user_id, usage_date, content_category, 'again', data_usage_mb
from content_usage where day(usage_date)=10""")
layer("broken_plans", """
select * from plans union all select * from plans where plan_id like 'P10%'""")
layer("broken_users", """
select user_id, name, case when age%10=4 then null else age end as age, gender, subscription_start_date,
 case when age%10=7 then null else current_plan_id end as current_plan_id, family_id from users""")


@check("q03_q06_source_constraints", rules_sql(
    *constraint_sql({"content_usage": "broken_usage", "plans": "broken_plans", "users": "broken_users"}),
    ("staging_usage_negative", rows_where("broken_usage", "data_usage_mb<0")),
    ("staging_usage_user_fk", "select count(*) from broken_usage u where not exists "
     "(select 1 from users p where p.user_id=u.user_id)"),
    ("staging_users_plan_fk", "select count(*) from broken_users u where not exists "
     "(select 1 from plans p where p.plan_id=u.current_plan_id)"),
))
def _(c):
    usage, users = c.stage.content_usage, c.stage.users
    dom, age = F.dayofmonth("usage_date"), F.col("age")
    mb = F.col("data_usage_mb")
    broken = usage.select(
        "content_usage_id", F.when(dom != 3, F.col("user_id")).alias("user_id"),
        F.when(dom != 5, F.col("usage_date")).alias("usage_date"), "content_category", "content_detail",
        F.when(dom == 8, -mb).when(dom != 6, mb).alias("data_usage_mb"),
    )
    broken = broken.unionByName(
        usage.where(dom == 9).withColumn("content_usage_id", F.concat("content_usage_id", F.lit("-2")))
    ).unionByName(usage.where(dom == 10).withColumn("content_detail", F.lit("again")))
    plans = c.stage.plans.unionByName(c.stage.plans.where(F.col("plan_id").startswith("P10")))
    people = users.withColumns({
        "current_plan_id": F.when(age % 10 != 7, F.col("current_plan_id")), "age": F.when(age % 10 != 4, age),
    })
    found = quality.staging_rules(c.stage.replace(content_usage=broken, plans=plans, users=people))
    wanted = F.col("rule_name").rlike("_(required|key|grain)$") | F.col("rule_name").isin(
        "staging_usage_negative", "staging_usage_user_fk", "staging_users_plan_fk"
    )
    return found.where(wanted)


@check("q01_q04_staging_rules", rules_sql(
    *constraint_sql({}),
    ("staging_premium_family_age_integer", rows_where(
        "premium_family_discount_rules",
        "enrollment_min_age<>floor(enrollment_min_age) or enrollment_max_age<>floor(enrollment_max_age) "
        "or benefit_end_age<>floor(benefit_end_age)")),
    ("staging_age_benefit_range", rows_where("age_benefits", "max_age<min_age")),
    ("staging_users_plan_fk", orphan_sql("users", "plans", "current_plan_id", "plan_id")),
    ("staging_users_family_fk", orphan_sql("users", "families", "family_id")),
    ("staging_usage_user_fk", orphan_sql("content_usage", "users", "user_id")),
    ("staging_bundle_fk", BUNDLE_FK),
    ("staging_plan_benefit_fk", OFFER_FK),
    ("staging_user_service_fk", PICK_FK),
    ("staging_user_discount_fk", DISCOUNT_FK),
    ("staging_usage_negative", rows_where("content_usage", "data_usage_mb<0")),
))
def _(c):
    return quality.staging_rules(c.stage)


@check("q05_q06_incremental_rules", rules_sql(
    ("incremental_partition_date_match", rows_where("recent_usage", "day(usage_date)%7=0")),
    ("incremental_date_range", rows_where(
        "recent_usage", "usage_date not between date '2024-01-02' and date '2024-01-08'")),
    ("incremental_user_fk", "select count(*) from recent_usage r where not exists "
     "(select 1 from users u where u.user_id=r.user_id and u.age<70)"),
    ("incremental_manifest_rows", "select 1"),
    ("incremental_content_usage_required", "select 0"), ("incremental_usage_negative", "select 0"),
    ("incremental_content_usage_key", dup_sql("recent_usage", "content_usage_id")),
    ("incremental_content_usage_grain", dup_sql("recent_usage", ",".join(USAGE_GRAIN))),
))
def _(c):
    date = F.col("usage_date")
    usage = c.recent.content_usage.withColumn(
        "partition_event_date", F.when(F.dayofmonth(date) % 7 == 0, F.date_add(date, 1)).otherwise(date)
    )
    manifest = usage.where(F.col("content_category") == "video").groupBy("usage_date").agg(
        F.count("*").alias("row_count")
    )
    return quality.incremental_staging_rules(
        usage, c.stage.users.where(F.col("age") < 70), manifest, "2024-01-02", "2024-01-08"
    )


layer("late_ids", """
select usage_date, content_usage_id from recent_usage
union all select date '2024-01-05', content_usage_id from recent_usage where day(usage_date) between 9 and 12""")


@check("q06_i09_ids_of_loaded_days", rules_sql(
    ("incremental_content_usage_known", "select count(distinct l.content_usage_id) from late_ids l, recent_usage r "
     "where r.content_usage_id=l.content_usage_id and l.usage_date between date '2024-01-02' and date '2024-01-08' "
     "and r.usage_date not between date '2024-01-02' and date '2024-01-08'"),
))
def _(c):
    """A batch of a week that also brings ids of four later days; every other day is stored."""
    date, usage = F.col("usage_date"), c.recent.content_usage
    again = usage.where(F.dayofmonth(date).between(9, 12)).withColumn("usage_date", F.lit("2024-01-05").cast("date"))
    batch = usage.unionByName(again).where(date.between("2024-01-02", "2024-01-08"))
    return quality.known_ids_rule(batch, usage, "2024-01-02", "2024-01-08")


@check("q07_q12_operations_warehouse_rules", rules_sql(
    ("operations_dw_14_table_counts", "select 0"),
    ("operations_dw_age_benefit_bounds_preserved", "select 0"),
    ("operations_dw_usage_total", "select case when (select sum(k) from o_usage)=(select sum(k) from p_usage) then 0 else 1 end"),
    ("operations_dw_pre_subscription_usage", "select 0"),
    ("operations_dw_key_format", rows_where("users", f"not regexp_matches({USER_KEY},'^AUSR_[0-9A-F]{{24}}$')")),
    ("operations_dw_category_grain", dup_sql("o_usage", "analysis_user_key, usage_date, content_category")),
))
def _(c):
    return quality.operations_warehouse_rules(c.ops.dw, c.stage, REFERENCE)


@check("q07_q13_personalization_warehouse_rules", rules_sql(
    ("personalization_dw_14_table_counts", "select 0"),
    ("personalization_dw_usage_rows", "select 0"),
    ("personalization_dw_age_benefit_bounds_preserved", "select 0"),
    ("personalization_dw_name_preserved", "select 0"),
    ("personalization_dw_pre_subscription_usage", "select 0"),
    ("personalization_dw_detail_grain", dup_sql("p_usage", "user_id, usage_date, content_category, content_detail")),
))
def _(c):
    return quality.personalization_warehouse_rules(c.pers.dw, c.stage, REFERENCE)


@check("q08_bounds_and_counts_against_raw_usage", rules_sql(
    ("usage_rows", "select case when (select count(*) from content_usage)=(select count(*) from p_usage) then 0 else 1 end"),
    ("usage_total", "select case when (select sum(data_usage_mb) from content_usage)=(select sum(k)/1000 from p_usage) then 0 else 1 end"),
    ("early_usage", "select count(*) from content_usage c, users u where u.user_id=c.user_id and c.usage_date<u.subscription_start_date"),
    ("user_repeats", dup_sql("content_usage", "user_id")),
))
def _(c):
    # Six uses of the same usage, each of other columns and days: its sums are stored once instead of made for each.
    raw = content_usage(c.spark, c.folder, written=True)
    kept = personalization_area(c.stage.replace(content_usage=raw), reference_date=REFERENCE).dw.content_usage
    starts = c.stage.users.select("user_id", "subscription_start_date")
    early = raw.join(starts, "user_id").where(F.col("usage_date") < F.col("subscription_start_date"))
    return quality.union_rules(
        quality.counts_agree("usage_rows", raw, kept),
        quality.totals_agree("usage_total", raw, "data_usage_mb", kept, "data_usage_mb"),
        quality.rule("early_usage", early),
        quality.rule("user_repeats", quality.duplicates(raw, "user_id")),
    )


@check("q14_q17_operations_mart_rules", rules_sql(
    ("operations_dm_usage_total", "select 0"), ("operations_dm_monthly_total", "select 0"),
    ("operations_dm_active_subscriber", "select 0"), ("operations_dm_no_detail_dimension", "select 0"),
))
def _(c):
    area = c.ops
    return quality.operations_mart_rules(area.mart, area.dw, REFERENCE)


@check("q13_q18_personalization_mart_rules", rules_sql(
    ("personalization_dm_customer_name", "select 0"), ("personalization_dm_daily_total", "select 0"),
    ("personalization_dm_monthly_total", "select 0"),
    ("personalization_dm_detail_view_total", "select 0"),
    ("personalization_ai_name_present", "select 0"),
))
def _(c):
    area = c.pers
    return quality.personalization_mart_rules(area.mart, area.dw, area.views)


@check("q19_q20_preaggregate_report", """
select rule_name, cast(0 as bigint) as failed_rows, 'PASS' as result from (values ('view_column_contract'),
 ('customer_month_grain'),('monthly_usage_reconciliation'),('month_first_key')) t(rule_name)""")
def _(c):
    area = c.ops
    return quality.preaggregate_report(area.mart, area.views)


# Run records derived from orders and order lines: one run per order, one recorded rule per line.
RUNS = """
select cast(o_orderkey as string) as batch_id,
 case when o_custkey%10=0 then 'full_snapshot' else 'content_usage_daily' end as pipeline_name,
 case when o_orderkey%5=0 then 'CORRECTION' else 'INCREMENTAL' end as run_type,
 cast(o_orderdate as date) as event_date_from, cast(o_orderdate as date) as event_date_to,
 case o_orderstatus when 'F' then 'SUCCEEDED' when 'O' then 'RUNNING' else 'FAILED' end as status,
 cast(o_orderdate as timestamp) as started_at, cast(o_orderdate as timestamp) as ended_at
from orders"""
RESULTS = """
select cast(l_orderkey as string) as batch_id, cast(l_linenumber as string) as rule_name,
 case when l_quantity>49 then 1 else 0 end as failed_row_count from lineitem"""
MARKS = """
select 'content_usage_daily' as pipeline_name, max(event_date_to) as last_successful_event_date,
 max(batch_id) as last_successful_batch_id from runs
where pipeline_name='content_usage_daily' and run_type='INCREMENTAL' and status='SUCCEEDED'
 and event_date_to=(select max(event_date_to) from runs where pipeline_name='content_usage_daily'
  and run_type='INCREMENTAL' and status='SUCCEEDED')"""


@check("q21_recent_runs", f"""
with runs as ({RUNS})
select batch_id, run_type, event_date_from, event_date_to, status, cast(started_at as date) as started_on
from runs where pipeline_name='content_usage_daily' order by started_at desc, batch_id limit 10""")
def _(c):
    return quality.recent_runs(c.spark.sql(RUNS), "content_usage_daily").select(
        "batch_id", "run_type", "event_date_from", "event_date_to", "status",
        F.col("started_at").cast("date").alias("started_on"),
    )


@check("q22_watermark_status", f"""
with runs as ({RUNS}), marks as ({MARKS})
select m.last_successful_event_date, 'SUCCEEDED' as watermark_batch_status, r.event_date_to,
 'PASS' as watermark_check, date '2030-01-01' as yesterday, false as caught_up_through_yesterday
from marks m, runs r where r.batch_id=m.last_successful_batch_id""")
def _(c):
    runs = c.spark.sql(RUNS)
    marks = c.spark.sql(f"with runs as ({RUNS}) {MARKS}")
    return quality.watermark_status(
        runs, marks, "content_usage_daily", F.lit("2030-01-01").cast("date")
    )


@check("q23_recorded_checks", f"""
with runs as ({RUNS}), results as ({RESULTS}),
 n as (select batch_id, count(*) as n, sum(failed_row_count) as f from results group by 1)
select r.batch_id, r.run_type, r.event_date_from, r.event_date_to, coalesce(n.n,0) as checked_rules,
 cast(coalesce(n.f,0) as bigint) as failed_rows,
 case when n.n is null then 'MISSING_QUALITY_RESULTS' when n.f=0 then 'PASS' else 'FAIL' end
  as recorded_quality_check
from runs r left join n on n.batch_id=r.batch_id
where r.pipeline_name='content_usage_daily' and r.status='SUCCEEDED'""")
def _(c):
    return quality.recorded_checks(c.spark.sql(RUNS), c.spark.sql(RESULTS), "content_usage_daily")


@check("q24_layer_totals", """
with t as (select 'dw_operations' as layer, count(*) as n, sum(k) as k from o_usage union all
 select 'dw_personalization', count(*), sum(k) from p_usage union all
 select 'dm_operations_daily', count(*), sum(k) from o_daily_segment union all
 select 'dm_personalization_daily', count(*), sum(k) from p_daily)
select layer, n as row_count, cast(k as double)/1000 as total_usage_mb, cast(0 as double) as difference_mb,
 'PASS' as total_check from t""")
def _(c):
    ops, pers = c.ops, c.pers
    return quality.layer_totals(ops.dw, pers.dw, ops.mart, pers.mart)


USER_TRAITS = """
select *, cast(datediff('month', subscription_start_date, date '2001-09-01') as integer) as months,
 age%9<>0 as has_family, age%4=0 as has_family_bundle from users"""


@check("q25_user_rules", rules_sql(
    ("users_plan_fk", orphan_sql("users", "plans", "current_plan_id", "plan_id")),
    ("users_tenure_within_age", f"select count(*) from ({USER_TRAITS}) where months>greatest(greatest(age-8,0)*12+11,1)"),
    ("users_no_family_id_without_family", f"select count(*) from ({USER_TRAITS}) where not has_family and family_id is not null"),
    ("users_no_bundle_without_family", f"select count(*) from ({USER_TRAITS}) where not has_family and has_family_bundle"),
))
def _(c):
    start = F.col("subscription_start_date")
    users = c.stage.users.select(
        "*",
        ((2001 - F.year(start)) * 12 + 9 - F.month(start)).alias("subscription_months"),
        (F.col("age") % 9 != 0).alias("has_family"),
        (F.col("age") % 4 == 0).alias("has_family_bundle"),
    )
    return quality.user_rules(users, c.stage.plans)


KINDS = "case a.age%4 when 0 then 'PARENT' when 1 then 'GRANDPARENT' when 2 then 'SPOUSE' else 'SIBLING' end"
RELATED = f"""
select a.user_id, b.related, a.family_id, {KINDS} as kind, a.age as a, x.age as b,
 x.user_id is not null as known, x.family_id as bf
from users a join (select family_id, max(user_id) as related from users where age%7<>0 group by 1) b
 on b.family_id=a.family_id
left join users x on x.user_id=b.related and x.age<80"""


@check("q26_relationship_rules", rules_sql(
    ("relationship_user_fk", f"select count(*) from ({RELATED}) where not known"),
    ("relationship_same_family", f"select count(*) from ({RELATED}) where bf is distinct from family_id"),
    ("relationship_not_self", f"select count(*) from ({RELATED}) where user_id=related and known"),
    ("relationship_parent_gap", f"select count(*) from ({RELATED}) where kind='PARENT' and a-b<18"),
    ("relationship_grandparent_gap", f"select count(*) from ({RELATED}) where kind='GRANDPARENT' and a-b<36"),
    ("relationship_spouse_gap", f"select count(*) from ({RELATED}) where kind='SPOUSE' and abs(a-b)>15"),
    ("relationship_sibling_gap", f"select count(*) from ({RELATED}) where kind='SIBLING' and abs(a-b)>15"),
    ("family_size", "select count(*) from (select family_id, count(*) as n, count(*) filter (where age<85) as m from users where family_id is not null group by 1) where n<>m"),
))
def _(c):
    # One relation per user, to the last member of the family; partners of 80 and over are given an
    # unknown id, so that every rule has failing rows.
    members = c.stage.users.where(F.col("family_id").isNotNull())
    age = F.col("age")
    last = members.where(age % 7 != 0).groupBy("family_id").agg(
        F.max(F.struct("user_id", "age")).alias("last")
    )
    partner = F.when(F.col("last.age") < 80, F.col("last.user_id")).otherwise(F.lit("unknown"))
    kind = (
        F.when(age % 4 == 0, "PARENT").when(age % 4 == 1, "GRANDPARENT").when(age % 4 == 2, "SPOUSE")
        .otherwise("SIBLING")
    )
    relations = members.join(last, "family_id").select(
        "user_id", partner.alias("related_user_id"), "family_id", kind.alias("relationship_type")
    )
    declared = members.groupBy("family_id").agg(F.count_if(age < 85).alias("family_size"))
    return quality.relationship_rules(relations, c.stage.users, declared)


def _guardians(c):
    return c.stage.users.where(F.col("age").between(*GUARD_AGES)).select("user_id")


layer("bundled", "select * from families where has_bundle")
layer("mobile_parts", """
select c.bundle_composition_id, c.family_id, c.user_id, c.component_role as role, l.monthly_fee as fee,
 l.network_type, l.age, l.family_id as home, c.component_role in ('BASE_MOBILE','LOW_MOBILE') as counted
from bundle_discount_compositions c left join lines l on l.user_id=c.user_id
where c.component_type='MOBILE'""")
layer("held_discounts", """
select x.*, c.family_id, c.component_role as role, c.component_type, c.user_id as owner
from user_discounts x left join bundle_discount_compositions c
 on c.bundle_composition_id=x.bundle_composition_id""")
layer("bundle_shape", f"""
select b.*, n.mobile_lines, n.high_lines, coalesce(m.bases,0) as bases, coalesce(m.premiums,0) as premiums,
 coalesce(m.own,0) as own, coalesce(m.parts,0) as parts, m.base_fee, coalesce(i.n,0) as internets,
 case when b.bundle_discount_method='TOTAL' then coalesce(h.d1,0) else coalesce(h.d2,0) end as actual,
 case when b.bundle_discount_method='TOTAL' then case when
   coalesce({rule_amount("D001", "TOTAL", "MOBILE_TOTAL_POOL", "b.internet_product_group",
    "b.internet_contract_months", total="coalesce(m.pool,0)")},0)>0 then m.cnt else 0 end
  else coalesce(m.paying,0) end as expected
from bundled b join family_counts n on n.family_id=b.family_id
left join (select family_id, count(*) filter (where role='BASE_MOBILE') as bases,
  count(*) filter (where role='PREMIUM_MOBILE') as premiums, count(*) filter (where home=family_id) as own,
  count(*) as parts, max(fee) filter (where role='BASE_MOBILE') as base_fee,
  sum(fee) filter (where counted) as pool, count(*) filter (where counted) as cnt,
  count(*) filter (where counted and fee>=37000) as paying from mobile_parts group by 1) m
 on m.family_id=b.family_id
left join (select family_id, count(*) as n from bundle_discount_compositions
  where component_role='BASE_INTERNET' group by 1) i on i.family_id=b.family_id
left join (select family_id, count(*) filter (where discount_id='D001') as d1,
  count(*) filter (where discount_id='D002') as d2 from held_discounts
  where role in ('BASE_MOBILE','LOW_MOBILE') group by 1) h on h.family_id=b.family_id""")
layer("line_holdings", f"""
select p.*, b.bundle_type, b.bundle_discount_method as method,
 exists (select 1 from held_discounts h where h.bundle_composition_id=p.bundle_composition_id and h.discount_id='D001') as d1,
 exists (select 1 from held_discounts h where h.bundle_composition_id=p.bundle_composition_id and h.discount_id='D002') as d2,
 exists (select 1 from held_discounts h where h.bundle_composition_id=p.bundle_composition_id and h.discount_id='D003') as d3,
 (select min(h.start_date) from held_discounts h where h.bundle_composition_id=p.bundle_composition_id
   and h.discount_id='D004') as youth_start,
 exists (select 1 from lines g, users w where w.user_id=g.user_id and w.age between 20 and 70
   and g.family_id=p.family_id and g.monthly_fee>=80000 and g.network_type='5G') as guarded
from mobile_parts p join bundled b on b.family_id=p.family_id""")
PREMIUM = "bundle_type='PREMIUM_FAMILY'"


@check("q27_bundle_rules", rules_sql(
    ("bundle_active_internet", rows_where("bundled", "not coalesce(has_home_internet and internet_status='ACTIVE',false)")),
    ("bundle_internet_group", rows_where("bundled", "coalesce(internet_product_group,'') not in ('BASIC_ESSENCE_PREMIUM','SLIM')")),
    ("bundle_contract_term", rows_where("bundled", "coalesce(internet_contract_months,0) not in (12,24,36)")),
    ("bundle_type_known", rows_where("bundled", "coalesce(bundle_type,'') not in ('PREMIUM_FAMILY','INTERNET_MOBILE')")),
    ("bundle_method_known", rows_where("bundled", "coalesce(bundle_discount_method,'') not in ('TOTAL','FIXED')")),
    ("bundle_allocation", rows_where("bundled", "case when bundle_discount_method='TOTAL' then coalesce(total_discount_allocation_method,'') not in ('EQUAL','CONTRIBUTION') else total_discount_allocation_method is not null end")),
    ("bundle_internet_benefit", rows_where("bundled", "internet_benefit_discount_id is distinct from 'D005'")),
    ("internet_group_supported", rows_where("families", "has_home_internet and coalesce(internet_product_group,'') not in ('BASIC_ESSENCE_PREMIUM','SLIM')")),
    ("no_group_without_internet", rows_where("families", "not has_home_internet and internet_product_group is not null")),
    ("bundle_one_base_internet", rows_where("bundle_shape", "internets<>1")),
    ("bundle_all_members", rows_where("bundle_shape", "own<>mobile_lines or parts<>mobile_lines")),
    ("bundle_one_base_mobile", rows_where("bundle_shape", "bases<>1")),
    ("premium_two_high_lines", rows_where("bundle_shape", f"{PREMIUM} and high_lines<2")),
    ("premium_internet_group", rows_where("bundle_shape", f"{PREMIUM} and internet_product_group is distinct from 'BASIC_ESSENCE_PREMIUM'")),
    ("premium_base_fee", rows_where("bundle_shape", f"{PREMIUM} and coalesce(base_fee,0)<77000")),
    ("general_not_premium", rows_where("bundle_shape", f"not {PREMIUM} and high_lines>=2 and internet_product_group is distinct from 'SLIM'")),
    ("general_no_premium_line", rows_where("bundle_shape", f"not {PREMIUM} and premiums>0")),
    ("bundle_recipients", rows_where("bundle_shape", "actual<>expected")),
    ("counted_line_without_rate", rows_where("line_holdings", "counted and d3")),
    ("counted_line_method", rows_where("line_holdings", "counted and case when method='TOTAL' then d2 else d1 end")),
    ("premium_line_rate", rows_where("line_holdings", "not counted and not coalesce(fee>=77000 and d3,false)")),
    ("premium_line_no_method", rows_where("line_holdings", "not counted and (d1 or d2)")),
    ("youth_eligibility", rows_where("line_holdings", f"youth_start is not null and not coalesce({PREMIUM} and age>=0 and age<20 and (age<=18 or youth_start<=date '{REFERENCE}'-to_months(12*(cast(age as integer)-18))) and fee>=80000 and network_type='5G',false)")),
    ("youth_guardian", rows_where("line_holdings", "youth_start is not null and not guarded")),
    ("entitlement_own_line", rows_where("held_discounts", "not coalesce(component_type='MOBILE' and owner=user_id,false)")),
    ("entitlement_bundled_family", "select count(*) from held_discounts h left join families f on f.family_id=h.family_id where not coalesce(f.has_bundle,false)"),
    ("discount_master", "select count(*) from discounts where discount_id not in ('D001','D002','D003','D004','D005')"),
    ("entitlement_unique", dup_sql("user_discounts", "user_id, discount_id, bundle_composition_id, start_date")),
))
def _(c):
    return quality.bundle_rules(c.stage, _guardians(c), REFERENCE)


@check("q27_discount_amount_rules", rules_sql(
    ("discount_not_negative", "select 0"),
    ("active_users_are_positive", f"""
select count(*) from (select distinct x.user_id from user_discounts x where x.status='ACTIVE'
 and x.start_date<=date '{REFERENCE}' and (x.end_date is null or x.end_date>=date '{REFERENCE}')) a
where not exists (select 1 from amounts_now n where n.user_id=a.user_id and n.amount>0)"""),
))
def _(c):
    return quality.discount_amount_rules(c.stage, REFERENCE)


@check("q28_policy_rules", rules_sql(
    ("internet_rule_discount_fk", orphan_sql("internet_bundle_discount_rules", "discounts", "discount_id")),
    ("premium_rule_discount_fk", orphan_sql("premium_family_discount_rules", "discounts", "discount_id")),
    ("internet_rule_unique", dup_sql("internet_bundle_discount_rules", "discount_id, bundle_discount_method, rule_type, internet_product_group, contract_months, mobile_total_fee_min, mobile_line_fee_min")),
    ("internet_rule_term", rows_where("internet_bundle_discount_rules", "contract_months not in (12,24,36)")),
    ("internet_rule_amount", rows_where("internet_bundle_discount_rules", "discount_amount<0")),
    ("premium_rule_kinds", "select count(*) from premium_family_discount_rules where discount_id not in ('D003','D004')"),
    ("premium_rate", rows_where("premium_family_discount_rules", "discount_id='D003' and discount_rate is distinct from 0.25")),
    ("youth_amount", rows_where("premium_family_discount_rules", "discount_id='D004' and discount_amount is distinct from 5500")),
    ("youth_ages", rows_where("premium_family_discount_rules", "discount_id='D004' and (enrollment_max_age<>18 or benefit_end_age<>20)")),
))
def _(c):
    return quality.policy_rules(c.stage)


@check("q29_usage_rules", rules_sql(
    ("daily_equals_detail", "select count(distinct (user_id, usage_date)) from content_usage where day(usage_date)=7"),
    ("category_known", "select 0"), ("detail_known", "select 0"), ("detail_in_category", "select 0"),
    ("usage_grain_unique", dup_sql("content_usage", "user_id, usage_date, content_category, content_detail")),
))
def _(c):
    # Every seventh of a month is declared one MB too high.
    off = F.when(F.dayofmonth("usage_date") == 7, 1).otherwise(0)
    daily = daily_usage(c.stage).select(
        "user_id", "usage_date", (F.col("daily_data_mb") + off).alias("total_data_mb")
    )
    return quality.usage_rules(c.stage.content_usage, daily)


PREFIX = ("case plan_family when 'VOICE' then 'P10' when 'BASIC_ROLLOVER' then 'P21' when 'BASIC' then 'P22' "
          "when 'CHOICE' then 'P30' when 'CHOICE_DOUBLE' then 'P40' end")
PICKS = """
select u.user_id, p.plan_family, count(s.user_id) as n,
 count(*) filter (where s.benefit_type='CHOICE') as one,
 count(*) filter (where s.benefit_type='DOUBLE_CHOICE') as two
from users u join plans p on p.plan_id=u.current_plan_id left join user_services s on s.user_id=u.user_id
group by 1,2"""


def _no_offer(family: str, benefit: str) -> str:
    return (f"select count(*) from plans p where p.plan_family='{family}' and not exists (select 1 from plan_benefits b "
            f"where b.plan_id=p.plan_id and b.is_selectable and b.benefit_type='{benefit}')")


@check("q30_master_rules", rules_sql(
    ("plan_benefits_plan_fk", orphan_sql("plan_benefits", "plans", "plan_id")),
    ("plan_benefits_service_fk", orphan_sql("plan_benefits", "additional_services", "service_id")),
    ("plan_age_benefits_plan_fk", orphan_sql("plan_age_benefits", "plans", "plan_id")),
    ("plan_age_benefits_age_fk", orphan_sql("plan_age_benefits", "age_benefits", "age_benefit_id")),
    ("plan_age_benefits_unique", dup_sql("plan_age_benefits", "plan_id, age_benefit_id")),
    ("plan_prefix", f"select count(*) from plans where not starts_with(plan_id, {PREFIX})"),
    ("choice_plan_offer", _no_offer("CHOICE", "CHOICE")),
    ("double_choice_plan_offer", _no_offer("CHOICE_DOUBLE", "DOUBLE_CHOICE")),
    ("user_services_user_fk", orphan_sql("user_services", "users", "user_id")),
    ("user_services_service_fk", orphan_sql("user_services", "additional_services", "service_id")),
    ("user_services_unique", dup_sql("user_services", "user_id, service_id")),
    ("user_services_offered", """select count(*) from user_services s, users u where u.user_id=s.user_id and not exists
 (select 1 from plan_benefits b where b.plan_id=u.current_plan_id and b.service_id=s.service_id
  and b.benefit_type=s.benefit_type and b.is_selectable)"""),
    ("double_choice_two_services", f"select count(*) from ({PICKS}) where plan_family='CHOICE_DOUBLE' and two<>2"),
    ("choice_one_service", f"select count(*) from ({PICKS}) where plan_family='CHOICE' and one<>1"),
    ("other_plan_no_service", f"select count(*) from ({PICKS}) where plan_family not in ('CHOICE','CHOICE_DOUBLE') and n>0"),
    ("age_benefit_supported", "select 0"), ("age_benefit_min_age", "select 0"), ("age_benefit_max_age", "select 0"),
))
def _(c):
    return quality.master_rules(c.stage, features.age_benefits(c.stage))


@check("q31_partition_rules", rules_sql(
    ("partition_gaps", """select datediff('day', min(usage_date), max(usage_date))+1-count(distinct usage_date) from content_usage"""),
    ("partition_wrong_date", "select 0"),
    ("usage_null", "select 0"),
    ("usage_not_positive", rows_where("content_usage", "data_usage_mb<=0")),
    ("usage_duplicate_id", "select count(*)-count(distinct (usage_date, user_id)) from content_usage"),
    ("usage_duplicate_grain", "select 0"),
    ("usage_orphan_user", "select count(*) from content_usage c where not exists (select 1 from users u where u.user_id=c.user_id and u.age<60)"),
))
def _(c):
    # The customer id stands in as row id, so that repeated ids occur.
    usage = c.stage.content_usage.withColumn("partition_event_date", F.col("usage_date")).withColumn(
        "content_usage_id", F.col("user_id")
    )
    return quality.partition_rules(usage, c.stage.users.where(F.col("age") < 60))


@check("q32_schema_report", """
select * from (select 'users' as table_name, count(*) as row_count, cast(8 as bigint) as column_count,
  'name' as missing_columns, 'estimated_monthly_bill' as internal_columns from users union all
 select 'families', count(*), 10, '', '' from families union all
 select 'content_usage', count(*), 6, '', '' from content_usage) t""")
def _(c):
    from meterline.plans.tables import Tables

    users = c.stage.users.drop("name").withColumns(
        {"estimated_monthly_bill": F.lit(0), "note": F.lit("")}
    )
    tables = Tables(users=users, families=c.stage.families, content_usage=c.stage.content_usage)
    return quality.schema_report(tables, {name: SOURCE_SCHEMAS[name].names for name in tables})


ROLE_COUNTS = """select f.family_id, count(*) filter (where c.component_role='BASE_MOBILE') as m,
 count(*) filter (where c.component_role='BASE_INTERNET') as i from families f
 left join bundle_discount_compositions c on c.family_id=f.family_id where f.has_bundle group by 1"""


@check("q33_reference_rules", rules_sql(
    ("ref_users_plan", orphan_sql("users", "plans", "current_plan_id", "plan_id")),
    ("ref_users_family", orphan_sql("users", "families", "family_id")),
    ("ref_component_family", orphan_sql("bundle_discount_compositions", "families", "family_id")),
    ("ref_mobile_user", "select count(*) from bundle_discount_compositions c where component_type='MOBILE' and not exists (select 1 from users u where u.user_id=c.user_id)"),
    ("ref_entitlement_user", orphan_sql("user_discounts", "users", "user_id")),
    ("ref_entitlement_component", orphan_sql("user_discounts", "bundle_discount_compositions", "bundle_composition_id")),
    ("ref_entitlement_discount", orphan_sql("user_discounts", "discounts", "discount_id")),
    ("ref_internet_rule_discount", orphan_sql("internet_bundle_discount_rules", "discounts", "discount_id")),
    ("ref_premium_rule_discount", orphan_sql("premium_family_discount_rules", "discounts", "discount_id")),
    ("ref_usage_user", orphan_sql("content_usage", "users", "user_id")),
    ("value_contract_months", rows_where("families", "internet_contract_months not in (12,24,36)")),
    ("value_bundle_type", rows_where("families", "bundle_type not in ('INTERNET_MOBILE','PREMIUM_FAMILY')")),
    ("value_allocation", rows_where("families", "bundle_discount_method='TOTAL' and coalesce(total_discount_allocation_method,'') not in ('EQUAL','CONTRIBUTION')")),
    ("value_rule_months", rows_where("internet_bundle_discount_rules", "contract_months not in (12,24,36)")),
    ("one_base_mobile", f"select count(*) from ({ROLE_COUNTS}) where m<>1"),
    ("one_base_internet", f"select count(*) from ({ROLE_COUNTS}) where i<>1"),
))
def _(c):
    return quality.reference_rules(c.stage)


# --- profiling ---------------------------------------------------------------------------------------


def shares_sql(column: str, source: str, label: str | None = None) -> str:
    return f"""select '{label or column}' as column_name, cast({column} as varchar) as value,
 count(*) as row_count, {rnd("count(*)*100", f"(select count(*) from {source})", 2)} as pct
from {source} group by {column}"""


@check("p01_family_values", "\nunion all\n".join(
    shares_sql(column, "families")
    for column in ("has_bundle", "bundle_type", "internet_status", "internet_contract_months")))
def _(c):
    return profiling.value_distributions(
        c.stage.families, ["has_bundle", "bundle_type", "internet_status", "internet_contract_months"]
    )


DESCRIBE = """
select '{label}' as column_name, count(*) as row_count, round(cast(avg(v) as double),2) as mean,
 round(stddev_samp(cast(v as double)),2) as std, round(cast(min(v) as double),2) as "min",
 round(cast(max(v) as double),2) as "max",
 {quantiles} from ({source})"""


def describe_sql(label: str, source: str) -> str:
    quantiles = ",\n ".join(
        f"round(quantile_cont(cast(v as double),{q}),2) as p{round(q * 100):02d}" for q in profiling.QUANTILES
    )
    return DESCRIBE.format(label=label, source=source, quantiles=quantiles)


@check("p02_daily_usage_distribution", describe_sql(
    "daily_data_mb", "select sum(data_usage_mb) as v from content_usage group by user_id, usage_date"))
def _(c):
    return profiling.numeric_distribution(daily_usage(c.stage), "daily_data_mb")


@check("p02_fee_distribution", describe_sql(
    "monthly_fee", "select monthly_fee as v from users u, plans p where p.plan_id=u.current_plan_id"))
def _(c):
    fees = c.stage.users.join(
        c.stage.plans.withColumnRenamed("plan_id", "current_plan_id"), "current_plan_id"
    )
    return profiling.numeric_distribution(fees, "monthly_fee")


UP = """(select u.gender, p.plan_name, p.plan_family, p.network_type,
 p.plan_family in ('CHOICE','CHOICE_DOUBLE') as is_choice,
 case when age>=80 then '80+' else cast(age//10*10 as varchar)||'-'||cast(age//10*10+9 as varchar) end as age_group
 from users u left join plans p on p.plan_id=u.current_plan_id) up"""


@check("p03_user_plan_distribution", "\nunion all\n".join(
    shares_sql(column, UP) for column in
    ("gender", "plan_name", "plan_family", "network_type", "is_choice", "age_group")))
def _(c):
    return profiling.user_plan_distribution(c.stage)


def content_sql(group: str) -> str:
    return f"""
with u as (select {group} as g, cast(data_usage_mb*1000 as bigint) as k from content_usage),
 r as (select *, row_number() over (partition by g order by k) as rn, count(*) over (partition by g) as n from u)
select g as content_group, n as row_count, {rnd("sum(k)", "1024000", 2)} as total_gb,
 {rnd("sum(k)*100", "(select sum(k) from u)", 2)} as share_pct, {rnd("sum(k)", "n*1000", 2)} as mean_mb,
 {rnd("sum(case when rn in ((n+1)//2, n//2+1) then case when n%2=1 then 2*k else k end end)", "2000", 2)} as median_mb
from r group by g, n"""


@check("p04_category_distribution", content_sql("content_category"))
def _(c):
    return profiling.content_distribution(c.stage.content_usage, "content_category")


@check("p04_detail_distribution", content_sql("content_category||'/'||content_detail"))
def _(c):
    return profiling.content_distribution(c.stage.content_usage, "content_category", "content_detail")


@check("p05_monthly_equivalent", f"""
select user_id, {rnd("sum(k)*30", "count(*)*1024000", 3)} as monthly_gb from day_usage group by 1""")
def _(c):
    return profiling.monthly_equivalent(c.stage)


@check("p05_monthly_equivalent_distribution", describe_sql(
    "monthly_gb", f"select cast({rnd('sum(k)*30', 'count(*)*1024000', 3)} as decimal(18,3)) as v from day_usage group by user_id"))
def _(c):
    return profiling.numeric_distribution(profiling.monthly_equivalent(c.stage), "monthly_gb")


@check("p06_services_per_user", """
select s.benefit_type, a.service_name, count(distinct s.user_id) as user_count
from user_services s, additional_services a where a.service_id=s.service_id group by 1,2""")
def _(c):
    return profiling.services_per_user(c.stage)


@check("p06_discounts_per_user", """
select n as discount_rows, count(*) as user_count
from (select user_id, count(*) as n from user_discounts group by 1) group by 1""")
def _(c):
    return profiling.discounts_per_user(c.stage)


@check("p06_users_per_discount", """
select discount_id, count(distinct user_id) as user_count from user_discounts group by 1""")
def _(c):
    return profiling.users_per_discount(c.stage)


@check("p06_entitlement_coverage", """
select (select count(distinct user_id) from user_discounts) as users_with_discount,
 (select count(*) from users) as users,
 (select count(*) from user_discounts where discount_id='D004') as youth_entitlements""")
def _(c):
    return profiling.entitlement_coverage(c.stage)


def group_sql(group: str) -> str:
    return f"""
select {group} as group_value, count(*) as user_count,
 {rnd("sum(g.gb100)", "count(g.gb100)*100", 1)} as mean_monthly_gb,
 {rnd("count(*) filter (where p.monthly_fee>=80000)*100", "count(*)", 1)} as high_fee_pct
from users u join plans p on p.plan_id=u.current_plan_id left join usage_figures g on g.user_id=u.user_id
group by 1"""


@check("p07_means_by_age_group", group_sql(
    "case when u.age>=80 then '80+' else cast(u.age//10*10 as varchar)||'-'||cast(u.age//10*10+9 as varchar) end"))
def _(c):
    return profiling.group_means(c.stage, "age_group")


@check("p07_means_by_plan", group_sql("p.plan_name"))
def _(c):
    return profiling.group_means(c.stage, "plan_name")


@check("p07_family_summary", f"""
select count(*) as users, count(family_id) as family_users,
 {rnd("count(family_id)*100", "count(*)", 1)} as family_user_pct,
 (select count(*) from families) as families,
 {rnd("(select count(*) from families where has_bundle)*100", "(select count(*) from families)", 1)} as enrolled_pct
from users""")
def _(c):
    return profiling.family_summary(c.stage)


@check("p07_family_sizes", """
select n as members, count(*) as family_count from (select family_id, count(*) as n from users
 where family_id is not null group by 1) group by 1""")
def _(c):
    return profiling.family_sizes(c.stage)
