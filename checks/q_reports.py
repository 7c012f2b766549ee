"""Reports, customer cases and recipes (A-*)."""

from pyspark.sql import functions as F

from checks.q_build import BENEFITS, CURRENT_PLAN, DISCOUNTS_NOW, FAMILY_NOW, P_MONTHLY, SELECTED, SERVICES_NOW
from checks.q_layers import GB2, MB
from checks.registry import END, REFERENCE, START, check, layer, rnd
from meterline import fixed_values as fixed
from meterline.plans import customer_cases as cases
from meterline.plans import operations_reports as ops
from meterline.plans import personal_reports as pers
from meterline.plans import query_catalog, recipes

MONTHS = (
    f"months as (select cast(unnest(generate_series(timestamp '{START}', "
    f"timestamp '{{end}}' - interval 1 month, interval 1 month)) as date) as calendar_month)"
)
LATE_END = "2002-02-01"
AS_OF = "2001-09-01"


@check("a01_plan_mix_by_age_band", f"""
select date '{REFERENCE}' as as_of_date, s.age_band, s.plan_id, p.plan_name, s.n as subscriber_count,
 {rnd("s.n*100", "sum(s.n) over (partition by s.age_band)", 2)} as age_band_share_pct
from o_subscribers s, plans p where p.plan_id=s.plan_id""")
def _(c):
    return ops.plan_mix_by_age_band(c.ops, REFERENCE)


def statistics_sql(end: str) -> str:
    return f"""
with {MONTHS.format(end=end)},
 r as (select *, row_number() over (partition by calendar_month order by k) as rn,
       count(*) over (partition by calendar_month) as n from o_customer_month),
 s as (select calendar_month, n, sum(k) as total,
       sum(case when rn in ((n+1)//2, n//2+1) then case when n%2=1 then 2*k else k end end) as mid
       from r group by all)
select m.calendar_month, coalesce(s.n,0) as recorded_customer_count,
 {rnd("s.total", "s.n*1024000", 2)} as average_monthly_usage_gb,
 {rnd("s.mid", "2048000", 2)} as median_monthly_usage_gb
from months m left join s on s.calendar_month=m.calendar_month"""


@check("a02_monthly_usage_statistics", statistics_sql(END))
def _(c):
    return ops.monthly_usage_statistics(c.ops, START, END)


@check("a02_monthly_usage_statistics_original", statistics_sql(END))
def _(c):
    return ops.monthly_usage_statistics(c.ops, START, END, preaggregated=False)


@check("a02_monthly_usage_statistics_all", statistics_sql(LATE_END))
def _(c):
    return ops.monthly_usage_statistics(c.ops, START, LATE_END)


@check("a03_usage_against_allowance", f"""
with {MONTHS.format(end=END)},
 s as (select plan_id, cast(sum(n) as bigint) as n from o_subscribers group by 1),
 u as (select strptime(cast(month_key as varchar),'%Y%m%d') as m, plan_id, sum(k) as k
       from o_monthly_segment group by all)
select m.calendar_month, date '{REFERENCE}' as as_of_date, p.plan_id, p.plan_name,
 s.n as subscriber_count, {rnd("u.k", "1024000", 2)} as total_usage_gb,
 {rnd("u.k", "1024000*s.n", 2)} as average_usage_per_subscriber_gb,
 cast(p.data_limit_gb as double) as data_limit_gb, p.is_unlimited,
 case when not p.is_unlimited and p.data_limit_gb>0 then
  {rnd("u.k*10000", "1024000*s.n*cast(p.data_limit_gb*100 as bigint)", 2)} end as base_allowance_usage_pct
from months m, s join plans p on p.plan_id=s.plan_id
left join u on u.m=m.calendar_month and u.plan_id=s.plan_id""")
def _(c):
    return ops.usage_against_allowance(c.ops, START, END, REFERENCE)


@check("a04_category_mix", f"""
select cast(strptime(cast(s.month_key as varchar),'%Y%m%d') as date) as calendar_month, s.plan_id,
 p.plan_name, s.age_band, s.content_category,
 (cast(s.k as double)/1000)/1024.0 as total_usage_gb,
 {rnd("s.k*100", "sum(s.k) over (partition by s.month_key, s.plan_id, s.age_band)", 2)}
   as category_usage_share_pct
from o_monthly_segment s, plans p
where p.plan_id=s.plan_id and s.month_key>=19960101 and s.month_key<19970101""")
def _(c):
    return ops.category_mix(c.ops, START, END)


def distribution_sql(end: str) -> str:
    buckets = ",".join(
        f"({n},'{label}',{low * 1024000},{'null' if high is None else high * 1024000})"
        for n, (label, low, high) in enumerate(fixed.USAGE_BUCKETS, 1)
    )
    return f"""
with {MONTHS.format(end=end)},
 b as (select * from (values {buckets}) t(no, label, lo, hi)),
 r as (select *, row_number() over (partition by calendar_month order by k desc, analysis_user_key)
       as rn, count(*) over (partition by calendar_month) as n from o_customer_month),
 d as (select m.calendar_month, 'distribution' as result_type, b.label as group_label,
       count(u.k) as n, coalesce(sum(u.k),0) as k
       from months m cross join b left join o_customer_month u on u.calendar_month=m.calendar_month
        and u.k>=b.lo and (b.hi is null or u.k<b.hi) group by all),
 t as (select m.calendar_month, 'concentration' as result_type,
       'top_'||cast(p as varchar)||'_pct' as group_label, count(r.k) as n, coalesce(sum(r.k),0) as k
       from months m cross join (values (1),(10)) v(p)
       left join r on r.calendar_month=m.calendar_month and r.rn<=(r.n*p+99)//100 group by all),
 w as (select calendar_month, count(*) as n, sum(k) as k from o_customer_month group by 1)
select g.calendar_month, g.result_type, g.group_label, g.n as customer_count,
 {rnd("g.n*100", "w.n", 2)} as customer_share_pct, {rnd("g.k", "1024000", 2)} as total_usage_gb,
 {rnd("g.k*100", "w.k", 2)} as usage_share_pct
from (select * from d union all select * from t) g
left join w on w.calendar_month=g.calendar_month"""


@check("a05_usage_distribution", distribution_sql(END))
def _(c):
    return ops.usage_distribution(c.ops, START, END)


@check("a05_usage_distribution_original", distribution_sql(END))
def _(c):
    return ops.usage_distribution(c.ops, START, END, preaggregated=False)


@check("a05_usage_distribution_all", distribution_sql(LATE_END))
def _(c):
    return ops.usage_distribution(c.ops, START, LATE_END)


@check("a06_bundle_internet_matrix", f"""
with g as (select * from (values (false,false),(false,true),(true,false),(true,true)) t(b,i)),
 n as (select has_bundle as b, has_home_internet as i, count(*) as n from families group by all)
select g.b as has_bundle, g.i as has_home_internet, coalesce(n.n,0) as family_count,
 {rnd("coalesce(n.n,0)*100", "(select count(*) from families)", 2)} as family_share_pct
from g left join n on n.b=g.b and n.i=g.i""")
def _(c):
    return ops.bundle_internet_matrix(c.ops)


# --- personalization, for all customers ------------------------------------------------------------

K1 = rnd("k", "1000", 1)


@check("a07_monthly_usage", f"""
select u.user_id, u.name, d.calendar_month, {K1} as total_usage_mb,
 {rnd(rnd("k", "days*1000", 3) + "*1000", "1000", 1)} as average_daily_usage_mb
from ({P_MONTHLY}) d, users u
where u.user_id=d.user_id and d.calendar_month between date '1996-02-01' and date '1996-06-01'""")
def _(c):
    return pers.monthly_usage(c.pers, None, "1996-02-10", "1996-06-03")


@check("a08_daily_usage_of_month", f"""
select u.user_id, u.name, d.usage_date as calendar_date, {K1} as daily_usage_mb,
 {rnd("running", "1000", 1)} as month_to_date_usage_mb
from p_daily d, users u where u.user_id=d.user_id and d.calendar_month=date '1996-03-01'""")
def _(c):
    return pers.daily_usage_of_month(c.pers, None, "1996-03")


@check("a09_detail_usage_of_day", f"""
select u.user_id, u.name, d.usage_date as calendar_date, d.content_category, d.content_detail,
 {K1} as data_usage_mb
from p_usage d, users u where u.user_id=d.user_id and d.usage_date=date '1996-03-05'""")
def _(c):
    return pers.detail_usage_of_day(c.pers, None, "1996-03-05")


@check("a10_monthly_category_usage", f"""
select u.user_id, u.name, d.calendar_month, d.content_category, {rnd("sum(k)", "1000", 1)} as total_usage_mb
from p_month_content d, users u where u.user_id=d.user_id and d.calendar_month=date '1996-03-01'
group by u.user_id, u.name, d.calendar_month, d.content_category""")
def _(c):
    return pers.monthly_category_usage(c.pers, None, "1996-03")


@check("a11_monthly_detail_usage", f"""
select u.user_id, u.name, d.calendar_month, d.content_category, d.content_detail,
 {K1} as total_usage_mb
from p_month_content d, users u where u.user_id=d.user_id and d.calendar_month=date '1996-03-01'""")
def _(c):
    return pers.monthly_detail_usage(c.pers, None, "1996-03")


@check("a12_selected_service_usage", SELECTED.replace(MB, K1) + " and d.calendar_month=date '1996-03-01'")
def _(c):
    return pers.selected_service_usage(c.pers, None, "1996-03")


LATEST = "(select max(usage_date) from r_daily)"


@check("a13_recent_usage", f"""
select u.user_id, u.name,
 {rnd(f"sum(k) filter (where usage_date>={LATEST}-6)", "1000", 1)} as trailing_7d_usage_mb,
 {rnd("sum(k)", "1000", 1)} as trailing_30d_usage_mb, {LATEST} as reference_date
from r_daily d, users u
where u.user_id=d.user_id and usage_date between {LATEST}-29 and {LATEST}
group by u.user_id, u.name""")
def _(c):
    return pers.recent_usage(c.now, None)


@check("a14_current_plan", CURRENT_PLAN)
def _(c):
    return pers.current_plan(c.pers, None)


@check("a15_current_services", SERVICES_NOW)
def _(c):
    return pers.current_services(c.pers, None)


@check("a16_current_discounts", DISCOUNTS_NOW)
def _(c):
    return pers.current_discounts(c.pers, None)


@check("a17_family_status", FAMILY_NOW)
def _(c):
    return pers.family_status(c.pers, None)


@check("a18_recommendation_context", f"""
select p.*,
 {rnd(f"sum(k) filter (where usage_date>={LATEST}-6)", "1000", 1)} as trailing_7d_usage_mb,
 {rnd(f"sum(k) filter (where usage_date>={LATEST}-29)", "1000", 1)} as trailing_30d_usage_mb,
 {rnd(f"sum(k) filter (where calendar_month=date_trunc('month',{LATEST}))", "1000", 1)}
   as current_month_usage_mb,
 {LATEST} as reference_date
from ({CURRENT_PLAN}) p, r_daily d where d.user_id=p.user_id group by all""")
def _(c):
    return pers.recommendation_context(c.now, None)


@check("a19_plan_candidates", """
select plan_id, plan_name, plan_family, plan_category, cast(monthly_fee as double) as monthly_fee,
 cast(data_limit_gb as double) as data_limit_gb, is_unlimited, choice_tier, network_type
from plans where monthly_fee between 40000 and 80500""")
def _(c):
    return pers.plan_candidates(c.pers, 40000, 80500)


@check("a20_plan_benefits", f"select * from ({BENEFITS}) where plan_id='P3003'")
def _(c):
    return pers.plan_benefits(c.pers, "P3003")


@check("a21_available_dates", """
select u.user_id, u.name, min(usage_date) as min_date, max(usage_date) as max_date
from p_daily d, users u where u.user_id=d.user_id group by u.user_id, u.name""")
def _(c):
    return pers.available_dates(c.pers, None)


@check("a22_catalog_run", f"""
select u.user_id, u.name, d.calendar_month, {K1} as total_usage_mb,
 {rnd(rnd("k", "days*1000", 3) + "*1000", "1000", 1)} as average_daily_usage_mb
from ({P_MONTHLY}) d, users u
where u.user_id=d.user_id and u.user_id='U0000011'
 and d.calendar_month between date '1996-01-01' and date '1998-12-01'""")
def _(c):
    return query_catalog.run(
        c.pers, "PERS_001",
        {"user_id": "U0000011", "from_month": "1996-01-15", "to_month": "1998-12-31"},
    )


# --- customer cases --------------------------------------------------------------------------------

DAYS = 25


def window_sql(having: str) -> str:
    return f"""
select user_id, sum(k) as k from r_daily where usage_date between {LATEST}-29 and {LATEST}
group by user_id having count(*)>={DAYS} and {having}"""


CASE1 = f"""
with w as (select user_id, sum(k) as k,
  coalesce(sum(k) filter (where content_detail in ('youtube_video','youtube_shorts','youtube_music')),0) as b
  from r_usage where usage_date between {LATEST}-29 and {LATEST}
  group by user_id having count(distinct usage_date)>={DAYS}),
 s as (select c.user_id, string_agg(distinct a.service_name, ', ' order by a.service_name) as names,
  bool_or(c.service_id='S002') as has from user_services c, additional_services a
  where a.service_id=c.service_id and c.start_date<=date '2024-01-31' group by 1),
 o as (select distinct plan_id from plan_benefits where service_id='S002')
select u.user_id, u.name, p.plan_name, cast(p.monthly_fee as double) as monthly_fee, p.is_unlimited,
 {rnd("w.k", "1024000", 2)} as usage_30d_gb, {rnd("w.b", "1024000", 2)} as brand_30d_gb,
 {rnd("w.b*100", "w.k", 1)} as brand_share_pct,
 coalesce(s.names,'{fixed.NO_CHOSEN_SERVICE}') as current_services,
 case when o.plan_id is not null then '{fixed.BENEFIT_NOT_CHOSEN}'
  when p.is_unlimited and p.plan_family not in ('CHOICE','CHOICE_DOUBLE') then '{fixed.BENEFIT_OUTSIDE_CHOICE}'
  else '{fixed.BENEFIT_ABSENT}' end as case_detail, {LATEST} as usage_end_date
from users u join plans p on p.plan_id=u.current_plan_id join w on w.user_id=u.user_id
left join s on s.user_id=u.user_id left join o on o.plan_id=p.plan_id
where w.b>=409600 and w.b*10>=w.k and not coalesce(s.has,false)"""
CASE1_OPTIONS = {"min_gb": "0.4", "min_share": "0.10", "min_observed_days": DAYS}


@check("a23_video_benefit_mismatch", CASE1)
def _(c):
    return cases.video_benefit_mismatch(c.now, **CASE1_OPTIONS, top=None)


@check("a23_video_benefit_mismatch_top", CASE1 + " order by w.b desc, u.user_id limit 10")
def _(c):
    return cases.video_benefit_mismatch(c.now, **CASE1_OPTIONS)


@check("a23_video_benefit_mismatch_narrow", CASE1 + """
 and p.is_unlimited and p.plan_family not in ('CHOICE','CHOICE_DOUBLE') and p.monthly_fee>=40000
 and p.monthly_fee<90000 and o.plan_id is null""")
def _(c):
    return cases.video_benefit_mismatch(
        c.now, **CASE1_OPTIONS, unlimited_outside_choice=(40000, 90000), top=None
    )


CASE2 = f"""
with w as ({window_sql("sum(k)>=3*1024000")})
select u.user_id, u.name, p.plan_name, cast(p.monthly_fee as double) as monthly_fee,
 cast(p.data_limit_gb as double) as base_data_limit_gb, {rnd("w.k", "1024000", 2)} as usage_30d_gb,
 {LATEST} as usage_end_date
from users u, plans p, w
where p.plan_id=u.current_plan_id and w.user_id=u.user_id and p.monthly_fee<=71500
 and not p.is_unlimited and p.data_limit_gb<=30"""
CASE2_OPTIONS = {"min_gb": 3, "max_fee": 71500, "min_observed_days": DAYS}


@check("a24_high_usage_low_fee", CASE2)
def _(c):
    return cases.high_usage_low_fee(c.now, **CASE2_OPTIONS, top=None)


@check("a24_high_usage_low_fee_top", CASE2 + " order by w.k desc, p.monthly_fee, u.user_id limit 10")
def _(c):
    return cases.high_usage_low_fee(c.now, **CASE2_OPTIONS)


CASE3 = f"""
with w as ({window_sql("sum(k)<3*1024000")})
select u.user_id, u.name, p.plan_name, cast(p.monthly_fee as double) as monthly_fee, p.is_unlimited,
 {rnd("w.k", "1024000", 2)} as usage_30d_gb, {LATEST} as usage_end_date
from users u, plans p, w
where p.plan_id=u.current_plan_id and w.user_id=u.user_id and p.monthly_fee>=80000"""
CASE3_OPTIONS = {"below_gb": 3, "min_observed_days": DAYS}


@check("a25_low_usage_high_fee", CASE3)
def _(c):
    return cases.low_usage_high_fee(c.now, **CASE3_OPTIONS, top=None)


@check("a25_low_usage_high_fee_top", CASE3 + " order by p.monthly_fee desc, w.k, u.user_id limit 10")
def _(c):
    return cases.low_usage_high_fee(c.now, **CASE3_OPTIONS)


CASE4A = f"""
with m as (select * from lines where family_bundle_eligible),
 s as (select family_id, count(*) as n, count(*) filter (where monthly_fee>=77000) as h from m group by 1),
 r as (select *, row_number() over (partition by family_id order by monthly_fee, age desc,
       subscription_start_date, user_id) as rk from m where monthly_fee>=77000)
select r.user_id, r.name, r.plan_name, cast(r.monthly_fee as double) as monthly_fee, r.family_id,
 s.n as member_count, s.h as high_fee_line_count,
 {rnd("cast(r.monthly_fee*100 as bigint)*25", "10000", 0)} as potential_premium_discount_per_month,
 '{fixed.PREMIUM_NOT_ENROLLED}' as case_detail
from r, s, families f
where s.family_id=r.family_id and f.family_id=r.family_id and not f.has_bundle and f.has_home_internet
 and f.internet_status='ACTIVE' and f.internet_product_group='BASIC_ESSENCE_PREMIUM' and s.h>=2
 and s.n<=10 and r.plan_family in ('CHOICE','CHOICE_DOUBLE') and r.rk>1
 and not exists (select 1 from current_discounts d where d.user_id=r.user_id and d.discount_id='D003')"""


@check("a26_premium_family_not_enrolled", CASE4A)
def _(c):
    return cases.premium_family_not_enrolled(c.pers, AS_OF, top=None)


@check("a26_premium_family_not_enrolled_top", CASE4A + """
 order by potential_premium_discount_per_month desc, r.family_id, r.user_id limit 10""")
def _(c):
    return cases.premium_family_not_enrolled(c.pers, AS_OF)


CASE4B = f"""
with m as (select * from lines where family_bundle_eligible),
 s as (select family_id, count(*) as n, sum(monthly_fee) as fee from m group by 1)
select m.user_id, m.name, m.plan_name, cast(m.monthly_fee as double) as monthly_fee, f.family_id,
 s.n as member_count, cast(s.fee as double) as family_total_monthly_fee, f.internet_product_group,
 cast(f.internet_contract_months as bigint) as internet_contract_months,
 cast(r.discount_amount as double) as potential_family_mobile_discount,
 '{fixed.TOTAL_NOT_ENROLLED}' as case_detail
from m, s, families f, internet_bundle_discount_rules r
where s.family_id=m.family_id and f.family_id=m.family_id and not f.has_bundle
 and f.has_home_internet and f.internet_status='ACTIVE' and s.n>=2 and r.discount_id='D001'
 and r.rule_type='MOBILE_TOTAL_POOL' and r.discount_amount>0
 and r.internet_product_group in (f.internet_product_group,'ANY')
 and r.contract_months=f.internet_contract_months and s.fee>=r.mobile_total_fee_min
 and (r.mobile_total_fee_max is null or s.fee<=r.mobile_total_fee_max)
 and not exists (select 1 from current_discounts d, m fm where fm.user_id=d.user_id
  and fm.family_id=f.family_id)"""


@check("a27_total_bundle_not_enrolled", CASE4B)
def _(c):
    return cases.total_bundle_not_enrolled(c.pers, AS_OF, top=None)


@check("a27_total_bundle_not_enrolled_top", CASE4B + """
 order by potential_family_mobile_discount desc, f.family_id, m.user_id limit 10""")
def _(c):
    return cases.total_bundle_not_enrolled(c.pers, AS_OF)


layer("discounts_now", """
select user_id, discount_id from user_discounts
where status='ACTIVE' and (end_date is null or end_date>=date '2024-01-31')""")


@check("a36_all_cases", f"""
select 'video_benefit_mismatch' as case_name, user_id from ({CASE1})
union all select 'high_usage_low_fee', user_id from ({CASE2})
union all select 'low_usage_high_fee', user_id from ({CASE3})
union all select 'premium_family_not_enrolled', user_id from ({CASE4A.replace("current_discounts", "discounts_now")})
union all select 'total_bundle_not_enrolled', user_id from ({CASE4B.replace("current_discounts", "discounts_now")})""")
def _(c):
    whole = {"top": None}
    return cases.case_members(
        cases.all_cases(
            c.now, "2024-01-31",
            video_benefit_mismatch={**CASE1_OPTIONS, **whole},
            high_usage_low_fee={**CASE2_OPTIONS, **whole},
            low_usage_high_fee={**CASE3_OPTIONS, **whole},
            premium_family_not_enrolled=whole,
            total_bundle_not_enrolled=whole,
        )
    )


# --- recipes ---------------------------------------------------------------------------------------


@check("a28_user_with_plan", """
select u.user_id, u.name, p.plan_name, cast(p.monthly_fee as double) as monthly_fee,
 cast(p.data_limit_gb as double) as data_limit_gb, p.is_unlimited
from users u, plans p where p.plan_id=u.current_plan_id""")
def _(c):
    return recipes.user_with_plan(c.stage)


@check("a29_user_discount_kinds", """
select u.user_id, u.name, d.discount_id, d.discount_name, b.component_role, x.start_date
from users u, user_discounts x, discounts d, bundle_discount_compositions b
where x.user_id=u.user_id and d.discount_id=x.discount_id
 and b.bundle_composition_id=x.bundle_composition_id and x.status='ACTIVE'""")
def _(c):
    return recipes.user_discount_kinds(c.stage)


@check("a30_family_internet", """
select u.user_id, f.family_id, f.internet_product_group,
 cast(f.internet_contract_months as bigint) as internet_contract_months, f.bundle_discount_method,
 f.internet_benefit_discount_id from users u, families f where f.family_id=u.family_id""")
def _(c):
    return recipes.family_internet(c.stage)


@check("a31_family_mobile_total", """
select c.family_id, cast(sum(l.monthly_fee) as double) as mobile_total_fee
from bundle_discount_compositions c, lines l, families f
where l.user_id=c.user_id and f.family_id=c.family_id and c.component_type='MOBILE'
 and (f.bundle_type='INTERNET_MOBILE' or c.component_role in ('BASE_MOBILE','LOW_MOBILE'))
group by c.family_id""")
def _(c):
    return recipes.family_mobile_total(c.stage)


@check("a32_daily_usage", """
select user_id, usage_date, cast(sum(cast(data_usage_mb*1000 as bigint)) as double)/1000 as daily_data_mb
from content_usage group by all""")
def _(c):
    return recipes.daily_usage(c.stage)


@check("a32_observed_usage", """
select user_id, cast(sum(cast(data_usage_mb*1000 as bigint)) as double)/1000/1024.0 as observed_data_gb
from content_usage group by all""")
def _(c):
    return recipes.observed_usage(c.stage)


@check("a33_offered_services", """
select u.user_id, p.plan_name, a.service_name as available_service, s.service_id is not null as is_selected
from users u join plans p on p.plan_id=u.current_plan_id
join plan_benefits b on b.plan_id=p.plan_id and b.is_selectable
join additional_services a on a.service_id=b.service_id
left join user_services s on s.user_id=u.user_id and s.service_id=b.service_id""")
def _(c):
    return recipes.offered_services(c.stage)


@check("a34_quota_utilization", """
with m as (select user_id, cast(date_trunc('month',usage_date) as date) as usage_month,
  cast(sum(cast(data_usage_mb*1000 as bigint)) as double)/1000/1024.0 as gb,
  count(distinct usage_date) as days from content_usage group by all)
select m.user_id, m.usage_month, m.gb as monthly_usage_gb, m.days as observed_days,
 cast(p.data_limit_gb as double) as data_limit_gb,
 case when not p.is_unlimited and p.data_limit_gb>0 then m.gb/cast(p.data_limit_gb as double) end
  as quota_utilization
from m, users u, plans p where u.user_id=m.user_id and p.plan_id=u.current_plan_id""")
def _(c):
    return recipes.quota_utilization(c.stage)


@check("a35_service_usage", """
select c.user_id, b.service_id as mapped_service_id, a.service_name,
 cast(sum(cast(data_usage_mb*1000 as bigint)) as double)/1000 as service_usage_mb
from content_usage c, bridge b, additional_services a
where b.content_detail=c.content_detail and a.service_id=b.service_id group by all""")
def _(c):
    return recipes.service_usage(c.stage)


CHOSEN = """
with s as (select user_id, content_detail, sum(cast(data_usage_mb*1000 as bigint)) as k
  from content_usage group by all)
select x.user_id, x.service_id, a.service_name, t.content_detail, cast(t.k as double)/1000 as usage_mb
from user_services x join additional_services a on a.service_id=x.service_id
left join (select s.*, b.service_id from s, bridge b where b.content_detail=s.content_detail) t
 on t.user_id=x.user_id and t.service_id=x.service_id"""


@check("a35_chosen_service_usage", CHOSEN)
def _(c):
    return recipes.chosen_service_usage(c.stage)


@check("j11_family_members", """
select m.user_id, m.name, cast(m.age as bigint) as age, m.gender, m.subscription_start_date,
 m.current_plan_id, m.family_id
from users t, users m where m.family_id=t.family_id and t.user_id='U0000011'""")
def _(c):
    return recipes.family_members(c.stage, "U0000011")
