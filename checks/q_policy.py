"""Discount policy (D-*) and customer features (R-*)."""

from pyspark.sql import functions as F

from checks.registry import REFERENCE, check, layer, rnd
from meterline.operators.lookup import with_amounts
from meterline.plans import discount_policy as policy
from meterline.plans import features, rollover

GUARDIANS = "select user_id from users where age between 20 and 70"

layer("family_counts", """
select f.*, coalesce(x.n,0) as mobile_lines, coalesce(x.h,0) as high_lines
from families f left join (select family_id, count(*) as n,
 count(*) filter (where monthly_fee>=77000) as h from lines group by 1) x on x.family_id=f.family_id""")
layer("base_rows", """
select family_id, user_id as base_user_id from (
 select *, row_number() over (partition by family_id order by case when monthly_fee>=77000 then 0 else 1 end,
  monthly_fee, age desc, subscription_start_date, user_id) as rn from lines) where rn=1""")
layer("counted_rows", """
select l.*, f.internet_product_group as grp, f.internet_contract_months as term, f.bundle_type
from lines l, family_counts f, base_rows b
where f.family_id=l.family_id and b.family_id=l.family_id and f.internet_status='ACTIVE'
 and f.internet_product_group is not null and f.internet_contract_months is not null
 and (f.bundle_type is null or f.bundle_type<>'PREMIUM_FAMILY' or f.high_lines>=2)
 and (f.bundle_type is null or f.bundle_type<>'PREMIUM_FAMILY' or l.user_id=b.base_user_id
      or l.monthly_fee<77000)""")


def rule_amount(discount: str, method: str, kind: str, grp: str, term: str, total: str | None = None,
                line: str | None = None) -> str:
    extra = ""
    if total:
        extra += (f" and {total}>=r.mobile_total_fee_min"
                  f" and (r.mobile_total_fee_max is null or {total}<=r.mobile_total_fee_max)")
    if line:
        extra += (f" and {line}>=r.mobile_line_fee_min"
                  f" and (r.mobile_line_fee_max is null or {line}<=r.mobile_line_fee_max)")
    return (f"(select r.discount_amount from internet_bundle_discount_rules r where "
            f"r.discount_id='{discount}' and r.bundle_discount_method='{method}' "
            f"and r.rule_type='{kind}' and r.contract_months={term} "
            f"and r.internet_product_group in ({grp},'ANY'){extra})")


layer("savings", f"""
select family_id, mobile_total,
 {rule_amount("D001", "TOTAL", "MOBILE_TOTAL_POOL", "grp", "term", total="mobile_total")}
 +{rule_amount("D005", "TOTAL", "INTERNET_BASE", "grp", "term", total="mobile_total")}
 +{rule_amount("D005", "TOTAL", "INTERNET_ADDITIONAL", "grp", "term")} as total_saving,
 fixed_mobile+{rule_amount("D005", "FIXED", "INTERNET_BASE", "grp", "term")}
 +{rule_amount("D005", "FIXED", "INTERNET_ADDITIONAL", "grp", "term")} as fixed_saving
from (select family_id, grp, term, sum(monthly_fee) as mobile_total, sum(line_amount) as fixed_mobile
 from (select c.*, {rule_amount("D002", "FIXED", "MOBILE_LINE", "c.grp", "c.term", line="c.monthly_fee")}
  as line_amount from counted_rows c) group by family_id, grp, term)""")


@check("d01_line_rule_amounts", f"""
select l.user_id, cast({rule_amount("D002", "FIXED", "MOBILE_LINE", "f.internet_product_group",
 "f.internet_contract_months", line="l.monthly_fee")} as double) as amount
from lines l, families f where f.family_id=l.family_id and f.internet_product_group is not null""")
def _(c):
    families = c.stage.families.where(F.col("internet_product_group").isNotNull())
    lines = with_amounts(
        policy.family_lines(c.stage).join(families, "family_id"), c.stage.internet_bundle_discount_rules,
        amount=(policy.FIXED_LINE, "monthly_fee", "mobile_line_fee"),
    )
    return lines.select("user_id", "amount")


@check("d02_method_savings", """
select family_id, cast(mobile_total as double) as mobile_total,
 cast(total_saving as double) as total_saving, cast(fixed_saving as double) as fixed_saving
from savings""")
def _(c):
    return policy.method_savings(c.stage)


@check("d03_base_lines", """
select b.family_id, b.base_user_id, max(l.subscription_start_date) as bundle_start
from base_rows b, lines l where l.family_id=b.family_id group by 1,2""")
def _(c):
    return policy.base_lines(c.stage)


PREFERRED = """
select family_id, case when total_saving>fixed_saving then 'TOTAL' else 'FIXED' end
 as preferred_method from savings"""


@check("d04_preferred_methods", PREFERRED)
def _(c):
    return policy.preferred_methods(c.stage)


@check("d04_method_mismatch", f"""
select count(*) as enrolled_families,
 count(*) filter (where f.bundle_discount_method=p.preferred_method) as matching_families,
 count(*) filter (where p.preferred_method is null or f.bundle_discount_method<>p.preferred_method)
  as mismatched_families,
 {rnd('''count(*) filter (where p.preferred_method is null
   or f.bundle_discount_method<>p.preferred_method)*100''', "count(*)", 1)} as mismatch_pct
from families f left join ({PREFERRED}) p on p.family_id=f.family_id where f.has_bundle""")
def _(c):
    return policy.method_mismatch(c.stage)


ACTIVE = f"""
select x.user_id, x.discount_id, b.family_id, p.monthly_fee, f.internet_product_group as grp,
 f.internet_contract_months as term, f.total_discount_allocation_method as how
from user_discounts x, bundle_discount_compositions b, families f, users u, plans p
where x.status='ACTIVE' and x.start_date<=date '{REFERENCE}'
 and (x.end_date is null or x.end_date>=date '{REFERENCE}')
 and b.bundle_composition_id=x.bundle_composition_id and f.family_id=b.family_id
 and u.user_id=x.user_id and p.plan_id=u.current_plan_id"""
# Amounts in 1/10,000,000 won, so that a split pool sums exactly as the rounded shares do.
AMOUNTS = f"""
with a as ({ACTIVE}),
 g as (select family_id, sum(monthly_fee) as fee, count(*) as n from a where discount_id='D001' group by 1),
 v as (select a.user_id, case a.discount_id
   when 'D001' then case a.how when 'EQUAL'
     then cast({rule_amount("D001", "TOTAL", "MOBILE_TOTAL_POOL", "a.grp", "a.term", total="g.fee")} as double)/g.n
     else cast({rule_amount("D001", "TOTAL", "MOBILE_TOTAL_POOL", "a.grp", "a.term", total="g.fee")} as double)
          *cast(a.monthly_fee as double)/cast(g.fee as double) end
   when 'D002' then cast({rule_amount("D002", "FIXED", "MOBILE_LINE", "a.grp", "a.term", line="a.monthly_fee")} as double)
   when 'D003' then cast(a.monthly_fee as double)*0.25 else 5500 end as amount
  from a left join g on g.family_id=a.family_id)
select u.user_id, coalesce(round(sum(v.amount),2),0) as current_total_discount_amount
from users u left join v on v.user_id=u.user_id group by u.user_id"""


@check("d05_current_discount_amounts", AMOUNTS)
def _(c):
    return policy.current_discount_amounts(c.stage, REFERENCE)


@check("d06_line_counts", "select family_id, mobile_lines, high_lines from family_counts")
def _(c):
    return policy.line_counts(c.stage).select("family_id", "mobile_lines", "high_lines")


@check("d07_family_features", """
select u.user_id, coalesce(f.mobile_lines,0) as family_member_count,
 coalesce(f.internet_status='ACTIVE' and not f.has_bundle,false) as eligible_for_family_bundle
from users u left join family_counts f on f.family_id=u.family_id""")
def _(c):
    return policy.family_features(c.stage)


@check("d08_enrolment_funnel", """
select count(*) filter (where high_lines>=2) as eligible,
 count(*) filter (where high_lines>=2 and internet_status='ACTIVE' and has_bundle) as eligible_active_enrolled,
 count(*) filter (where high_lines>=2 and internet_status='ACTIVE' and not has_bundle) as eligible_active_not_enrolled,
 count(*) filter (where high_lines>=2 and internet_status<>'ACTIVE') as eligible_inactive_internet,
 count(*) filter (where has_bundle and bundle_type='INTERNET_MOBILE') as general_enrolled,
 count(*) filter (where has_bundle and bundle_type='PREMIUM_FAMILY') as premium_enrolled,
 count(*) filter (where has_bundle) as enrolled from family_counts""")
def _(c):
    return policy.enrolment_funnel(c.stage)


ELIGIBLE = ("(high_lines>=2 and mobile_lines<=10 and "
            "coalesce(internet_product_group='BASIC_ESSENCE_PREMIUM',false))")


@check("d09_bundle_types", f"""
select family_id, mobile_lines, high_lines, {ELIGIBLE} as premium_eligible,
 case when has_bundle then case when {ELIGIBLE} then 'PREMIUM_FAMILY' else 'INTERNET_MOBILE' end end
  as policy_bundle_type from family_counts""")
def _(c):
    return policy.bundle_types(c.stage)


layer("made_components", """
select f.family_id||'-'||l.user_id as bundle_composition_id, f.family_id, 'MOBILE' as component_type,
 l.user_id, case when l.user_id=b.base_user_id then 'BASE_MOBILE'
  when f.bundle_type='PREMIUM_FAMILY' and l.monthly_fee>=77000 then 'PREMIUM_MOBILE'
  else 'LOW_MOBILE' end as component_role,
 max(l.subscription_start_date) over (partition by f.family_id) as start_date
from families f, base_rows b, lines l
where b.family_id=f.family_id and l.family_id=f.family_id and f.has_bundle
 and f.internet_product_group is not null""")


@check("d10_bundle_components", """
select * from made_components
union all
select distinct family_id||'-INTERNET', family_id, 'INTERNET', cast(null as varchar), 'BASE_INTERNET',
 start_date from made_components""")
def _(c):
    return policy.bundle_components(c.stage)


layer("made_rows", f"""
select m.*, l.monthly_fee, l.age, l.network_type, f.bundle_discount_method as method, f.bundle_type,
 f.internet_product_group as grp, f.internet_contract_months as term,
 sum(case when m.component_role<>'PREMIUM_MOBILE' then l.monthly_fee end)
  over (partition by m.family_id) as pool_fee,
 exists (select 1 from lines g, ({GUARDIANS}) w where w.user_id=g.user_id and g.family_id=m.family_id
  and g.monthly_fee>=80000 and g.network_type='5G') as guarded
from made_components m, lines l, families f where l.user_id=m.user_id and f.family_id=m.family_id""")
YOUNG = f"""(bundle_type='PREMIUM_FAMILY' and guarded and age>=0 and age<20 and monthly_fee>=80000
 and network_type='5G' and (age<=18
 or start_date<=date '{REFERENCE}'-to_months(12*(cast(age as integer)-18))))"""
METHOD_ENTITLEMENTS = f"""
select user_id, bundle_composition_id, 'D001' as discount_id, start_date from made_rows
where component_role<>'PREMIUM_MOBILE' and method='TOTAL'
 and {rule_amount("D001", "TOTAL", "MOBILE_TOTAL_POOL", "grp", "term", total="pool_fee")}>0
union all select user_id, bundle_composition_id, 'D002', start_date from made_rows
where component_role<>'PREMIUM_MOBILE' and method='FIXED'
 and {rule_amount("D002", "FIXED", "MOBILE_LINE", "grp", "term", line="monthly_fee")}>0
union all select user_id, bundle_composition_id, 'D003', start_date from made_rows
where component_role='PREMIUM_MOBILE'"""


def _entitlements(c):
    guardians = c.stage.users.where(F.col("age").between(20, 70)).select("user_id")
    return policy.mobile_entitlements(c.stage, REFERENCE, guardians)


@check("d11_mobile_entitlements", METHOD_ENTITLEMENTS + f"""
union all select user_id, bundle_composition_id, 'D004', start_date from made_rows where {YOUNG}""")
def _(c):
    return _entitlements(c)


@check("d12_youth_entitlements", f"""
select user_id, bundle_composition_id, 'D004' as discount_id, start_date from made_rows where {YOUNG}""")
def _(c):
    return _entitlements(c).where(F.col("discount_id") == "D004")


@check("d13_internet_benefits", """
select family_id, case when has_bundle then 'D005' end as internet_benefit_discount_id from families""")
def _(c):
    return policy.internet_benefits(c.stage)


# --- features --------------------------------------------------------------------------------------

layer("day_usage", """
select user_id, usage_date, cast(date_trunc('month',usage_date) as date) as m,
 cast(sum(cast(data_usage_mb*1000 as bigint)) as bigint) as k from content_usage group by all""")
layer("user_benefit", """
select u.user_id, u.age, u.current_plan_id, a.age_benefit_id, a.benefit_name, a.includes_safety_box,
 b.age_benefit_id is not null as offered, coalesce(b.bonus_data_gb,0) as bd,
 coalesce(b.bonus_shared_data_gb,0) as bs, coalesce(b.bonus_voice_minutes,0) as bv,
 coalesce(b.bonus_sms_count,0) as bm, coalesce(b.bonus_video_minutes,0) as bw
from users u left join age_benefits a on u.age>=a.min_age and (a.max_age is null or u.age<=a.max_age)
left join plan_age_benefits b on b.plan_id=u.current_plan_id and b.age_benefit_id=a.age_benefit_id""")
layer("usage_figures", f"""
select u.user_id, d.avg_mb, d.avg100, {rnd("d.avg100*30", "102400", 2)} as gb,
 cast(floor((2*d.avg100*30*100+102400)/204800) as bigint) as gb100, t.content_category
from users u
left join (select user_id, {rnd("sum(k)", "count(*)*1000", 2)} as avg_mb,
 cast((2*sum(k)*100+count(*)*1000)//(2*count(*)*1000) as bigint) as avg100 from day_usage group by 1) d
 on d.user_id=u.user_id
left join (select user_id, content_category from (select user_id, content_category,
  row_number() over (partition by user_id order by sum(data_usage_mb) desc, content_category) as rn
  from content_usage group by user_id, content_category) where rn=1) t on t.user_id=u.user_id""")

TRAITS = """
select user_id, age, family_id, cast(age%10 as double)/10 as spending,
 case age%3 when 0 then 'video' when 1 then 'web' else 'music' end as taste from users"""


def _traits(c):
    age = F.col("age")
    return c.stage.users.select(
        "user_id",
        ((age % 10).cast("double") / 10).alias("plan_spending_score"),
        F.when(age % 3 == 0, "video").when(age % 3 == 1, "web").otherwise("music").alias(
            "content_affinity"
        ),
    )


def score_sql() -> str:
    return f"""
with t as ({TRAITS}),
 n as (select user_id, cast(sum(k) as double)/1000/count(*)*30.0/1024.0 as need from day_usage group by 1),
 p as (select t.*, coalesce(n.need,0) as need, q.plan_id, q.plan_family, cast(q.monthly_fee as double) as fee, q.is_unlimited,
  q.is_rollover, cast(coalesce(q.data_limit_gb,0) as double)+cast(coalesce(b.bonus_data_gb,0) as double) as cap,
  30000.0+25000.0*t.spending+least(40000.0,coalesce(n.need,0)*300.0) as target
  from t left join n on n.user_id=t.user_id cross join plans q
  left join user_benefit ub on ub.user_id=t.user_id
  left join plan_age_benefits b on b.plan_id=q.plan_id and b.age_benefit_id=ub.age_benefit_id),
 r as (select *, need/greatest(cap,0.05) as used from p),
 s as (select user_id, plan_id,
  -2.6*abs(ln(greatest(fee,1.0))-ln(greatest(target,1.0)))
  +case when is_unlimited then case when need>=80 then 2.0 when need>=40 then 0.8 when need<10 then -1.6 else 0.0 end
   when used>=0.55 and used<=1.15 then 2.2 when used>=0.25 and used<0.55 then 0.9
   when used>1.15 and used<=1.5 then -0.4 when used>1.5 then -2.2 else -0.8 end
  +case when plan_family='VOICE' then case when is_unlimited or need<=greatest(cap,0.6)*1.3 then 1.2 else -2.0 end else 0.0 end
  +case when is_rollover and (is_unlimited or need<greatest(cap,1.0)) then 0.1 else 0.0 end
  +case when plan_family in ('CHOICE','CHOICE_DOUBLE') then case when age between 19 and 39 then 0.3 else 0.0 end
   +case when taste in ('video','music','short_form') then 0.5 else 0.0 end+0.45*spending else 0.0 end
  +case when plan_family='CHOICE_DOUBLE' then case when spending>=0.7 then 0.15 else -0.15 end else 0.0 end
  +case when family_id is not null and fee>=77000 then 0.12 else 0.0 end as score from r)"""


@check("r01_plan_fit", score_sql() + """
select user_id, plan_id, place as fit_rank, round(score,6) as fit_score from (select *, row_number() over (partition by user_id
  order by round(score,9) desc, plan_id) as place from s) where place<=3""")
def _(c):
    return features.plan_fit(c.stage, _traits(c), top=3).select(
        "user_id", "plan_id", "fit_rank", F.round("fit_score", 6).alias("fit_score")
    )


@check("r01_best_plan", score_sql() + """
select user_id, first(plan_id order by round(score,9) desc, plan_id) as plan_id, round(max(score),6) as fit_score from s group by 1""")
def _(c):
    return features.plan_fit(c.stage, _traits(c), top=1).select(
        "user_id", "plan_id", F.round("fit_score", 6).alias("fit_score")
    )


@check("r02_quota_stages", """
with d as (select d.*, coalesce(sum(k) over (partition by d.user_id, m order by usage_date
  rows between unbounded preceding and 1 preceding),0) as before, p.is_unlimited,
  cast(coalesce(p.data_limit_gb,0) as double)*1024.0 as allowance
  from day_usage d, users u, plans p where u.user_id=d.user_id and p.plan_id=u.current_plan_id),
 s as (select *, cast(before as double)/1000 as used from d)
select user_id, usage_date, cast(k as double)/1000 as total_usage_mb,
 case when is_unlimited then 'NORMAL' when allowance<=0 or used/allowance>=1 then 'DEPLETED'
  when used/allowance>=0.95 then 'CRITICAL' when used/allowance>=0.85 then 'SAVE'
  when used/allowance>=0.70 then 'WATCH' else 'NORMAL' end as quota_stage,
 case when not is_unlimited and allowance>0 then round(used/allowance,6) end as quota_usage_ratio
from s""")
def _(c):
    return features.daily_quota_stages(c.stage)


#: Months of users on rollover plans one after the other.
ROLLOVER = """
with b as (select u.user_id, cast(coalesce(p.data_limit_gb,0)*1024000 as bigint) as base
  from users u, plans p where p.plan_id=u.current_plan_id and p.is_rollover and not p.is_unlimited),
 k as (select user_id, m, cast(sum(k) as bigint) as used from day_usage group by 1,2),
 e as (select b.user_id, b.base, min(k.m) as first, max(k.m) as last from b, k
  where k.user_id=b.user_id group by 1,2),
 f(user_id, base, m, last, carry, used) as (select user_id, base, first as m, last, cast(0 as bigint) as carry,
   coalesce((select used from k where k.user_id=e.user_id and k.m=e.first),0) as used from e
  union all
  select f.user_id, f.base, cast(f.m+interval 1 month as date), f.last,
   least(greatest(f.base+f.carry-f.used,0),f.base), coalesce(k.used,0)
  from f left join k on k.user_id=f.user_id and k.m=cast(f.m+interval 1 month as date) where f.m<f.last)"""
ROLLOVER_MONTHS = ROLLOVER + """
select user_id, m as usage_month, cast(carry as double)/1000 as carryover_mb,
 cast(base+carry as double)/1000 as allowance_mb, cast(used as double)/1000 as used_mb from f"""
#: Days from which on later loads of these checks take over.
LATER_LOADS = ["1994-03-01", "1996-06-01"]


def _parts_of_usage(c):
    """The usage before, between and after the days of LATER_LOADS."""
    day, usage = F.col("usage_date"), c.stage.content_usage
    first, second = [F.lit(x).cast("date") for x in LATER_LOADS]
    parts = [day < first, (day >= first) & (day < second), day >= second]
    return [rollover.used_by_month(usage.where(part)) for part in parts]


@check("r03_rollover_allowances", ROLLOVER_MONTHS)
def _(c):
    return features.rollover_allowances(c.stage)


@check("r03_rollover_continued", ROLLOVER_MONTHS)
def _(c):
    users = rollover.rollover_users(c.stage)
    rows, states = None, None
    for months in _parts_of_usage(c):
        new = rollover.rollover_rows(users, months, states)
        rows, states = new if rows is None else rows.unionByName(new), rollover.states_of(new, states)
    return rows


@check("r03_rollover_spans", ROLLOVER + """
select f.user_id, first, f.last, cast(least(greatest(f.base+carry-used,0),f.base) as double)/1000 as carry_mb
from f, e where e.user_id=f.user_id and f.m=f.last""")
def _(c):
    users = rollover.rollover_users(c.stage)
    one, two, three = [rollover.span_maps(users, months) for months in _parts_of_usage(c)]
    whole = rollover.joined_spans(one, rollover.joined_spans(two, three))
    carry = rollover.carried_out(F.col("map"), F.lit(0).cast("decimal(26,3)"))
    return whole.select("user_id", "first", "last", carry.alias("carry_mb"))


@check("r04_age_benefits", """
select b.user_id, case when offered then age_benefit_id end as current_age_benefit_id,
 case when offered then benefit_name end as current_age_benefit_name,
 cast(bd as double) as age_bonus_data_gb, cast(bs as double) as age_bonus_shared_data_gb,
 cast(bv as double) as age_bonus_voice_minutes, cast(bm as double) as age_bonus_sms_count,
 cast(bw as double) as age_bonus_video_minutes,
 offered and coalesce(includes_safety_box,false) as age_benefit_safety_box,
 case when not p.is_unlimited then cast(coalesce(p.data_limit_gb,0)+bd as double) end as effective_data_gb,
 cast(coalesce(p.base_shared_data_gb,0)+bs as double) as effective_shared_data_gb,
 p.is_unlimited as effective_data_unlimited
from user_benefit b, plans p where p.plan_id=b.current_plan_id""")
def _(c):
    return features.age_benefits(c.stage)


@check("r05_usage_features", """
select user_id, avg_mb as avg_daily_data_mb, gb as monthly_estimated_data_gb,
 content_category as top_content_category from usage_figures""")
def _(c):
    return features.usage_features(c.stage)


@check("r07_chosen_service_value", """
select u.user_id, cast(coalesce(sum(a.normal_monthly_price),0) as double) as current_benefit_value
from users u left join user_services s on s.user_id=u.user_id
left join additional_services a on a.service_id=s.service_id group by 1""")
def _(c):
    return features.chosen_service_value(c.stage)


FLAGS = """
with v as (select user_id, cast(sum(data_usage_mb) as double) as t,
  cast(coalesce(sum(data_usage_mb) filter (where content_category='video'),0) as double) as vid
  from content_usage group by 1),
 w as (select s.user_id, s.service_id, coalesce(sum(x.mb),0) as mb from user_services s
  left join (select c.user_id, b.service_id, cast(sum(data_usage_mb) as double) as mb
   from content_usage c, bridge b where b.content_detail=c.content_detail group by 1,2) x
  on x.user_id=s.user_id and x.service_id=s.service_id group by 1,2),
 e as (select w.user_id, bool_or(w.mb<0.05*v.t) as low from w, v where v.user_id=w.user_id group by 1)
select u.user_id,
 coalesce(g.gb>80 and not p.is_unlimited and coalesce(p.data_limit_gb,0)+b.bd<=30,false) as case_a,
 coalesce(g.gb<15 and p.monthly_fee>=80000,false) as case_b,
 coalesce(f.internet_status='ACTIVE' and not f.has_bundle,false) as case_c,
 coalesce(v.vid/nullif(v.t,0)>=0.25 and g.gb>=30 and p.plan_family not in ('CHOICE','CHOICE_DOUBLE'),false) as case_d,
 coalesce(p.plan_family in ('CHOICE','CHOICE_DOUBLE') and e.low,false) as case_e
from users u join plans p on p.plan_id=u.current_plan_id
left join usage_figures g on g.user_id=u.user_id left join user_benefit b on b.user_id=u.user_id
left join families f on f.family_id=u.family_id left join v on v.user_id=u.user_id
left join e on e.user_id=u.user_id"""


@check("r06_case_flags", FLAGS)
def _(c):
    return features.case_flags(c.stage)


@check("r06_case_counts", f"""
select count(*) filter (where case_a) as case_a, count(*) filter (where case_b) as case_b,
 count(*) filter (where case_c) as case_c, count(*) filter (where case_d) as case_d,
 count(*) filter (where case_e) as case_e from ({FLAGS})""")
def _(c):
    return features.case_counts(features.case_flags(c.stage))

layer("amounts_now", f"select user_id, current_total_discount_amount as amount from ({AMOUNTS})")
