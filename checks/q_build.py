"""Warehouse, marts and views (B-*, V-*)."""

from pyspark.sql import functions as F

from checks.q_layers import BUNDLE_KEY, FAMILY_KEY, MB, USER_KEY
from checks.registry import BAND_SQL, REFERENCE, check, key_sql, rnd
from meterline.plans.marts import dim_age_band



def _nb(df):
    return df.drop("source_batch_id")


@check("b01_operations_families", f"""
select {FAMILY_KEY} as analysis_family_key, has_bundle, bundle_type, has_home_internet,
 internet_product_group, cast(internet_contract_months as bigint) as internet_contract_months,
 internet_status, bundle_discount_method, total_discount_allocation_method,
 internet_benefit_discount_id from families""")
def _(c):
    return _nb(c.ops.dw.families)


@check("b01_operations_users", f"""
select {USER_KEY} as analysis_user_key, {BAND_SQL} as age_band, gender, subscription_start_date,
 current_plan_id, {FAMILY_KEY} as analysis_family_key from users""")
def _(c):
    return _nb(c.ops.dw.users)


@check("b01_operations_compositions", f"""
select {BUNDLE_KEY} as analysis_bundle_composition_key, {FAMILY_KEY} as analysis_family_key,
 component_type, {USER_KEY} as analysis_user_key, component_role, status, start_date, end_date
from bundle_discount_compositions""")
def _(c):
    return _nb(c.ops.dw.bundle_discount_compositions)


@check("b01_operations_user_discounts", f"""
select {key_sql("user_discount", "AUDS_", "user_discount_id")} as analysis_user_discount_key,
 {USER_KEY} as analysis_user_key, {BUNDLE_KEY} as analysis_bundle_composition_key, discount_id,
 status, start_date, end_date from user_discounts""")
def _(c):
    return _nb(c.ops.dw.user_discounts)


@check("b01_operations_user_services", f"""
select {key_sql("user_service", "AUSRVS_", "user_service_id")} as analysis_user_service_key,
 {USER_KEY} as analysis_user_key, service_id, benefit_type, start_date from user_services""")
def _(c):
    return _nb(c.ops.dw.user_services)


@check("b02_operations_usage", f"""
select analysis_user_key, usage_date, content_category, {MB} as data_usage_mb from o_usage""")
def _(c):
    return _nb(c.ops.dw.content_usage)


@check("b03_personalization_usage", f"""
select content_usage_id, user_id, usage_date, content_category, content_detail,
 {MB} as data_usage_mb from p_usage""")
def _(c):
    return _nb(c.pers.dw.content_usage)


@check("b03_personalization_users", """
select user_id, name, cast(age as bigint) as age, gender, subscription_start_date, current_plan_id,
 family_id from users""")
def _(c):
    return _nb(c.pers.dw.users)


@check("b04_dim_date", """
with b as (select date_trunc('month',min(usage_date)) as lo, max(usage_date) as hi from p_usage),
 d as (select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp),
       interval 1 day)) as date) as x from b)
select cast(strftime(x,'%Y%m%d') as bigint) as date_key, x as calendar_date,
 cast(date_trunc('month',x) as date) as calendar_month, year(x) as calendar_year,
 quarter(x) as calendar_quarter, day(x) as day_of_month, isodow(x) as day_of_week,
 isodow(x)>=6 as is_weekend from d""")
def _(c):
    return c.pers.mart.dim_date


@check("b05_users_per_age_band", f"""
with b as (select * from (values (1,'8-12',8,12),(2,'13-18',13,18),(3,'19-24',19,24),
 (4,'25-34',25,34),(5,'35-49',35,49),(6,'50-64',50,64),(7,'65+',65,null))
 t(age_band_key,age_band,min_age,max_age)),
 n as (select {BAND_SQL} as age_band, count(*) as users from users group by 1)
select cast(b.age_band_key as bigint) as age_band_key, b.age_band, cast(b.min_age as bigint) as min_age,
 cast(b.max_age as bigint) as max_age, coalesce(n.users,0) as users
from b left join n on n.age_band=b.age_band""")
def _(c):
    counted = c.ops.dw.users.groupBy("age_band").agg(F.count("*").alias("users"))
    return dim_age_band(c.spark).join(counted, "age_band", "left").na.fill(0, ["users"])


@check("b06_dim_plan", """
select plan_id, plan_name, plan_family, plan_category, cast(monthly_fee as double) as monthly_fee,
 cast(data_limit_gb as double) as data_limit_gb, is_unlimited, choice_tier, network_type from plans""")
def _(c):
    return c.pers.mart.dim_plan


@check("b06_dim_service", """
select service_id, service_name, service_category,
 cast(normal_monthly_price as double) as normal_monthly_price from additional_services""")
def _(c):
    return c.ops.mart.dim_service


@check("b06_dim_family", """
select family_id, has_bundle, bundle_type, has_home_internet, internet_product_group,
 internet_status from families""")
def _(c):
    return c.pers.mart.dim_family


@check("b07_dim_content_category", "select distinct content_category from o_usage")
def _(c):
    return c.ops.mart.dim_content_category


@check("b07_dim_content", "select distinct content_category, content_detail from p_usage")
def _(c):
    return c.pers.mart.dim_content


@check("b08_dim_customer", """
select user_id, name, current_plan_id as plan_id, cast(age as bigint) as age, gender,
 subscription_start_date, family_id from users""")
def _(c):
    return c.pers.mart.dim_customer


@check("b08_dim_analysis_customer", """
select analysis_user_key, plan_id, age_band, gender, subscription_start_date, analysis_family_key
from o_users""")
def _(c):
    return c.ops.mart.dim_customer


@check("b09_bridge_service_content", """
select distinct b.service_id, p.content_category, b.content_detail
from bridge b, p_usage p, additional_services s
where p.content_detail=b.content_detail and s.service_id=b.service_id""")
def _(c):
    return c.pers.mart.bridge_service_content


@check("b10_daily_usage_segment", f"""
select date_key, plan_id, age_band, content_category, {MB} as total_usage_mb,
 users as usage_user_count, {rnd("k", "users*1000", 3)} as average_usage_mb from o_daily_segment""")
def _(c):
    return c.ops.mart.daily_usage_segment


@check("b11_monthly_usage_segment", f"""
select month_key, plan_id, age_band, content_category, {MB} as total_usage_mb,
 users as usage_user_count, {rnd("k", "users*1000", 3)} as average_usage_mb
from o_monthly_segment""")
def _(c):
    return c.ops.mart.monthly_usage_segment


@check("b12_operations_customer_daily", """
select analysis_user_key, date_key, cast(sum(k) as double)/1000 as total_usage_mb
from o_usage group by all""")
def _(c):
    return c.ops.mart.customer_daily_usage


@check("b13_customer_monthly_category", """
select analysis_user_key, month_key, content_category, cast(sum(k) as double)/1000 as total_usage_mb
from o_usage group by all""")
def _(c):
    return c.ops.mart.customer_monthly_category_usage


@check("b14_subscriber_current", f"""
select date '{REFERENCE}' as as_of_date, analysis_user_key from o_users
where subscription_start_date<=date '{REFERENCE}'""")
def _(c):
    return c.ops.mart.subscriber_current


FAMILY_CURRENT = f"""
select f.key as analysis_family_key, count(u.analysis_user_key) as member_count, f.has_bundle,
 f.has_home_internet
from (select {FAMILY_KEY} as key, has_bundle, has_home_internet from families) f
left join o_users u on u.analysis_family_key=f.key group by all"""


@check("b15_family_current", FAMILY_CURRENT)
def _(c):
    return c.ops.mart.family_current


@check("b16_customer_service_current", "select * from current_services")
def _(c):
    return c.pers.mart.customer_service_current


@check("b16_operations_service_current", """
select u.analysis_user_key, s.service_id, s.benefit_type, s.start_date
from current_services s, o_users u where u.user_id=s.user_id""")
def _(c):
    return c.ops.mart.customer_service_current


@check("b17_customer_discount_current", "select * from current_discounts")
def _(c):
    return c.pers.mart.customer_discount_current


@check("b17_operations_discount_current", """
select u.analysis_user_key, d.discount_id, d.start_date
from current_discounts d, o_users u where u.user_id=d.user_id""")
def _(c):
    return c.ops.mart.customer_discount_current


@check("b18_customer_daily_usage", f"""
select user_id, date_key, {MB} as total_usage_mb,
 cast(running as double)/1000 as month_to_date_usage_mb from p_daily""")
def _(c):
    return c.pers.mart.customer_daily_usage


P_MONTHLY = f"""
select user_id, month_key, calendar_month, cast(sum(k) as bigint) as k, count(*) as days
from p_daily group by all"""


@check("b19_customer_monthly_usage", f"""
select user_id, month_key, {MB} as total_usage_mb,
 {rnd("k", "days*1000", 3)} as average_daily_usage_mb from ({P_MONTHLY})""")
def _(c):
    return c.pers.mart.customer_monthly_usage


@check("b20_customer_monthly_content", f"""
select user_id, month_key, content_category, content_detail, {MB} as total_usage_mb
from p_month_content""")
def _(c):
    return c.pers.mart.customer_monthly_content_usage


@check("b21_customer_family_current", """
select user_id, family_id from users where family_id is not null""")
def _(c):
    return c.pers.mart.customer_family_current


@check("b22_customer_content_daily", f"""
select user_id, date_key, content_category, content_detail, {MB} as data_usage_mb from p_usage""")
def _(c):
    return c.pers.mart.customer_content_daily_usage


# --- views ---------------------------------------------------------------------------------------


@check("v01_subscriber_current", f"""
select date '{REFERENCE}' as as_of_date, s.plan_id, p.plan_name, s.age_band, s.n as subscriber_count
from o_subscribers s, plans p where p.plan_id=s.plan_id""")
def _(c):
    return c.ops.views.v_subscriber_current


for _view, _grain, _key, _name in (
    ("v02_daily_usage_segment", "daily", "date_key", "calendar_date"),
    ("v03_monthly_usage_segment", "monthly", "month_key", "calendar_month"),
):
    @check(_view, f"""
select cast(strptime(cast(s.{_key} as varchar),'%Y%m%d') as date) as {_name}, s.plan_id,
 p.plan_name, s.age_band, s.content_category, {MB} as total_usage_mb,
 users as usage_user_count, {rnd("k", "users*1000", 3)} as average_usage_mb
from o_{_grain}_segment s, plans p where p.plan_id=s.plan_id""")
    def _(c, grain=_grain):
        return c.ops.views[f"v_{grain}_usage_segment"]


@check("v04_operations_customer_daily", """
select analysis_user_key, usage_date as calendar_date, cast(sum(k) as double)/1000 as total_usage_mb
from o_usage group by all""")
def _(c):
    return c.ops.views.v_customer_daily_usage


@check("v05_operations_customer_monthly_category", """
select analysis_user_key, calendar_month, content_category,
 cast(sum(k) as double)/1000 as total_usage_mb from o_usage group by all""")
def _(c):
    return c.ops.views.v_customer_monthly_category_usage


@check("v06_family_current", FAMILY_CURRENT)
def _(c):
    return c.ops.views.v_family_current


@check("v07_service_current", """
select s.service_id, s.service_name, s.service_category, count(*) as customer_count
from current_services c, additional_services s where c.service_id=s.service_id group by all""")
def _(c):
    return c.ops.views.v_service_current


@check("v08_discount_current", """
select d.discount_id, d.discount_name, d.policy_domain, count(*) as customer_count
from current_discounts c, discounts d where c.discount_id=d.discount_id group by all""")
def _(c):
    return c.ops.views.v_discount_current


@check("v09_plan_catalog", """
select plan_id, plan_name, plan_family, plan_category, cast(monthly_fee as double) as monthly_fee,
 cast(data_limit_gb as double) as data_limit_gb, is_unlimited from plans""")
def _(c):
    return c.ops.views.v_plan_catalog


@check("v10_plan_age_benefits", """
select p.plan_id, p.plan_name, a.age_benefit_id, a.benefit_name, cast(a.min_age as double) as min_age,
 cast(a.max_age as double) as max_age, cast(b.bonus_data_gb as double) as bonus_data_gb,
 cast(b.bonus_shared_data_gb as double) as bonus_shared_data_gb,
 cast(b.bonus_voice_minutes as double) as bonus_voice_minutes,
 cast(b.bonus_sms_count as double) as bonus_sms_count,
 cast(b.bonus_video_minutes as double) as bonus_video_minutes
from plan_age_benefits b, plans p, age_benefits a
where b.plan_id=p.plan_id and b.age_benefit_id=a.age_benefit_id""")
def _(c):
    return c.ops.views.v_plan_age_benefits


@check("v11_customer_month_daily_usage", f"""
select u.user_id, u.name, d.calendar_month, d.usage_date as calendar_date, {MB} as total_usage_mb,
 cast(running as double)/1000 as month_to_date_usage_mb
from p_daily d, users u where u.user_id=d.user_id""")
def _(c):
    return c.pers.views.v_customer_month_daily_usage


@check("v12_customer_day_content_usage", f"""
select u.user_id, u.name, d.usage_date as calendar_date, d.content_category, d.content_detail,
 {MB} as data_usage_mb from p_usage d, users u where u.user_id=d.user_id""")
def _(c):
    return c.pers.views.v_customer_day_content_usage


@check("v13_customer_monthly_usage", f"""
select u.user_id, u.name, d.calendar_month, {MB} as total_usage_mb,
 {rnd("k", "days*1000", 3)} as average_daily_usage_mb
from ({P_MONTHLY}) d, users u where u.user_id=d.user_id""")
def _(c):
    return c.pers.views.v_customer_monthly_usage


@check("v14_customer_monthly_category", """
select u.user_id, u.name, d.calendar_month, d.content_category,
 cast(sum(k) as double)/1000 as total_usage_mb
from p_month_content d, users u where u.user_id=d.user_id group by all""")
def _(c):
    return c.pers.views.v_customer_monthly_category_usage


@check("v15_customer_monthly_detail", f"""
select u.user_id, u.name, d.calendar_month, d.content_category, d.content_detail,
 {MB} as total_usage_mb from p_month_content d, users u where u.user_id=d.user_id""")
def _(c):
    return c.pers.views.v_customer_monthly_detail_usage


SELECTED = f"""
select u.user_id, u.name, d.calendar_month, s.service_id, s.service_name, d.content_category,
 d.content_detail, {MB} as total_usage_mb
from current_services c, users u, additional_services s, bridge b, p_month_content d
where u.user_id=c.user_id and s.service_id=c.service_id and b.service_id=s.service_id
 and d.user_id=c.user_id and d.content_detail=b.content_detail"""


@check("v16_customer_selected_service", SELECTED)
def _(c):
    return c.pers.views.v_customer_selected_service_usage


CURRENT_PLAN = """
select u.user_id, u.name, p.plan_id, p.plan_name, p.plan_family, p.plan_category,
 cast(p.monthly_fee as double) as monthly_fee, cast(p.data_limit_gb as double) as data_limit_gb,
 p.is_unlimited, p.choice_tier, p.network_type
from users u, plans p where p.plan_id=u.current_plan_id"""


@check("v17_customer_current_plan", CURRENT_PLAN)
def _(c):
    return c.pers.views.v_customer_current_plan


DISCOUNTS_NOW = """
select u.user_id, u.name, d.discount_id, d.discount_name, d.policy_domain, c.start_date
from current_discounts c, users u, discounts d
where u.user_id=c.user_id and d.discount_id=c.discount_id"""


@check("v18_customer_discount_current", DISCOUNTS_NOW)
def _(c):
    return c.pers.views.v_customer_discount_current


SERVICES_NOW = """
select u.user_id, u.name, s.service_id, s.service_name, s.service_category, c.benefit_type,
 c.start_date
from current_services c, users u, additional_services s
where u.user_id=c.user_id and s.service_id=c.service_id"""


@check("v19_customer_service_current", SERVICES_NOW)
def _(c):
    return c.pers.views.v_customer_service_current


FAMILY_NOW = """
select u.user_id, u.name, f.family_id, f.has_bundle, f.bundle_type, f.has_home_internet,
 f.internet_product_group, f.internet_status
from users u, families f where u.family_id=f.family_id"""


@check("v20_customer_family_current", FAMILY_NOW)
def _(c):
    return c.pers.views.v_customer_family_current


@check("v21_plan_candidates", """
select plan_id, plan_name, plan_family, plan_category, cast(monthly_fee as double) as monthly_fee,
 cast(data_limit_gb as double) as data_limit_gb, is_unlimited, choice_tier, network_type from plans""")
def _(c):
    return c.pers.views.v_plan_candidates


BENEFITS = """
select p.plan_id, p.plan_name, b.benefit_type, b.benefit_value, b.is_selectable, b.option_group,
 cast(b.selection_count as bigint) as selection_count, s.service_id, s.service_name,
 s.service_category
from plan_benefits b, plans p, additional_services s
where b.plan_id=p.plan_id and b.service_id=s.service_id"""


@check("v22_plan_benefits", BENEFITS)
def _(c):
    return c.pers.views.v_plan_benefits


@check("v23_customer_monthly_preaggregated", f"""
select analysis_user_key, calendar_month, {MB} as total_usage_mb, month_key from o_customer_month""")
def _(c):
    return c.ops.views.v_customer_monthly_usage_preaggregated
