"""Oracle layers shared by the checks: usage in thousandths of a MB, pseudonyms and marts."""

from checks.registry import (
    BAND_SQL, RECENT_REFERENCE, REFERENCE, day_key, key_sql, layer, month_of, rnd,
)

USER_KEY = key_sql("user", "AUSR_", "user_id")
FAMILY_KEY = key_sql("family", "AFAM_", "family_id")
BUNDLE_KEY = key_sql("bundle_composition", "ABND_", "bundle_composition_id")

for name, source, reference in (
    ("p_usage", "content_usage", REFERENCE), ("r_usage", "recent_usage", RECENT_REFERENCE),
):
    layer(name, f"""
select c.content_usage_id, c.user_id, c.usage_date, c.content_category, c.content_detail,
       cast(c.data_usage_mb*1000 as bigint) as k, {day_key("c.usage_date")} as date_key,
       {month_of("c.usage_date")} as calendar_month,
       {day_key(month_of("c.usage_date"))} as month_key
from {source} c, users u
where c.user_id=u.user_id and c.usage_date>=u.subscription_start_date
  and c.usage_date<date '{reference}'""")

layer("o_users", f"""
select user_id, {USER_KEY} as analysis_user_key, {BAND_SQL} as age_band, gender,
       subscription_start_date, current_plan_id as plan_id, {FAMILY_KEY} as analysis_family_key
from users""")
layer("o_usage", """
select u.analysis_user_key, u.plan_id, u.age_band, c.usage_date, c.date_key, c.calendar_month,
       c.month_key, c.content_category, cast(sum(c.k) as bigint) as k
from p_usage c, o_users u where u.user_id=c.user_id group by all""")
for grain, key in (("daily", "date_key"), ("monthly", "month_key")):
    layer(f"o_{grain}_segment", f"""
select {key}, plan_id, age_band, content_category, cast(sum(k) as bigint) as k,
       count(distinct analysis_user_key) as users
from o_usage group by all""")
layer("o_customer_month", """
select analysis_user_key, calendar_month, month_key, cast(sum(k) as bigint) as k
from o_usage group by all""")
layer("o_subscribers", f"""
select plan_id, age_band, count(*) as n from o_users
where subscription_start_date<=date '{REFERENCE}' group by all""")
for name, usage in (("p_daily", "p_usage"), ("r_daily", "r_usage")):
    layer(name, f"""
select user_id, usage_date, calendar_month, date_key, month_key, cast(sum(k) as bigint) as k,
       cast(sum(sum(k)) over (partition by user_id, calendar_month order by usage_date) as bigint)
            as running
from {usage} group by user_id, usage_date, calendar_month, date_key, month_key""")
layer("p_month_content", """
select user_id, calendar_month, month_key, content_category, content_detail,
       cast(sum(k) as bigint) as k
from p_usage group by all""")
layer("current_services", f"""
select user_id, service_id, benefit_type, start_date from user_services
where start_date<=date '{REFERENCE}'""")
layer("current_discounts", f"""
select user_id, discount_id, max(start_date) as start_date from user_discounts
where status='ACTIVE' and start_date<=date '{REFERENCE}'
  and (end_date is null or end_date>=date '{REFERENCE}')
group by all""")
layer("bridge", """
select m.service_id, m.content_detail from (values
 ('S001','netflix'),('S002','youtube_video'),('S002','youtube_shorts'),('S002','youtube_music'),
 ('S003','tving'),('S004','genie_music'),('S005','milli_ebook'),('S006','disney_plus'),
 ('S009','google_ai')) m(service_id, content_detail)""")
layer("lines", """
select u.user_id, u.family_id, u.age, u.subscription_start_date, p.monthly_fee, p.network_type,
       p.plan_family, p.plan_name, p.family_bundle_eligible, u.name
from users u, plans p where u.current_plan_id=p.plan_id and u.family_id is not null""")

MB = "cast(k as double)/1000"
GB2 = rnd("k", "1024000", 2)
