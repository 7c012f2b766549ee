"""Source tables derived from the driver's Parquet tables, as SQL that Spark and DuckDB both run.

Every fixture reads its whole base table; attributes are assigned by arithmetic on the row's own key.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.discount_rows import DISCOUNT_ROWS
from meterline.plans.tables import Tables
from meterline.session import shared_folder

BASE_TABLES = ["customer", "orders", "lineitem", "part", "supplier", "events"]

_PREFIX = (
    "case {slot}%5 when 0 then 'P10' when 1 then 'P21' when 2 then 'P22' when 3 then 'P30' "
    "else 'P40' end || lpad(cast({slot} as string),2,'0')"
)

_SLOT = "((c_custkey*5+cast(floor(c_custkey/20) as bigint))%24)"


FIXTURES = {
    "numbered_users": f"""
select c_custkey as k, 'U'||lpad(cast(c_custkey as string),7,'0') as user_id, c_name as name,
       cast(8+(c_custkey*7)%80 as int) as age,
       case when c_custkey%2=0 then 'F' else 'M' end as gender,
       date '1994-01-01' + cast((c_custkey*13)%900 as int) as subscription_start_date,
       {_SLOT} as slot,
       {_PREFIX.format(slot=_SLOT)} as current_plan_id,
       case when c_custkey%10<6 then cast(floor(c_custkey/10) as bigint)*2
            + case when c_custkey%10<3 then 0 else 1 end end as family_no
from customer""",
    "users": """
select user_id, name, age, gender, subscription_start_date, current_plan_id,
       case when family_no is not null then 'F'||lpad(cast(family_no as string),6,'0') end as family_id
from numbered_users""",
    "plan_slots": """
select p_partkey%24 as slot, cast(sum(p_size) as bigint) as sz, min(p_name) as nm
from part group by 1""",
    "plans": f"""
select {_PREFIX.format(slot="slot")} as plan_id,
       nm||' '||cast(slot as string) as plan_name,
       case slot%5 when 0 then 'VOICE' when 1 then 'BASIC_ROLLOVER' when 2 then 'BASIC'
            when 3 then 'CHOICE' else 'CHOICE_DOUBLE' end as plan_family,
       case when slot%3=0 then 'standard' else 'special' end as plan_category,
       cast(25000+2500*(1+sz%50) as decimal(12,2)) as monthly_fee,
       case when (sz+slot)%5=0 then null else cast(2+(sz*3)%60 as decimal(10,2)) end as data_limit_gb,
       (sz+slot)%5=0 as is_unlimited,
       case when slot%2=0 then '1Mbps' end as throttle_speed,
       'basic' as voice, 'basic' as sms,
       cast(slot%7 as decimal(10,2)) as base_shared_data_gb,
       slot%5=1 as is_rollover,
       case when slot%4=0 then 'VIP' end as membership_tier,
       case when slot%5 in (3,4) then 'T'||cast(slot%3 as string) end as choice_tier,
       case when slot%6=0 then 'LTE' else '5G' end as network_type,
       cast(slot%2 as int) as device_discount_lines,
       cast(slot%3 as int) as data_sharing_discount_lines,
       slot%7<>0 as family_bundle_eligible
from plan_slots""",
    "family_numbers": """
select family_no as n, 'F'||lpad(cast(family_no as string),6,'0') as family_id
from numbered_users where family_no is not null group by 1,2""",
    "families": """
select family_id,
       (n%4 in (0,1)) or n%32=31 as has_bundle,
       case when n%4=0 then 'PREMIUM_FAMILY' when n%4=1 or n%32=31 then 'INTERNET_MOBILE' end
            as bundle_type,
       n%4<>3 as has_home_internet,
       case when n%4=3 then null when n%16=2 then 'SLIM' else 'BASIC_ESSENCE_PREMIUM' end
            as internet_product_group,
       case when n%4=3 then null else cast(12*(1+n%3) as int) end as internet_contract_months,
       case when n%4=3 then 'NONE' when n%32=6 then 'SUSPENDED' else 'ACTIVE' end as internet_status,
       case when n%8 in (0,1) then 'TOTAL' when n%8 in (4,5) or n%32=31 then 'FIXED' end
            as bundle_discount_method,
       case when n%8 in (0,1) then case when n%16<8 then 'EQUAL' else 'CONTRIBUTION' end end
            as total_discount_allocation_method,
       case when n%4 in (0,1) or n%32=31 then 'D005' end as internet_benefit_discount_id
from family_numbers""",
    "component_lines": """
select u.k, u.user_id, u.age, f.family_id, f.bundle_type, f.bundle_discount_method,
       f.internet_product_group, p.monthly_fee, p.network_type,
       case when u.k%10 in (0,3) then 'BASE_MOBILE'
            when f.bundle_type='PREMIUM_FAMILY' and p.monthly_fee>=77000 then 'PREMIUM_MOBILE'
            else 'LOW_MOBILE' end as component_role,
       case when u.k%17=0 then 'ENDED' else 'ACTIVE' end as status,
       u.subscription_start_date + 30 as start_date,
       case when u.k%17=0 then u.subscription_start_date + 230 end as end_date
from numbered_users u
join families f on f.family_id='F'||lpad(cast(u.family_no as string),6,'0')
join plans p on p.plan_id=u.current_plan_id
where f.has_bundle""",
    "bundle_discount_compositions": """
select 'BC'||user_id as bundle_composition_id, family_id, 'MOBILE' as component_type, user_id,
       component_role, status, start_date, end_date
from component_lines
union all
select 'BCI'||family_id, family_id, 'INTERNET', cast(null as string), 'BASE_INTERNET', 'ACTIVE',
       date '1997-01-01', cast(null as date)
from families where has_bundle""",
    "user_discounts": """
select 'UD'||user_id as user_discount_id, user_id, 'BC'||user_id as bundle_composition_id,
       case when component_role='PREMIUM_MOBILE' then 'D003'
            when bundle_discount_method='TOTAL' then 'D001' else 'D002' end as discount_id,
       status, start_date, end_date
from component_lines where internet_product_group is not null
union all
select 'UDR'||user_id, user_id, 'BC'||user_id,
       case when component_role='PREMIUM_MOBILE' then 'D003'
            when bundle_discount_method='TOTAL' then 'D001' else 'D002' end,
       'ACTIVE', start_date + 100, cast(null as date)
from component_lines where internet_product_group is not null and k%6=0
union all
select 'UDY'||user_id, user_id, 'BC'||user_id, 'D004', 'ACTIVE', start_date, cast(null as date)
from component_lines
where bundle_type='PREMIUM_FAMILY' and age<20 and network_type='5G'""",
    "service_numbers": """
select cast(1+s_suppkey%9 as int) as n, min(s_name) as nm,
       cast(5000+(sum(s_suppkey)%7)*1000 as decimal(12,2)) as price
from supplier group by 1""",
    "additional_services": """
select 'S'||lpad(cast(n as string),3,'0') as service_id, 'service '||cast(n as string) as service_name,
       case when n<5 then 'media' else 'life' end as service_category, price as normal_monthly_price
from service_numbers""",
    "plan_benefits": """
select 'PB'||lpad(cast(p.slot as string),2,'0')||lpad(cast(s.n as string),2,'0') as plan_benefit_id,
       q.plan_id, 'S'||lpad(cast(s.n as string),3,'0') as service_id,
       case when s.n=9 then 'PLUS' when p.slot%5=3 then 'CHOICE' else 'DOUBLE_CHOICE' end as benefit_type,
       case when s.n%2=0 then 'full' end as benefit_value, s.n<>9 as is_selectable,
       case when s.n=9 then null else 'G'||cast(s.n%2 as string) end as option_group,
       case when s.n=9 then null else cast(case when p.slot%5=3 then 1 else 2 end as int) end
            as selection_count
from plan_slots p
join plans q on q.plan_name=p.nm||' '||cast(p.slot as string)
join service_numbers s on s.n%3=p.slot%3
where p.slot%5 in (3,4)""",
    "user_picks": """
select k, user_id, slot, 0 as pick from numbered_users where slot%5 in (3,4) and k%11<>0
union all
select k, user_id, slot, 1 as pick from numbered_users where slot%5=4 and k%13<>0""",
    "user_services": """
select 'US'||user_id||cast(pick as string) as user_service_id, user_id,
       'S'||lpad(cast(case when slot%3=0 then 3 else slot%3 end + 3*((k+pick)%3) as string),3,'0')
            as service_id,
       case when slot%5=3 then 'CHOICE' else 'DOUBLE_CHOICE' end as benefit_type,
       date '1999-01-01' + cast((k*31)%1200 as int) as start_date
from user_picks""",
    "age_benefits": """
select * from (values
  ('AB10','youth',cast(0.0 as decimal(5,1)),cast(18.0 as decimal(5,1)),true),
  ('AB20','young adult',19.0,34.0,false),
  ('AB30','senior',65.0,74.0,true),
  ('AB40','elder',75.0,cast(null as decimal(5,1)),true))
  as t(age_benefit_id, benefit_name, min_age, max_age, includes_safety_box)""",
    "plan_age_benefits": """
select 'PA'||plan_id||substring(age_benefit_id,3,1) as plan_age_benefit_id, plan_id, age_benefit_id,
       cast(case when is_unlimited then 0 else monthly_fee/20000 + b end as decimal(10,2)) as bonus_data_gb,
       cast(b as decimal(10,2)) as bonus_shared_data_gb,
       cast(b*10 as decimal(10,1)) as bonus_voice_minutes,
       cast(b*5 as decimal(10,1)) as bonus_sms_count,
       cast(b*2 as decimal(10,1)) as bonus_video_minutes
from (select plan_id, is_unlimited, monthly_fee, 'AB10' as age_benefit_id, 1 as b from plans
      union all select plan_id, is_unlimited, monthly_fee, 'AB20', 2 from plans
      union all select plan_id, is_unlimited, monthly_fee, 'AB30', 3 from plans
      union all select plan_id, is_unlimited, monthly_fee, 'AB40', 4 from plans
                where plan_family<>'VOICE') x""",
    "discounts": """
select * from (values
  ('D001','INTERNET_BUNDLE','TOTAL','total bundle'),
  ('D002','INTERNET_BUNDLE','FIXED','fixed bundle'),
  ('D003','PREMIUM_FAMILY','ADDITIONAL_HIGH_25PCT','premium additional line'),
  ('D004','PREMIUM_FAMILY','YOUTH_5G','youth line'),
  ('D005','INTERNET_BUNDLE','INTERNET','internet line'))
  as t(discount_id, policy_domain, benefit_code, discount_name)""",
    "internet_bundle_discount_rules": f"""
select id as internet_bundle_rule_id, discount_id, bundle_discount_method, rule_type,
       internet_product_group, contract_months,
       cast(total_min as decimal(12,2)) as mobile_total_fee_min,
       cast(total_max as decimal(12,2)) as mobile_total_fee_max,
       cast(line_min as decimal(12,2)) as mobile_line_fee_min,
       cast(line_max as decimal(12,2)) as mobile_line_fee_max,
       discount_target, allocation_method, cast(amount as decimal(12,2)) as discount_amount,
       cast(null as decimal(8,5)) as discount_rate,
       cast(null as date) as effective_start_date, cast(null as date) as effective_end_date
from (values
{DISCOUNT_ROWS})
  as t(id, discount_id, bundle_discount_method, rule_type, internet_product_group, contract_months,
       total_min, total_max, line_min, line_max, discount_target, allocation_method, amount)""",
    "premium_family_discount_rules": """
select id as premium_family_rule_id, discount_id, benefit_type, role as eligible_component_role,
       true as requires_internet, 2 as minimum_high_line_count, 10 as maximum_mobile_line_count,
       cast(fee as decimal(12,2)) as minimum_plan_fee, network as required_network_type,
       cast(guardian_fee as decimal(12,2)) as guardian_minimum_plan_fee,
       network as guardian_required_network_type,
       cast(min_age as decimal(38,10)) as enrollment_min_age,
       cast(max_age as decimal(38,10)) as enrollment_max_age,
       cast(end_age as decimal(38,10)) as benefit_end_age,
       discount_id='D004' as requires_legal_guardian,
       cast(rate as decimal(8,5)) as discount_rate, cast(amount as decimal(12,2)) as discount_amount,
       cast(null as date) as effective_start_date, cast(null as date) as effective_end_date
from (values
  ('PFR001','D003','ADDITIONAL_HIGH_25PCT','PREMIUM_MOBILE',77000,'ANY',null,null,null,null,0.25,null),
  ('PFR002','D004','YOUTH_5G','HIGH_MOBILE',80000,'5G',80000,0,18,20,null,5500))
  as t(id, discount_id, benefit_type, role, fee, network, guardian_fee, min_age, max_age, end_age,
       rate, amount)""",
    "content_usage": """
select user_id||'-'||cast(usage_date as string)||'-'||content_detail as content_usage_id, user_id,
       usage_date, content_category, content_detail, data_usage_mb
from (
  select 'U'||lpad(cast(o_custkey as string),7,'0') as user_id, cast(l_shipdate as date) as usage_date,
         case l_returnflag when 'A' then 'video' when 'N' then 'music' else 'short_form' end
              as content_category,
         case l_returnflag
              when 'A' then case l_linenumber%4 when 0 then 'netflix' when 1 then 'youtube_video'
                            when 2 then 'tving' else 'other_video' end
              when 'N' then case l_linenumber%3 when 0 then 'genie_music' when 1 then 'youtube_music'
                            else 'other_music' end
              else case l_linenumber%2 when 0 then 'youtube_shorts' else 'other_short_form' end end
              as content_detail,
         cast(sum(cast(l_extendedprice as decimal(14,3))) as decimal(14,3)) as data_usage_mb
  from lineitem join orders on l_orderkey=o_orderkey group by 1,2,3,4) x""",
    "recent_usage": """
select user_id||'-'||cast(usage_date as string)||'-'||content_detail as content_usage_id, user_id,
       usage_date, content_category, content_detail, data_usage_mb
from (
  select 'U'||lpad(cast(user_id as string),7,'0') as user_id, cast(ts as date) as usage_date,
         case event_type when 'view' then 'video' when 'click' then 'music' when 'signup' then 'ai'
              when 'purchase' then 'ebook' else 'web' end as content_category,
         case event_type
              when 'view' then case event_id%3 when 0 then 'netflix' when 1 then 'youtube_video'
                               else 'other_video' end
              when 'click' then case event_id%3 when 0 then 'youtube_music' when 1 then 'genie_music'
                                else 'other_music' end
              when 'signup' then case event_id%2 when 0 then 'google_ai' else 'other_ai' end
              when 'purchase' then case event_id%2 when 0 then 'milli_ebook' else 'other_ebook' end
              else 'general_web' end as content_detail,
         cast(sum(cast(value as decimal(14,3))) as decimal(14,3)) as data_usage_mb
  from events group by 1,2,3,4) x""",
}


def _needs(name: str) -> list[str]:
    words = set(FIXTURES[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
    return [other for other in FIXTURES if other != name and other in words]


def with_tables(body: str, **extra: str) -> str:
    """SQL with the fixtures it uses as leading common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _needs(name):
                visit(other)
            ordered.append(name)

    words = set(
        " ".join([body, *extra.values()]).replace("(", " ").replace(")", " ").replace(",", " ").split()
    )
    for name in FIXTURES:
        if name in words:
            visit(name)
    parts = [f"{name} as ({FIXTURES[name]})" for name in ordered]
    parts += [f"{name} as ({text})" for name, text in extra.items()]
    return "with " + ",\n".join(parts) + "\n" + body if parts else body


def open_tables(spark: SparkSession, folder: str) -> None:
    for name in BASE_TABLES:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


SOURCE_NAMES = [
    "users", "families", "bundle_discount_compositions", "plans", "age_benefits",
    "plan_age_benefits", "additional_services", "plan_benefits", "discounts",
    "internet_bundle_discount_rules", "premium_family_discount_rules", "user_discounts",
    "user_services", "content_usage",
]


#: Category and detail of each kind of usage, by its number in the two functions below.
_LINE_KINDS = [
    ("video", "netflix"), ("video", "youtube_video"), ("video", "tving"), ("video", "other_video"),
    ("music", "genie_music"), ("music", "youtube_music"), ("music", "other_music"),
    ("short_form", "youtube_shorts"), ("short_form", "other_short_form"),
]
_EVENT_KINDS = [
    ("video", "netflix"), ("video", "youtube_video"), ("video", "other_video"),
    ("music", "youtube_music"), ("music", "genie_music"), ("music", "other_music"),
    ("ai", "google_ai"), ("ai", "other_ai"), ("ebook", "milli_ebook"), ("ebook", "other_ebook"), ("web", "general_web"),
]


def _shown_number(key: str) -> Column:
    """The number that lpad(.., 7, '0') shows of a key, which it cuts to 7 characters: equal for equal user ids only."""
    return F.substring(F.col(key).cast("string"), 1, 7).cast("int").alias("user_no")


def _thousandths(column: str) -> Column:
    return (F.col(column).cast("decimal(14,3)") * 1000).cast("bigint").alias("k")


def _written(df: DataFrame) -> DataFrame:
    """The rows of a frame from a folder that they are written to now."""
    folder = f"{shared_folder(df.sparkSession)}/usage-{uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _summed(rows: DataFrame, kinds: list[tuple[str, str]], written: bool = False) -> DataFrame:
    """Usage rows of (user_no, usage_date, kind, k); texts are made after the sums, so that only numbers are shuffled."""
    total = rows.groupBy("user_no", "usage_date", "kind").agg(F.sum("k").alias("k"))
    total = _written(total) if written else total
    user = F.concat(F.lit("U"), F.lpad(F.col("user_no").cast("string"), 7, "0"))
    named = [F.element_at(F.array(*[F.lit(kind[i]) for kind in kinds]), F.col("kind") + 1) for i in (0, 1)]
    mb = (F.col("k").cast("decimal(20,0)") * F.lit("0.001").cast("decimal(3,3)")).cast("decimal(14,3)")
    found = total.select(
        user.alias("user_id"), "usage_date", named[0].alias("content_category"), named[1].alias("content_detail"),
        mb.alias("data_usage_mb"),
    )
    name = F.concat("user_id", F.lit("-"), F.col("usage_date").cast("string"), F.lit("-"), "content_detail")
    return found.select(name.alias("content_usage_id"), *found.columns)


def content_usage(spark: SparkSession, folder: str, written: bool = False) -> DataFrame:
    """The rows of the fixture content_usage; `written` stores their numbers for a query that reads them several times."""
    kind = F.expr("""case l_returnflag
        when 'A' then case l_linenumber%4 when 0 then 0 when 1 then 1 when 2 then 2 else 3 end
        when 'N' then case l_linenumber%3 when 0 then 4 when 1 then 5 else 6 end
        else case l_linenumber%2 when 0 then 7 else 8 end end""").alias("kind")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("date").alias("usage_date"), kind,
        _thousandths("l_extendedprice"),
    )
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", _shown_number("o_custkey"))
    return _summed(lines.join(orders, "o_orderkey"), _LINE_KINDS, written)


def recent_usage(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the fixture recent_usage."""
    kind = F.expr("""case event_type
        when 'view' then case event_id%3 when 0 then 0 when 1 then 1 else 2 end
        when 'click' then case event_id%3 when 0 then 3 when 1 then 4 else 5 end
        when 'signup' then case event_id%2 when 0 then 6 else 7 end
        when 'purchase' then case event_id%2 when 0 then 8 else 9 end
        else 10 end""").alias("kind")
    events = spark.read.parquet(f"{folder}/events.parquet")
    return _summed(
        events.select(_shown_number("user_id"), F.col("ts").cast("date").alias("usage_date"), kind, _thousandths("value")),
        _EVENT_KINDS,
    )


def source_tables(spark: SparkSession, folder: str, recent: bool = False) -> Tables:
    """The 14 source tables; `recent` takes usage from the event stream."""

    def load(name: str) -> DataFrame:
        if name == "content_usage":
            return recent_usage(spark, folder) if recent else content_usage(spark, folder)
        # The names of the views are shared; a frame is bound to this folder's files when it is made.
        open_tables(spark, folder)
        return spark.sql(with_tables(f"select * from {name}"))

    return Tables(**{name: (lambda name=name: load(name)) for name in SOURCE_NAMES})
