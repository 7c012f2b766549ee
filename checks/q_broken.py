"""Quality rules (Q-07, Q-08, Q-10, Q-13 to Q-20) on stored tables that are broken on purpose.

Each rule finds something, and how much is counted by DuckDB from the source tables.
"""

from pyspark.sql import functions as F

from checks.q_quality import rows_where, rules_sql
from checks.q_refresh import NEW, _limited
from checks.registry import REFERENCE, check, layer
from meterline.plans import quality
from meterline.plans.tables import Tables

MUSIC, VIDEO = "content_category='music'", "content_category='video'"
LATER = 300  # days by which subscriptions start later than they did

# A stored detail without music and with video twice.
layer("broken_o_usage", """
select * from o_usage where content_category<>'music' union all select * from o_usage where content_category='video'""")
layer("broken_p_usage", """
select * from p_usage where content_category<>'music' union all select * from p_usage where content_category='video'""")


def _copied(df, times):
    """Each row so many times, in one pass over the frame."""
    return df.select("*", F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def _broken(usage):
    return _copied(usage, F.expr(f"case when {VIDEO} then 2 when not {MUSIC} then 1 else 0 end"))


def _differs(left: str, right: str) -> str:
    return f"select case when coalesce(({left}),0)=coalesce(({right}),0) then 0 else 1 end"


def _fewer(table: str, condition: str) -> str:
    return f"(select case when count(*)>0 then 1 else 0 end from {table} where {condition})"


COUNTS = f"select {_fewer('plans', 'plan_id like ' + repr('P10%'))}+{_fewer('user_discounts', 'discount_id=' + repr('D003'))}"
BOUNDS = rows_where("age_benefits", "age_benefit_id is not null and min_age%2=0")


def _tables(dw: Tables, **more) -> Tables:
    """Fewer plans and discounts, other ages, and what else is given."""
    bounds = F.when(F.col("min_age") % 2 == 0, F.coalesce(F.col("max_age"), F.lit(200)) + 1).otherwise(F.col("max_age"))
    return dw.replace(
        plans=dw.plans.where(~F.col("plan_id").like("P10%")), user_discounts=dw.user_discounts.where("discount_id<>'D003'"),
        age_benefits=dw.age_benefits.withColumn("max_age", bounds), **more,
    )


def _late(users):
    return users.withColumn("subscription_start_date", F.date_add("subscription_start_date", LATER))


@check("q07_q12_broken_operations_warehouse", rules_sql(
    ("operations_dw_14_table_counts", COUNTS),
    ("operations_dw_age_benefit_bounds_preserved", BOUNDS),
    ("operations_dw_usage_total", _differs("select sum(k) from broken_o_usage", "select sum(k) from p_usage")),
    ("operations_dw_pre_subscription_usage", "select count(*) from broken_o_usage c, o_users u where "
     f"u.analysis_user_key=c.analysis_user_key and u.gender<>'F' and c.usage_date<u.subscription_start_date+{LATER}"),
    ("operations_dw_key_format", rows_where("o_users", "gender='F'")),
    ("operations_dw_category_grain", rows_where("o_usage", "content_category='video'")),
))
def _(c):
    dw = c.ops.dw
    key = F.when(F.col("gender") == "F", F.lower("analysis_user_key")).otherwise(F.col("analysis_user_key"))
    users = _late(dw.users).withColumn("analysis_user_key", key)
    return quality.operations_warehouse_rules(
        _tables(dw, content_usage=_broken(dw.content_usage), users=users), c.stage, REFERENCE
    )


@check("q07_q13_broken_personalization_warehouse", rules_sql(
    ("personalization_dw_14_table_counts", COUNTS),
    ("personalization_dw_usage_rows", _differs("select count(*) from broken_p_usage", "select count(*) from p_usage")),
    ("personalization_dw_age_benefit_bounds_preserved", BOUNDS),
    ("personalization_dw_name_preserved", rows_where("users", "age%3=0")),
    ("personalization_dw_pre_subscription_usage", "select count(*) from broken_p_usage c, users u where "
     f"u.user_id=c.user_id and c.usage_date<u.subscription_start_date+{LATER}"),
    ("personalization_dw_detail_grain", rows_where("p_usage", "content_category='video'")),
))
def _(c):
    dw = c.pers.dw
    name = F.when(F.col("age") % 3 == 0, F.concat("name", F.lit("?"))).otherwise(F.col("name"))
    users = _late(dw.users).withColumn("name", name)
    return quality.personalization_warehouse_rules(
        _tables(dw, content_usage=_broken(dw.content_usage), users=users), c.stage, REFERENCE
    )


@check("q14_q17_broken_operations_mart", rules_sql(
    ("operations_dm_usage_total", _differs("select sum(k) from broken_o_usage", "select sum(k) from o_usage")),
    ("operations_dm_monthly_total", _differs("select sum(k) from o_usage where content_category='video'", "select sum(k) from o_usage")),
    ("operations_dm_active_subscriber", _differs(
        f"select count(*) from o_users where gender='F' and subscription_start_date<=date '{REFERENCE}'",
        f"select count(*) from o_users where subscription_start_date<=date '{REFERENCE}'")),
    ("operations_dm_no_detail_dimension", "select 2"),
))
def _(c):
    mart = c.ops.mart
    women = mart.dim_customer.where("gender='F'").select("analysis_user_key")
    broken = mart.replace(
        daily_usage_segment=_broken(mart.daily_usage_segment),
        monthly_usage_segment=mart.monthly_usage_segment.where(VIDEO),
        subscriber_current=mart.subscriber_current.join(women, "analysis_user_key", "left_semi"),
        **{f"detail_{k}": mart.dim_content_category.withColumn("content_detail", F.lit("x")) for k in (1, 2)},
    )
    return quality.operations_mart_rules(broken, c.ops.dw, REFERENCE)


@check("q13_q18_broken_personalization_mart", rules_sql(
    ("personalization_dm_customer_name", rows_where("users", "age%3=0")),
    ("personalization_dm_daily_total", _differs("select sum(k) from p_usage where date_key%100>15", "select sum(k) from p_usage")),
    ("personalization_dm_monthly_total", _differs("select sum(k) from p_usage where month_key%10000>601", "select sum(k) from p_usage")),
    ("personalization_dm_detail_view_total", _differs("select sum(k) from broken_p_usage", "select sum(k) from p_usage")),
    ("personalization_ai_name_present", "select 3"),
))
def _(c):
    area = c.pers
    mart, views = area.mart, area.views
    name = F.when(F.col("age") % 3 == 0, F.concat("name", F.lit("?"))).otherwise(F.col("name"))
    broken = mart.replace(
        dim_customer=mart.dim_customer.withColumn("name", name),
        customer_daily_usage=mart.customer_daily_usage.where("date_key%100>15"),
        customer_monthly_usage=mart.customer_monthly_usage.where("month_key%10000>601"),
        customer_content_daily_usage=_broken(mart.customer_content_daily_usage),
    )
    unnamed = {view: views[view].drop("name") for view in quality.NAMED_VIEWS[:3]}
    return quality.personalization_mart_rules(broken, area.dw, views.replace(**unnamed))


# The customer-month view with June twice and one column under another name; facts of odd years moved off the first.
layer("category_months", """
select analysis_user_key, month_key, content_category, cast(sum(k) as bigint) as k from o_usage group by all""")


@check("q19_q20_broken_preaggregate", """
with r as (
 select 'view_column_contract' as rule_name, 2 as failed_rows
 union all select 'customer_month_grain', count(*) from o_customer_month where month_key%10000=601
 union all select 'monthly_usage_reconciliation', count(distinct month_key)+count(distinct case when month_key//10000%2=1 then month_key end)
  from o_customer_month where month_key//10000%2=1 or month_key%10000=601
 union all select 'month_first_key', count(*) from category_months where month_key//10000%2=1)
select rule_name, cast(failed_rows as bigint) as failed_rows, case when failed_rows=0 then 'PASS' else 'FAIL' end as result from r""")
def _(c):
    area = c.ops
    mart, views = area.mart, area.views
    fact, view = mart.customer_monthly_category_usage, views.v_customer_monthly_usage_preaggregated
    moved = F.when(F.floor(F.col("month_key") / 10000) % 2 == 1, F.col("month_key") + 1).otherwise(F.col("month_key")).cast("int")
    twice = _copied(view, F.expr("case when month_key%10000=601 then 2 else 1 end")).withColumnRenamed("calendar_month", "month_start")
    return quality.preaggregate_report(
        mart.replace(customer_monthly_category_usage=fact.withColumn("month_key", moved)),
        views.replace(v_customer_monthly_usage_preaggregated=twice),
    )


DAYS = f"usage_date between date '{NEW[0]}' and date '{NEW[1]}'"
MONTH = f"usage_date between date '{NEW[0].replace(day=1)}' and date '{NEW[1]}'"


def _window_total(table: str, days: str, more: str = "") -> str:
    return f"select sum(k) from {table} where {days} {more}"


@check("q15_broken_incremental", rules_sql(
    ("operations_dw_incremental_total", _differs(_window_total("broken_o_usage", DAYS), _window_total("o_usage", DAYS))),
    ("operations_dw_incremental_pre_subscription_usage", "select count(*) from broken_o_usage c, o_users u where "
     f"u.analysis_user_key=c.analysis_user_key and c.{DAYS} and c.usage_date<u.subscription_start_date+{LATER * 8}"),
    ("operations_dw_incremental_grain", rows_where("o_usage", f"{DAYS} and content_category='video'")),
    ("operations_dm_incremental_daily_total", _differs(_window_total("o_usage", DAYS), _window_total("broken_o_usage", DAYS))),
    ("operations_dm_incremental_monthly_total", _differs(_window_total("o_usage", MONTH), _window_total("broken_o_usage", MONTH))),
    ("personalization_dw_incremental_total", _differs(_window_total("broken_p_usage", DAYS), _window_total("p_usage", DAYS))),
    ("personalization_dw_incremental_pre_subscription_usage", "select count(*) from broken_p_usage c, users u where "
     f"u.user_id=c.user_id and c.{DAYS} and c.usage_date<u.subscription_start_date+{LATER * 8}"),
    ("personalization_dw_incremental_rows", _differs(
        f"select count(*) from broken_p_usage where {DAYS}", f"select count(*) from p_usage where {DAYS}")),
    ("personalization_dw_incremental_grain", rows_where("p_usage", f"{DAYS} and content_category='video'")),
    ("personalization_dm_incremental_daily_total", _differs(_window_total("p_usage", DAYS), _window_total("broken_p_usage", DAYS))),
    ("personalization_dm_incremental_monthly_total", _differs(_window_total("p_usage", MONTH), _window_total("broken_p_usage", MONTH))),
))
def _(c):
    """A batch whose stored detail lacks music and has video twice, while its facts were built from the right rows."""
    staged = _limited(c.stage, *NEW).content_usage
    first, last = (d.isoformat() for d in NEW)
    result = None
    for area, key in ((c.ops, "analysis_user_key"), (c.pers, "user_id")):
        late = area.dw.users.withColumn("subscription_start_date", F.date_add("subscription_start_date", LATER * 8))
        dw = area.dw.replace(content_usage=_broken(area.dw.content_usage), users=late)
        rules = quality.incremental_warehouse_rules(dw, staged, c.stage.users, key, first, last, area.name).unionByName(
            quality.incremental_mart_rules(area.mart, dw, first, last, area.name)
        )
        result = rules if result is None else result.unionByName(rules)
    return result
