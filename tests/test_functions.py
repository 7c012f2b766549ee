import hashlib
import hmac
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.functions import calendar, keys, measures
from meterline.operators import frames, intervals, relations, selection
from meterline.operators.lookup import matching_rules, only_amount, with_amounts, with_rules


@pytest.mark.parametrize("secret", ["k" * 32, "k" * 64, "long-" * 30, "비밀" * 16])
def test_keys_equal_hmac(spark, secret):
    ids = ["U1", "고객", "x" * 200]
    df = spark.createDataFrame([(i,) for i in [*ids, "", None]], "id string")
    got = [r[0] for r in df.select(keys.analysis_key("user", F.col("id"), secret)).collect()]
    expected = [
        "AUSR_" + hmac.new(secret.encode(), f"user:{i}".encode(), hashlib.sha256).hexdigest()[:24].upper()
        for i in ids
    ]
    assert got == [*expected, None, None]
    with pytest.raises(ValueError):
        keys.analysis_key("user", F.col("id"), "k" * 31)


def test_age_bands(spark):
    ages = [None, 3, 7, 8, 12, 13, 18, 24, 34, 49, 50, 64, 65, 99]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    rows = df.select(
        measures.age_band(F.col("age")), measures.age_band(F.col("age"), below=None, lowest=7)
    ).collect()
    assert [r[0] for r in rows[:4]] == ["65+", "65+", "65+", "8-12"]
    assert [r[1] for r in rows[:4]] == [None, None, "8-12", "8-12"]
    assert [r[0] for r in rows[4:]] == [
        "8-12", "13-18", "13-18", "19-24", "25-34", "35-49", "50-64", "50-64", "65+", "65+"]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),), (date(2023, 12, 31),)], "d date")
    rows = df.select(*calendar.calendar_columns(F.col("d"))).collect()
    assert tuple(rows[0]) == (20240229, date(2024, 2, 29), date(2024, 2, 1), 2024, 1, 29, 4, False)
    assert tuple(rows[1])[6:] == (7, True)
    back = df.select(calendar.day_of_key(calendar.date_key(F.col("d")))).collect()
    assert [r[0] for r in back] == [date(2024, 2, 29), date(2023, 12, 31)]


def test_local_day_crosses_midnight(spark):
    df = spark.sql("select timestamp '2024-01-01 15:00:00' as t union all select timestamp '2024-01-01 14:59:59'")
    rows = df.select(calendar.local_day(F.col("t")), calendar.last_complete_day(F.col("t"))).collect()
    assert {tuple(r) for r in rows} == {
        (date(2024, 1, 2), date(2024, 1, 1)), (date(2024, 1, 1), date(2023, 12, 31))}


def test_month_frame_guards_empty_ranges(spark):
    assert frames.month_frame(spark, "2024-01-01", "2024-01-01").count() == 0
    assert frames.month_frame(spark, "2024-03-01", "2024-01-01").count() == 0
    assert [r[0].month for r in frames.month_frame(spark, "2023-11-01", "2024-02-01").collect()] == [11, 12, 1]


def test_rules_of_any_number(spark):
    rules = [(f"R{i}", "D002", "FIXED", "MOBILE_LINE", ["ANY", "SLIM"][i % 2], 12 + i % 3, None, None, 100 * i, 100 * i + 99, Decimal(i)) for i in range(20_000)]
    for i in (7, 1999, 19_998):
        group, months, fee = ("SLIM" if i % 2 else "OTHER"), 12 + i % 3, 100 * i + 50
        request = spark.createDataFrame([(group, months, fee)], "grp string, term int, fee int")
        rows = with_rules(request, spark.createDataFrame(rules, RULE_COLUMNS), "grp", "term", r=("D002", "FIXED", "MOBILE_LINE"))
        found = matching_rules("r", F.col("grp"), F.col("term"), line_fee=F.col("fee"))
        assert rows.select(only_amount(found, "line")).first()[0] == i


def test_ranges_against_brute_force(spark):
    """Overlapping, open, reversed, one-point and repeated ranges; values on, between and beyond all bounds, and nulls."""
    rng = random.Random(3)
    bounds = [None, *range(0, 60, 3)]
    ranges = [(rng.choice("abc"), rng.choice(bounds), rng.choice(bounds), i) for i in range(120)]
    ranges += [("d", None, None, 500), ("e", 5, 5, 501), ("e", 5, 5, 502), (None, 1, 9, 503)]
    values = [(k, v) for k in ["a", "b", "c", "d", "e", "f", None] for v in [None, -5, 5, 99, *range(0, 62)]]
    held = spark.createDataFrame(ranges, "key string, low int, high int, amount long")
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(values)], "id int, k string, start int")
    got = {r.id: (r.x_n, r.x_total) for r in intervals.covering(df, held, {"k": "key"}, F.col("start"), "low", "high", "amount", "x").collect()}
    for i, (k, v) in enumerate(values):
        hits = [a for key, lo, hi, a in ranges if None not in (k, v) and key == k and (lo is None or lo <= v) and (hi is None or v <= hi)]
        assert got[i] == (len(hits), sum(hits)), (k, v)
    assert len(got) == len(values)
    none = intervals.covering(df, held.limit(0), {"k": "key"}, F.col("start"), "low", "high", "amount", "x")
    assert none.agg(F.sum("x_n"), F.count("*")).first()[:] == (0, len(values))


def test_amounts_of_many_rules_without_lists(spark):
    rules = [(f"R{i}", "D002", "FIXED", "MOBILE_LINE", ["ANY", "SLIM"][i % 2], 12 + i % 3, None, None, 100 * i, 100 * i + 99, Decimal(i)) for i in range(20_000)]
    request = spark.createDataFrame([(i, "SLIM" if i % 2 else "OTHER", 12 + i % 3, 100 * i + (99 if i % 5 else 0)) for i in range(0, 20_000, 7)], "i int, grp string, term int, fee int")
    rows = with_amounts(request, spark.createDataFrame(rules, RULE_COLUMNS), "grp", "term", r=(("D002", "FIXED", "MOBILE_LINE"), "fee", "mobile_line_fee"))
    assert "collect_list" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.agg(F.count("*"), F.count_if(F.col("r") == F.col("i"))).first()[:] == (2858, 2858)
    bad = request.limit(1).withColumn("fee", F.lit(-1))
    with pytest.raises(Exception, match="matching rules 0"):
        with_amounts(bad, spark.createDataFrame(rules, RULE_COLUMNS), "grp", "term", r=(("D002", "FIXED", "MOBILE_LINE"), "fee", "mobile_line_fee")).collect()


def test_order_statistics_against_brute_force(spark):
    # One group holds most rows, one value holds a third of them, one group has a single row.
    rng = random.Random(7)
    rows = [("hot", Decimal(rng.randrange(0, 9_000_000)) / 1000) for _ in range(3000)]
    rows += [("hot", Decimal("512.125"))] * 1500
    rows += [("small", Decimal(v)) for v in ("1.000", "2.000", "2.500", "4096.000")]
    rows += [("one", Decimal("7.000")), ("zero", Decimal("0.000")), ("zero", Decimal("0.000"))]
    df = spark.createDataFrame(rows, "g string, v decimal(26,3)")
    counts = selection.value_counts(df, "g", "v")
    bins = selection.ranked_bins(counts, "g")
    medians = {r["g"]: r for r in selection.medians(counts, bins, "g").collect()}
    tops = {(r["g"], r["target"]): r for r in selection.top_shares(counts, bins, "g", {"a": 1, "b": 10}).collect()}
    for group in ("hot", "small", "one", "zero"):
        values = sorted(v for g, v in rows if g == group)
        n = len(values)
        middle = (values[(n - 1) // 2] + values[n // 2]) / 2
        assert medians[group]["median"] == middle
        assert (medians[group]["customers"], medians[group]["total_mb"]) == (n, sum(values))
        for name, percent in (("a", 1), ("b", 10)):
            k = -(-n * percent // 100)
            assert tops[group, name]["top_customers"] == k
            assert tops[group, name]["top_mb"] == sum(values[n - k:])


def test_first_per_group_breaks_ties(spark):
    df = spark.createDataFrame([("a", 5, "x"), ("a", 5, "w"), ("a", 3, "z"), ("b", 1, "q")], "g string, n int, c string")
    rows = relations.first_per_group(df, "g", -F.col("n"), F.col("c")).collect()
    assert sorted(tuple(r) for r in rows) == [("a", 5, "w"), ("b", 1, "q")]


def test_replace_range_can_empty_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(3, "n"), (9, "outside")], "k int, v string")
    rows = relations.replace_range(old, new, "k", 2, 3).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a"), (3, "n")]


RULE = ("R1", "D002", "FIXED", "MOBILE_LINE", "ANY", 12, None, None, 0, 100, Decimal(5))
RULE_COLUMNS = (
    "internet_bundle_rule_id string, discount_id string, bundle_discount_method string, rule_type string, "
    "internet_product_group string, contract_months int, mobile_total_fee_min int, mobile_total_fee_max int, "
    "mobile_line_fee_min int, mobile_line_fee_max int, discount_amount decimal(12,2)"
)


def amount(spark, rules, fee):
    request = spark.createDataFrame([("SLIM", 12, fee)], "grp string, term int, fee int")
    rows = with_rules(request, spark.createDataFrame(rules, RULE_COLUMNS), "grp", "term", r=("D002", "FIXED", "MOBILE_LINE"))
    found = matching_rules("r", F.col("grp"), F.col("term"), line_fee=F.col("fee"))
    return rows.select(only_amount(found, "line")).first()[0]


def test_exactly_one_rule_must_match(spark):
    assert amount(spark, [RULE], 100) == 5
    with pytest.raises(Exception, match="matching rules 0"):
        amount(spark, [RULE], 101)
    overlapping = [RULE, ("R2", *RULE[1:8], 50, None, Decimal(7))]
    assert amount(spark, overlapping, 101) == 7
    with pytest.raises(Exception, match="matching rules 2"):
        amount(spark, overlapping, 60)
