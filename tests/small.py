"""A small hand-made snapshot."""

from datetime import date
from decimal import Decimal as D

from checks.fixtures import with_tables
from meterline.plans.tables import Tables
from meterline.schemas import SOURCE_SCHEMAS

SECRET = "test-secret-of-more-than-32-characters"


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SOURCE_SCHEMAS[table])


def plan(plan_id, family, fee, limit, network="5G", rollover=False):
    return (plan_id, "plan " + plan_id, family, "standard", D(fee), None if limit is None else D(limit),
            limit is None, None, "basic", "basic", D(1), rollover, None, None, network, 0, 0, True)


def usage_row(user, day, category, detail, mb):
    return (f"{user}-{day}-{detail}", user, day, category, detail, D(str(mb)))


USERS = [
    ("U1", "Ann", 35, "F", date(2024, 1, 1), "P3001", "F1"),
    ("U2", "Bob", 38, "M", date(2024, 1, 10), "P1001", "F1"),
    ("U3", "Cho", 12, "F", date(2024, 1, 1), "P3001", "F1"),
    ("U4", "Dee", 70, "M", date(2024, 2, 1), "P2101", None),
]


def usage(days):
    rows = []
    for number, day in enumerate(days):
        rows.append(usage_row("U1", day, "video", "netflix", 100 + number))
        rows.append(usage_row("U1", day, "music", "genie_music", 10.5))
        if number % 2 == 0:
            rows.append(usage_row("U2", day, "web", "general_web", 50 + number))
        rows.append(usage_row("U4", day, "video", "youtube_video", 7.125))
    return rows


def masters(spark):
    shared = {
        name: spark.sql(with_tables(f"select * from {name}"))
        for name in ("age_benefits", "discounts", "internet_bundle_discount_rules",
                     "premium_family_discount_rules")
    }
    return Tables(
        users=frame(spark, "users", USERS),
        families=frame(spark, "families", [
            ("F1", True, "PREMIUM_FAMILY", True, "BASIC_ESSENCE_PREMIUM", 36, "ACTIVE", "TOTAL",
             "EQUAL", "D005"),
            ("F2", False, None, False, None, None, "NONE", None, None, None)]),
        plans=frame(spark, "plans", [
            plan("P3001", "CHOICE", 90000, None), plan("P1001", "VOICE", 30000, 2),
            plan("P2101", "BASIC_ROLLOVER", 50000, 10, rollover=True)]),
        plan_age_benefits=frame(spark, "plan_age_benefits", [
            ("A1", "P2101", "AB30", D(3), D(1), D(0), D(0), D(0))]),
        additional_services=frame(spark, "additional_services", [
            ("S001", "Films", "media", D(9000)), ("S002", "Clips", "media", D(8000))]),
        plan_benefits=frame(spark, "plan_benefits", [
            ("B1", "P3001", "S001", "CHOICE", None, True, "G1", 1),
            ("B2", "P3001", "S002", "CHOICE", None, True, "G1", 1)]),
        user_services=frame(spark, "user_services", [
            ("US1", "U1", "S001", "CHOICE", date(2024, 1, 5)),
            ("US2", "U3", "S002", "CHOICE", date(2024, 1, 5))]),
        bundle_discount_compositions=frame(spark, "bundle_discount_compositions", [
            ("C0", "F1", "INTERNET", None, "BASE_INTERNET", "ACTIVE", date(2024, 1, 15), None),
            ("C1", "F1", "MOBILE", "U1", "BASE_MOBILE", "ACTIVE", date(2024, 1, 15), None),
            ("C2", "F1", "MOBILE", "U2", "LOW_MOBILE", "ACTIVE", date(2024, 1, 15), None),
            ("C3", "F1", "MOBILE", "U3", "PREMIUM_MOBILE", "ACTIVE", date(2024, 1, 15), None)]),
        user_discounts=frame(spark, "user_discounts", [
            ("D1", "U1", "C1", "D001", "ACTIVE", date(2024, 1, 15), None),
            ("D2", "U2", "C2", "D001", "ACTIVE", date(2024, 1, 15), None),
            ("D3", "U3", "C3", "D003", "ACTIVE", date(2024, 1, 15), None),
            ("D4", "U3", "C3", "D004", "ACTIVE", date(2024, 1, 15), None)]),
        **shared,
    )


def stage(spark, days):
    return masters(spark).replace(content_usage=frame(spark, "content_usage", usage(days)))


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))
