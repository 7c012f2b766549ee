"""Headline timings on the marts of one data folder; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import SOURCE_NAMES, source_tables
from checks.registry import REFERENCE, SECRET
from meterline.plans import discount_policy, features, operations_reports, personal_reports
from meterline.plans import quality, refresh
from meterline.plans.area import Area, operations_area, personalization_area
from meterline.plans.loading import MART_WAVES
from meterline.plans.marts import COUNTED, COUNTER
from meterline.plans.tables import Tables
from meterline.session import configure

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))
DETAIL_TABLES = ["users", "families", "plans", "user_services", "user_discounts"]
PERIODS = {
    "1m": ("1996-08-01", "1996-09-01"),
    "6m": ("1996-03-01", "1996-09-01"),
    "12m": ("1996-01-01", "1997-01-01"),
    "all": ("1995-01-01", "2001-12-01"),
}


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, rounds: int = ROUNDS, warm: bool = True) -> float:
    if warm:
        run()
    seconds = []
    for _ in range(rounds):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def stored(df: DataFrame, folder: str, key: str | None = None) -> DataFrame:
    writer = df.hint("rebalance", key).write.partitionBy(key) if key else df.write
    writer.mode("overwrite").parquet(folder)
    rows = df.sparkSession.read.schema(df.schema).parquet(folder)
    return rows.select(*df.columns)


def build_marts(areas: list[Area], root: str) -> None:
    """Write the detail layer and the mart of each area, months as partitions."""
    for area in areas:
        usage = stored(area.dw.content_usage, f"{root}/{area.name}/content_usage")
        area.dw.settle("content_usage", usage)
        _store_all(area.dw, DETAIL_TABLES, f"{root}/{area.name}/dw")
        for wave in MART_WAVES[area.name]:
            _store_all(area.mart, wave, f"{root}/{area.name}/dm")


def _store_all(tables: Tables, names: list[str], root: str) -> None:
    frames = {name: tables[COUNTED + name if COUNTED + name in tables else name] for name in names}

    def write(name: str) -> DataFrame:
        key = "month_key" if "month_key" in frames[name].columns else None
        return stored(frames[name], f"{root}/{name}", key)

    with ThreadPoolExecutor(max_workers=8) as pool:
        for name, frame in zip(names, pool.map(write, names)):
            if COUNTED + name in tables:
                tables.settle(COUNTED + name, frame)
                frame = frame.drop(COUNTER)
            tables.settle(name, frame)


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-")
    derived = source_tables(spark, FOLDER)
    stage = Tables(**{n: stored(derived[n], f"{root}/stage/{n}") for n in SOURCE_NAMES})

    def areas() -> list[Area]:
        return [
            operations_area(stage, secret=SECRET, reference_date=REFERENCE),
            personalization_area(stage, reference_date=REFERENCE),
        ]

    times: dict[str, float] = {}
    runs = iter(range(100))
    times["full_mart_build"] = timed(lambda: build_marts(areas(), f"{root}/try{next(runs)}"), rounds=1)
    ops, pers = areas()
    build_marts([ops, pers], f"{root}/final")

    for name, period in PERIODS.items():
        for label, preaggregated in (("", True), ("_original", False)):
            times[f"a02_{name}{label}"] = timed(
                lambda: consume(
                    operations_reports.monthly_usage_statistics(ops, *period, preaggregated)
                )
            )
            times[f"a05_{name}{label}"] = timed(
                lambda: consume(operations_reports.usage_distribution(ops, *period, preaggregated))
            )
    window = refresh.rebuild_window(
        refresh.CORRECTION, date(2001, 6, 1), date(2001, 6, 1), date(2001, 8, 31)
    )

    def month_rebuild() -> None:
        for area in (ops, pers):
            # As in a load: each fact is written, and what follows is built on that.
            folder = f"{root}/rebuild{next(runs)}/{area.name}"
            refresh.changed_facts(
                area.name, area.mart, area.dw.content_usage, area.dw, window, REFERENCE,
                lambda fact, rows, folder=folder: stored(rows, f"{folder}/{fact}"),
            )

    times["month_rebuild"] = timed(month_rebuild)
    others = {
        "a01_plan_mix": lambda: operations_reports.plan_mix_by_age_band(ops, REFERENCE),
        "a04_category_mix_12m": lambda: operations_reports.category_mix(ops, *PERIODS["12m"]),
        "a08_daily_usage_of_month": lambda: personal_reports.daily_usage_of_month(pers, None, "1996-03"),
        "a18_recommendation_context": lambda: personal_reports.recommendation_context(pers, None),
        "d05_discount_amounts": lambda: discount_policy.current_discount_amounts(stage, REFERENCE),
        "r01_best_plan": lambda: features.plan_fit(
            stage,
            stage.users.select(
                "user_id", F.lit(0.5).alias("plan_spending_score"), F.lit("video").alias("content_affinity")
            ),
            top=1,
        ),
        "q01_staging_rules": lambda: quality.staging_rules(stage),
    }
    for name, build in others.items():
        times[name] = timed(lambda: consume(build()))
    result = {
        "metric": "total of median query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    sys.stdout.write(json.dumps(result) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
