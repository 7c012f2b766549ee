from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from meterline.plans import loading, quality
from meterline.plans.refresh import LoadRejected
from meterline.plans.tables import Tables
from meterline.sources import csv_tables
from meterline.sources.store import Store
from tests.small import SECRET, frame, masters, rows, stage, usage, usage_row

START = date(2024, 1, 28)
DAYS = [START + timedelta(n) for n in range(6)]
PROCESSING = DAYS[-1] + timedelta(1)


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def write_days(spark, root, days, data=None, version=None):
    for row_day in days:
        data_rows = [r for r in (data or usage(DAYS)) if r[2] == row_day]
        target = f"{root}/event_date={row_day}" + (f"/run_id={version}" if version else "")
        frame(spark, "content_usage", data_rows).coalesce(1).write.option("header", True).mode(
            "overwrite"
        ).csv(target)


def assert_same_areas(left, right):
    for name in ("operations", "personalization"):
        a, b = loading.published_area(left, name), loading.published_area(right, name)
        drop = ["source_batch_id"]
        assert rows(a.dw.content_usage.drop(*drop)) == rows(b.dw.content_usage.drop(*drop))
        for table in loading.MART_TABLES[name]:
            if table in ("subscriber_current", "customer_service_current", "customer_discount_current"):
                continue
            assert rows(a.mart[table]) == rows(b.mart[table]), (name, table)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A store initialized without usage and loaded day by day, and its source folder."""
    base = tmp_path_factory.mktemp("incremental")
    root, store = str(base / "days"), Store(spark, str(base / "store"))
    write_days(spark, root, DAYS)
    loading.initialize(
        store, masters(spark), secret=SECRET, reference_date=str(START), checksum="masters"
    )
    assert loading.published_area(store, "operations").mart.dim_date.count() == 0
    assert store.watermark(loading.USAGE_PIPELINE) is None
    batches = loading.run_incremental(store, root, secret=SECRET, processing=PROCESSING, max_days=3)
    assert len(batches) == 2 and all(batches)
    return store, root


def full_store(spark, folder, data):
    store = Store(spark, str(folder))
    source = masters(spark).replace(content_usage=frame(spark, "content_usage", data))
    loading.run_full(
        store, source, secret=SECRET, reference_date=str(PROCESSING), checksum="snapshot"
    )
    return store


def test_incremental_equals_full(spark, loaded, tmp_path):
    store, _ = loaded
    assert store.watermark(loading.USAGE_PIPELINE) == DAYS[-1]
    full = full_store(spark, tmp_path / "full", usage(DAYS))
    assert full.watermark(loading.USAGE_PIPELINE) == DAYS[-1]
    assert_same_areas(store, full)


def test_same_files_are_not_loaded_again(loaded):
    store, root = loaded
    before = store.log().count()
    assert loading.load_days(store, root, DAYS[:3], secret=SECRET, processing=PROCESSING) is None
    assert loading.run_incremental(store, root, secret=SECRET, processing=PROCESSING) == []
    assert store.log().count() == before


def test_requested_range(loaded):
    store, root = loaded
    request = {"secret": SECRET, "today": PROCESSING, "first_day": START}
    assert loading.load_requested_days(store, root, DAYS[0], DAYS[3], **request) is None
    with pytest.raises(LoadRejected):
        loading.load_requested_days(store, root, DAYS[0], DAYS[0] + timedelta(8), **request)
    with pytest.raises(LoadRejected):
        loading.load_requested_days(store, root, PROCESSING, PROCESSING, **request)
    with pytest.raises(LoadRejected):
        loading.run_correction(store, root, PROCESSING, "v1", secret=SECRET, processing=PROCESSING)


def test_corrections_match_a_full_build(spark, tmp_path):
    base = tmp_path
    root, store = str(base / "days"), Store(spark, str(base / "store"))
    write_days(spark, root, DAYS)
    loading.initialize(
        store, masters(spark), secret=SECRET, reference_date=str(START), checksum="masters"
    )
    loading.run_incremental(store, root, secret=SECRET, processing=PROCESSING, max_days=31)
    day = DAYS[3]
    # Only usage before a subscription is left on this day, so it ends up empty.
    early = date(2024, 1, 29)
    changed = [usage_row("U1", day, "video", "netflix", 999.125)]
    write_days(spark, root, [day], changed, version="v2")
    assert loading.run_correction(store, root, day, "v2", secret=SECRET, processing=PROCESSING)
    write_days(spark, root, [early], [usage_row("U4", early, "video", "netflix", 5)], version="v3")
    assert loading.run_correction(store, root, early, "v3", secret=SECRET, processing=PROCESSING)
    data = [r for r in usage(DAYS) if r[2] not in (day, early)] + changed
    full = full_store(spark, base / "full", data)
    ops = loading.published_area(store, "operations")
    assert early not in {r[0] for r in ops.dw.content_usage.select("usage_date").collect()}
    assert_same_areas(store, full)
    assert store.watermark(loading.USAGE_PIPELINE) == DAYS[-1]


def test_gap_is_rejected_before_loading(spark, tmp_path):
    root, store = str(tmp_path / "days"), Store(spark, str(tmp_path / "store"))
    write_days(spark, root, DAYS[:2] + DAYS[3:5])
    with pytest.raises(LoadRejected, match=str(DAYS[2])):
        loading.run_incremental(store, root, secret=SECRET, processing=DAYS[4] + timedelta(1))
    with pytest.raises(LoadRejected, match="not initialized"):
        loading.load_days(store, root, DAYS[:2], secret=SECRET, processing=PROCESSING)
    assert store.runs().first()["status"] == "FAILED"


def test_files_without_a_byte_are_rejected(spark, loaded, tmp_path):
    store, _ = loaded
    day, root = DAYS[-1] + timedelta(1), tmp_path / "days"
    write_days(spark, str(root), [day], [usage_row("U1", day, "video", "netflix", 5)])
    (root / f"event_date={day}" / "part-zero.csv").write_bytes(b"")
    with pytest.raises(csv_tables.SourceProblem, match="empty part file: .*part-zero.csv"):
        loading.load_days(store, str(root), [day], secret=SECRET, processing=day + timedelta(1))


def test_null_and_repeated_rows_are_rejected(spark):
    source = stage(spark, DAYS[:1])
    usage = source.content_usage
    broken = usage.unionByName(usage.withColumn("data_usage_mb", F.lit(None).cast("decimal(14,3)")))
    found = {r["rule_name"]: r["failed_rows"] for r in quality.staging_rules(source.replace(content_usage=broken)).collect()}
    n = usage.count()
    assert found["staging_content_usage_required"] == n
    assert found["staging_content_usage_key"] == n and found["staging_content_usage_grain"] == n
    assert {name for name, count in found.items() if count} == {
        "staging_content_usage_required", "staging_content_usage_key", "staging_content_usage_grain"}


def test_failed_batch_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    loading.run_full(
        store, stage(spark, DAYS), secret=SECRET, reference_date=str(PROCESSING), checksum="one"
    )
    before = rows(loading.published_area(store, "personalization").dw.content_usage)
    bad = stage(spark, DAYS[:2])
    orphan = frame(spark, "content_usage", [usage_row("U9", DAYS[0], "web", "general_web", 1)])
    with pytest.raises(quality.QualityError, match="staging_usage_user_fk: 1"):
        loading.run_full(
            store, bad.replace(content_usage=bad.content_usage.unionByName(orphan)),
            secret=SECRET, reference_date=str(PROCESSING), checksum="two",
        )
    assert rows(loading.published_area(store, "personalization").dw.content_usage) == before
    status = {r["source_set_checksum"]: r["status"] for r in store.runs().collect()}
    assert status == {"one": "SUCCEEDED", "two": "FAILED"}
    failed = store.runs().where("status='FAILED'").first()
    assert "staging_usage_user_fk" in failed["error_message"]
    # A smaller snapshot retires the partitions it no longer has.
    loading.run_full(
        store, stage(spark, DAYS[:2]), secret=SECRET, reference_date=str(PROCESSING), checksum="two"
    )
    area = loading.published_area(store, "personalization")
    assert area.mart.customer_daily_usage.select("date_key").distinct().count() == 2
    assert store.runs().count() == 2


def test_run_reports(loaded):
    store, _ = loaded
    runs = store.runs()
    recent = quality.recent_runs(runs, loading.USAGE_PIPELINE).collect()
    assert [r["run_type"] for r in recent] == ["INCREMENTAL", "INCREMENTAL", "DATASET_INITIALIZATION"]
    from pyspark.sql import functions as F

    yesterday = F.lit(DAYS[-1])
    status = quality.watermark_status(
        runs, store.watermarks(), loading.USAGE_PIPELINE, yesterday
    ).first()
    assert (status["watermark_check"], status["caught_up_through_yesterday"]) == ("PASS", True)
    none = quality.watermark_status(runs, store.watermarks(), "other", yesterday).first()
    assert none["watermark_check"] == "NO_WATERMARK"
    checks = quality.recorded_checks(runs, store.quality_results(), loading.USAGE_PIPELINE).collect()
    assert {r["recorded_quality_check"] for r in checks} == {"PASS"}
    assert store.source_files().where("source_name='content_usage'").count() == len(DAYS)
    ops = loading.published_area(store, "operations")
    pers = loading.published_area(store, "personalization")
    totals = quality.layer_totals(ops.dw, pers.dw, ops.mart, pers.mart).collect()
    assert [r["total_check"] for r in totals] == ["PASS"] * 4


def test_full_load_from_csv(spark, tmp_path):
    source = stage(spark, DAYS[:3])
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in source:
        source[name].toPandas().convert_dtypes().to_csv(folder / f"{name}.csv", index=False, encoding="utf-8-sig")
    store = Store(spark, str(tmp_path / "store"))
    batch = loading.run_full_from_csv(
        spark, store, str(folder), secret=SECRET, reference_date=str(PROCESSING)
    )
    assert store.source_files().where(f"batch_id='{batch}'").count() == 14
    area = loading.published_area(store, "personalization")
    assert area.mart.dim_customer.count() == 4
    assert isinstance(area.dw, Tables)
    with pytest.raises(csv_tables.SourceProblem):
        csv_tables.read_master(spark, str(tmp_path / "nowhere"))["users"]


def test_ids_of_loaded_days_are_rejected(spark, loaded, tmp_path):
    """An id that an older day holds may not come again; the same day's own ids may, in a correction."""
    store, _ = loaded
    day, root = DAYS[-1] + timedelta(1), str(tmp_path / "days")
    old, new = usage(DAYS)[0], usage_row("U1", day, "video", "netflix", 5)
    write_days(spark, root, [day], [new, (old[0], old[1], day, "web", "general_web", old[5])])
    with pytest.raises(quality.QualityError, match="incremental_content_usage_known: 1"):
        loading.load_days(store, root, [day], secret=SECRET, processing=day + timedelta(1))
    assert store.watermark(loading.USAGE_PIPELINE) == DAYS[-1]
