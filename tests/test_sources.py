import hashlib
from datetime import date
from decimal import Decimal

import pytest

from meterline.plans import quality, refresh
from meterline.plans.quality import QualityError
from meterline.sources import csv_tables
from meterline.sources.analysis_release import analysis_release, write_analysis_release
from tests.small import SECRET, frame, masters, stage

HEADER = "content_usage_id,user_id,usage_date,content_category,content_detail,data_usage_mb"
DAY = date(2024, 1, 30)


def put(root, folder, text, name="part-000.csv"):
    target = root / folder
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(text, encoding="utf-8")


def row(day=DAY, key="a"):
    return f"{key},U1,{day},web,general_web,1.5\n"


def test_byte_order_mark_and_wrong_header(spark, tmp_path):
    put(tmp_path, f"event_date={DAY}", "﻿" + HEADER + "\n" + row())
    rows = csv_tables.read_usage_partitions(spark, str(tmp_path), [DAY]).collect()
    assert rows[0]["partition_event_date"] == DAY and rows[0]["data_usage_mb"] == Decimal("1.500")
    put(tmp_path / "bad", f"event_date={DAY}", HEADER.replace("user_id", "customer") + "\n" + row())
    with pytest.raises(Exception):
        csv_tables.read_usage_partitions(spark, str(tmp_path / "bad"), [DAY]).collect()


def test_renamed_header(spark, tmp_path):
    (tmp_path / "discounts.csv").write_text("id,policy_domain,benefit_code,discount_name\nD1,x,y,z\n")
    rows = csv_tables.read_csv(spark, str(tmp_path / "discounts.csv"), "discounts", {"id": "discount_id"})
    assert tuple(rows.first()) == ("D1", "x", "y", "z")


def test_version_folders(spark, tmp_path):
    root, folder = str(tmp_path), f"event_date={DAY}"
    with pytest.raises(csv_tables.SourceProblem):
        csv_tables.usage_files(spark, root, [DAY])
    put(tmp_path, f"{folder}/run_id=v1", HEADER + "\n" + row())
    assert csv_tables.usage_files(spark, root, [DAY]) == [f"{folder}/run_id=v1/part-000.csv"]
    with pytest.raises(csv_tables.SourceProblem):
        csv_tables.usage_files(spark, root, [DAY], direct_only=True)
    put(tmp_path, f"{folder}/run_id=v2", HEADER + "\n" + row())
    with pytest.raises(csv_tables.SourceProblem):
        csv_tables.usage_files(spark, root, [DAY])
    put(tmp_path, folder, HEADER + "\n" + row())
    put(tmp_path, folder, "ignored", name="notes.txt")
    assert csv_tables.usage_files(spark, root, [DAY]) == [f"{folder}/part-000.csv"]
    assert csv_tables.usage_files(spark, root, [DAY], "v2") == [f"{folder}/run_id=v2/part-000.csv"]
    for bad in ("../v1", "", "a" * 129):
        with pytest.raises(csv_tables.SourceProblem):
            csv_tables.usage_files(spark, root, [DAY], bad)
    assert csv_tables.partition_days(spark, root) == [DAY]


def digest_of(data: bytes, span: int) -> str:
    ranges, place = {}, 0
    lines = data.split(b"\n")
    for line in lines[:-1] if data.endswith(b"\n") else lines if data else []:
        name = hashlib.md5(f"{place}:{hashlib.md5(line).hexdigest().upper()}".encode()).hexdigest()
        n, low, high = ranges.get(place // span, (0, 0, 0))
        ranges[place // span] = n + 1, low + int(name[:15], 16), high + int(name[16:31], 16)
        place += len(line) + 1
    leaves = [hashlib.sha256(":".join(map(str, (k, *ranges[k]))).encode()).hexdigest() for k in sorted(ranges)]
    return hashlib.sha256(":".join([str(len(data)), ":".join(leaves)] if leaves else [str(len(data))]).encode()).hexdigest()


def test_manifest_and_checksum(spark, tmp_path):
    text = HEADER + "\n" + row() + row(key="b")
    put(tmp_path, f"event_date={DAY}", text)
    files = csv_tables.usage_files(spark, str(tmp_path), [DAY])
    manifest = csv_tables.source_manifest(spark, str(tmp_path), files)
    found = manifest.first()
    digest = digest_of(text.encode(), csv_tables.RANGE)
    assert (found["digest"], found["row_count"], found["object_version"]) == (digest, 2, "")
    line = f"INCREMENTAL\n{DAY}|{files[0]}||{digest}"
    assert csv_tables.usage_checksum(manifest, "INCREMENTAL") == hashlib.sha256(line.encode()).hexdigest()


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
def test_digests_do_not_depend_on_splits(spark, tmp_path, monkeypatch, split):
    """Every byte and its place counts: order, line ends, a missing last line end, an empty file."""
    monkeypatch.setattr(csv_tables, "RANGE", 500)
    lines = [f"{k},é{'x' * (k % 40)}" for k in range(200)]
    texts = {
        "a b/one.csv": "\n".join(lines) + "\n", "swapped+1.csv": "\n".join([*lines[:5], lines[6], lines[5], *lines[7:]]) + "\n",
        "crlf.csv": "\r\n".join(lines) + "\r\n", "open.csv": "\n".join(lines), "none.csv": "", "blank.csv": "\n\n",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    try:
        for key in keys:
            spark.conf.set(key, split)
        found = {r.file: r.digest for r in csv_tables.file_digests(spark, str(tmp_path), list(texts)).collect()}
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)
    assert found == {name: digest_of(text.encode(), 500) for name, text in texts.items()}
    assert len(set(found.values())) == len(texts)


def test_empty_files_are_listed(spark, tmp_path):
    put(tmp_path, f"event_date={DAY}", HEADER + "\n" + row())
    (tmp_path / f"event_date={DAY}" / "part-1.csv").write_bytes(b"")
    files = csv_tables.usage_files(spark, str(tmp_path), [DAY])
    assert sorted(r["row_count"] for r in csv_tables.source_manifest(spark, str(tmp_path), files).collect()) == [0, 1]
    folder = tmp_path / "tables" / "users.csv"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("a\n1\n")
    one = csv_tables.table_hashes(spark, str(tmp_path / "tables"), ["users"]).collect()
    (folder / "part-1.csv").write_bytes(b"")
    two = csv_tables.table_hashes(spark, str(tmp_path / "tables"), ["users"]).collect()
    assert len(one) == len(two) == 1 and one[0]["digest"] != two[0]["digest"]


def test_day_rules():
    d = date
    assert refresh.eligible_days([d(2024, 1, 3), d(2024, 1, 1), d(2024, 1, 5)], d(2024, 1, 1), d(2024, 1, 5)) == [d(2024, 1, 3)]
    with pytest.raises(refresh.LoadRejected):
        refresh.require_no_gap([d(2024, 1, 3)], d(2024, 1, 1), d(2024, 1, 4))
    with pytest.raises(refresh.LoadRejected):
        refresh.require_no_gap([], d(2024, 1, 1), d(2024, 1, 4))
    refresh.require_no_gap([], d(2024, 1, 3), d(2024, 1, 4))
    days = refresh.days_between(d(2024, 1, 1), d(2024, 1, 10))
    assert [len(b) for b in refresh.batches(days)] == [7, 3]
    window = refresh.rebuild_window("CORRECTION", d(2024, 1, 5), d(2024, 1, 5), d(2024, 2, 3))
    assert (window.rebuild_to, window.month_first) == (d(2024, 1, 31), d(2024, 1, 1))
    assert refresh.rebuild_window("CORRECTION", d(2024, 2, 1), d(2024, 2, 1), d(2024, 2, 3)).rebuild_to == d(2024, 2, 3)
    checks = {"watermark": d(2024, 1, 5), "cutoff": d(2024, 1, 20), "initialized": True}
    refresh.check_request("INCREMENTAL", d(2024, 1, 6), d(2024, 1, 7), **checks)
    for kind, first, last in (
        ("INCREMENTAL", d(2024, 1, 7), d(2024, 1, 8)), ("INCREMENTAL", d(2024, 1, 6), d(2024, 1, 21)),
        ("CORRECTION", d(2024, 1, 6), d(2024, 1, 6)), ("OTHER", d(2024, 1, 6), d(2024, 1, 6)),
    ):
        with pytest.raises(refresh.LoadRejected):
            refresh.check_request(kind, first, last, **checks)


def test_premium_ages_and_open_ranges(spark):
    source = stage(spark, [DAY])
    assert dict(quality.assert_zero(quality.staging_rules(source)))["staging_age_benefit_range"] == 0
    half = source.premium_family_discount_rules.selectExpr(
        "* except (enrollment_max_age)", "cast(18.5 as decimal(38,10)) as enrollment_max_age"
    )
    with pytest.raises(QualityError, match="staging_premium_family_age_integer: 2"):
        quality.assert_zero(quality.staging_rules(source.replace(premium_family_discount_rules=half)))


def test_analysis_release(spark, tmp_path):
    release = analysis_release(stage(spark, [DAY]), secret=SECRET, reference_date="2024-03-15")
    user = release.users.orderBy("tenure_months").first()
    assert user["subscription_cohort"] == "2024-02" and user["tenure_months"] == 1
    assert not {"name", "age", "user_id"} & set(release.users.columns)
    manifest = write_analysis_release(release, str(tmp_path / "out"), reference_date="2024-03-15")
    assert manifest["tables"]["users"]["row_count"] == 4
    assert len(manifest["tables"]) == 14


def test_catalogue_checks_requests(spark):
    from meterline.plans import query_catalog as catalog
    from meterline.plans.area import operations_area, personalization_area

    source = stage(spark, [DAY, date(2024, 2, 2)])
    pers = personalization_area(source, reference_date="2024-02-03")
    ops = operations_area(source, secret=SECRET, reference_date="2024-02-03")
    found = catalog.run(pers, "PERS_002", {"user_id": "U1", "year_month": "2024-02"}).collect()
    assert [r["calendar_date"] for r in found] == [date(2024, 2, 2)]
    bad = [
        (pers, "PERS_999", {}), (pers, "OPS_ANALYSIS_006", {}), (pers, "PERS_008", {}),
        (pers, "PERS_008", {"user_id": ""}), (pers, "PERS_002", {"user_id": "U1", "year_month": "2024-13"}),
        (ops, "OPS_ANALYSIS_002", {"start_date": "2024-02-01", "end_date_exclusive": "2024-02-01"}),
        (ops, "OPS_ANALYSIS_001", {"as_of_date": "2024-02-30"}),
    ]
    for area, query, parameters in bad:
        with pytest.raises(catalog.QueryRejected):
            catalog.prepare(area, query, parameters)
    with pytest.raises(catalog.QueryRejected):
        catalog.prepare(pers, "PERS_008", {"user_id": "U1"}, catalog.disable(catalog.CATALOG, "PERS_008"))
    from dataclasses import replace

    tight = {**catalog.CATALOG, "PERS_009": replace(catalog.CATALOG["PERS_009"], max_rows=0)}
    with pytest.raises(catalog.QueryRejected, match="more than 0"):
        catalog.run(pers, "PERS_009", {"user_id": "U1"}, tight)


def test_unknown_usage_users_and_ranges(spark):
    source = stage(spark, [DAY])
    usage = source.content_usage.selectExpr("date'2024-01-31' as partition_event_date", "*")
    manifest = spark.createDataFrame([("f", DAY, "", "x", 1)], "source_path string, event_date date, object_version string, digest string, row_count bigint")
    users = masters(spark).users.where("user_id<>'U4'")
    found = {
        r["rule_name"]: r["failed_rows"]
        for r in quality.incremental_staging_rules(usage, users, manifest, "2024-02-01", "2024-02-02").collect()
    }
    assert found == {
        "incremental_partition_date_match": 4, "incremental_date_range": 4, "incremental_user_fk": 1,
        "incremental_manifest_rows": 1, "incremental_content_usage_required": 0, "incremental_usage_negative": 0,
        "incremental_content_usage_key": 0, "incremental_content_usage_grain": 0}
    assert frame(spark, "content_usage", []).count() == 0
