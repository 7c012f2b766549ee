"""Source tables as headered UTF-8 CSV: master tables, one usage file, or usage by day."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from meterline.plans.tables import Tables
from meterline.schemas import MASTER_TABLES, SOURCE_SCHEMAS
from meterline.sources import paths

_DAY_FOLDER = re.compile(r"^event_date=(\d{4}-\d{2}-\d{2})$")
_PART_FILE = re.compile(r"^part-[^/]*\.csv$")
#: Bytes of a range of a file that is named on its own.
RANGE = 4 << 20
_VERSION = re.compile(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$")


class SourceProblem(ValueError):
    """Missing, ambiguous or malformed input files."""


def read_csv(
    spark: SparkSession, files: str | Sequence[str], table: str,
    headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed rows of CSV files whose header must name exactly the table's columns, in order.

    `headers` maps header names that differ to column names. A header mismatch or a value that does
    not fit its type fails the job.
    """
    schema = SOURCE_SCHEMAS[table]
    differing = {column: header for header, column in (headers or {}).items()}
    expected = StructType(
        [StructField(differing.get(f.name, f.name), f.dataType) for f in schema.fields]
    )
    rows = (
        spark.read.schema(expected)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("encoding", "UTF-8")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(files if isinstance(files, str) else list(files))
    )
    return rows.withColumnsRenamed({h: c for c, h in differing.items()})


def read_master(
    spark: SparkSession, folder: str, headers: Mapping[str, Mapping[str, str]] | None = None
) -> Tables:
    """The 13 master tables of a folder."""
    named = headers or {}

    def load(name: str) -> DataFrame:
        path = paths.join(folder, name + ".csv")
        if not paths.exists(spark, path):
            raise SourceProblem(f"required source file is missing: {path}")
        return read_csv(spark, path, name, named.get(name))

    return Tables(**{name: (lambda name=name: load(name)) for name in MASTER_TABLES})


def read_usage_full(spark: SparkSession, folder: str) -> DataFrame:
    return read_csv(spark, paths.join(folder, "content_usage.csv"), "content_usage")


def partition_days(spark: SparkSession, root: str) -> list[date]:
    """Days that have a folder, in order."""
    found = (_DAY_FOLDER.match(name) for name in paths.children(spark, root, files=False))
    return sorted(date.fromisoformat(match.group(1)) for match in found if match)


def usage_files(
    spark: SparkSession, root: str, days: Iterable[date], version: str | None = None,
    direct_only: bool = False,
) -> list[str]:
    """Part files of the wanted days, as paths relative to the root.

    With a version only that version's folder counts. Otherwise files directly in the day folder win;
    without any, exactly one version folder may stand in, unless `direct_only`.
    """
    if version is not None and not _VERSION.match(version):
        raise SourceProblem("a version is 1 to 128 letters, digits, dots, dashes or underscores")
    chosen: list[str] = []
    for day in days:
        folder = f"event_date={day.isoformat()}"
        if not paths.exists(spark, paths.join(root, folder)):
            raise SourceProblem(f"required content partition is missing: {folder}")
        if version is not None:
            folder = f"{folder}/run_id={version}"
        elif not _parts(spark, root, folder) and not direct_only:
            versions = [
                name for name in paths.children(spark, paths.join(root, folder), files=False)
                if name.startswith("run_id=")
            ]
            if len(versions) != 1:
                raise SourceProblem(f"{folder} needs direct part files or exactly one version")
            folder = f"{folder}/{versions[0]}"
        names = _parts(spark, root, folder)
        if not names:
            raise SourceProblem(f"no part files in {folder}")
        chosen += [f"{folder}/{name}" for name in names]
    return chosen


def _parts(spark: SparkSession, root: str, folder: str) -> list[str]:
    names = paths.children(spark, paths.join(root, folder), files=True)
    return [name for name in names if _PART_FILE.match(name)]


def relative_path(path: Column) -> Column:
    return F.regexp_extract(path, r"(event_date=\d{4}-\d{2}-\d{2}/.*)$", 1)


def event_date_of(path: Column) -> Column:
    return F.regexp_extract(path, r"event_date=(\d{4}-\d{2}-\d{2})/", 1).cast("date")


def read_usage_files(spark: SparkSession, root: str, files: Sequence[str]) -> DataFrame:
    """Usage rows with the partition day and the file each row came from."""
    rows = read_csv(spark, [paths.join(root, name) for name in files], "content_usage")
    path = F.col("_metadata.file_path")
    return rows.select(
        event_date_of(path).alias("partition_event_date"),
        relative_path(path).alias("source_path"),
        *rows.columns,
    )


def read_usage_partitions(
    spark: SparkSession, root: str, days: Iterable[date], version: str | None = None
) -> DataFrame:
    return read_usage_files(spark, root, usage_files(spark, root, days, version))


def write_usage_partitions(usage: DataFrame, root: str, file_format: str = "csv") -> None:
    """One folder per day. Rebalancing splits a large day over several files and joins small ones."""
    days = usage.withColumn("event_date", F.col("usage_date")).hint("rebalance", "event_date")
    days.write.partitionBy("event_date").option("header", True).mode("overwrite").format(
        file_format
    ).save(root)


def source_manifest(
    spark: SparkSession, root: str, files: Sequence[str], version: str | None = None
) -> DataFrame:
    """(source_path, event_date, object_version, digest, row_count) of the chosen files, also of those without any byte."""
    hashes = file_digests(spark, root, files).select(
        F.col("file").alias("source_path"),
        event_date_of(F.col("file")).alias("event_date"),
        F.lit(version or "").alias("object_version"),
        "digest",
    )
    counts = read_usage_files(spark, root, files).groupBy("source_path").agg(
        F.count("*").alias("row_count")
    )
    return hashes.join(counts, "source_path", "left").na.fill(0, ["row_count"])


def table_hashes(spark: SparkSession, folder: str, tables: Sequence[str]) -> DataFrame:
    """(source_name, digest) of whole table files, each of which may be a folder of part files."""
    files = []
    for table in tables:
        name = f"{table}.csv"
        parts = [part for part in paths.children(spark, paths.join(folder, name), files=True) if part[0] not in "._"]
        files += [name] if parts in ([], [name]) else [f"{name}/{part}" for part in parts]
    each = F.concat_ws(":", "file", "digest")
    named = file_digests(spark, folder, files).withColumn("source_name", F.substring_index("file", ".csv", 1))
    return named.groupBy("source_name").agg(F.sha2(F.array_join(F.sort_array(F.collect_list(each)), "\n"), 256).alias("digest"))


def file_digests(spark: SparkSession, root: str, files: Sequence[str]) -> DataFrame:
    """(file, digest) of text files below a root: a tree over fixed byte ranges of each.

    A file is read in splits, and no task holds it. Every line is named by its place in bytes and its content; a
    range of RANGE bytes by the number of its lines and two sums over their names; the file by its size and the names of its
    ranges in order. So a changed, moved or re-ended line changes the digest, the way the file was split does not.
    A file without any byte has a digest too.
    """
    sizes = spark.createDataFrame([(name, paths.size(spark, paths.join(root, name))) for name in files], "file string, size bigint")
    path = F.col("_metadata.file_path")
    lines = (
        spark.read.option("lineSep", "\n").text([paths.join(root, name) for name in files])
        .select(
            below(spark, root, path).alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("number"), (F.octet_length("value") + 1).alias("bytes"),
            F.unhex(F.md5(F.col("value").cast("binary"))).alias("content"),
        )
    )
    before = Window.partitionBy("file", "split").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("bytes").alias("bytes"))
    splits = splits.select("file", "split", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("start"))
    inside = lines.withColumn("place", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    placed = inside.join(splits, ["file", "split"]).withColumn("place", F.col("place") + F.col("start"))
    named = placed.select("file", F.expr(f"place div {RANGE}").alias("range"), F.md5(F.concat_ws(":", "place", F.hex("content"))).alias("name"))

    def total(start: int) -> Column:
        return F.sum(F.conv(F.substring("name", start, 15), 16, 10).cast("decimal(28,0)"))

    ranges = named.groupBy("file", "range").agg(F.count("*").alias("n"), total(1).alias("low"), total(17).alias("high"))
    leaf = F.struct("range", F.sha2(F.concat_ws(":", "range", "n", "low", "high"), 256).alias("name"))
    # A name for each RANGE bytes of a file meets here.
    trees = ranges.groupBy("file").agg(F.array_sort(F.collect_list(leaf))["name"].alias("leaves"))
    found = sizes.join(trees, "file", "left")
    return found.select("file", F.sha2(F.concat_ws(":", F.col("size"), F.array_join("leaves", ":")), 256).alias("digest"))


def below(spark: SparkSession, root: str, path: Column) -> Column:
    """A file's path, as Spark names it, relative to a root."""
    plain = F.url_decode(F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), r"\+", "%2B"))
    return F.substring(plain, F.lit(len(paths.absolute(spark, root).rstrip("/")) + 2), F.length(plain))


def set_checksum(entries: DataFrame, line: Column, *order: str, heading: str | None = None) -> str:
    """SHA-256 over one line per source file, in a fixed order; a row per file meets here."""
    lines = entries.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))), lambda r: r["line"]
        ).alias("lines")
    )
    text = F.array_join("lines", "\n")
    if heading is not None:
        text = F.concat(F.lit(heading + "\n"), text)
    return lines.select(F.sha2(text, 256).alias("checksum")).first()["checksum"]


def usage_checksum(manifest: DataFrame, run_type: str) -> str:
    line = F.concat_ws("|", "event_date", "source_path", "object_version", "digest")
    return set_checksum(manifest, line, "event_date", "source_path", heading=run_type)


def snapshot_checksum(hashes: DataFrame, tables: Sequence[str]) -> str:
    position = F.array_position(F.array(*[F.lit(name) for name in tables]), F.col("source_name"))
    line = F.concat_ws(":", "source_name", "digest")
    return set_checksum(hashes.withColumn("position", position), line, "position")
