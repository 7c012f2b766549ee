"""Tables compared by cells: the same rows as an exact comparison, and only cells that differ are read again."""

import random

from pyspark.sql import functions as F

from meterline.operators import fingerprints
from meterline.operators.relations import reconcile, symmetric_difference

SCHEMA = "id string, day int, mb double, note string, tags array<string>"


def some_rows(count=400):
    rng = random.Random(3)
    return [
        (f"i{k}", rng.choice([None, *range(6)]), rng.choice([None, 1.0, 2.5, 3.0]), rng.choice([None, "", "x"]), rng.choice([None, [None], ["a", None], [None, "a"]]))
        for k in range(count)
    ]


def found(df):
    return sorted(map(repr, df.collect()))


def test_same_as_exact(spark):
    rows = some_rows()
    old = spark.createDataFrame(rows, SCHEMA)
    broken = [r for r in rows[5:]] + [(None, None, None, None, None), ("new", 3, 4.0, "y", ["a"]), rows[9], rows[9]]
    broken[3] = (broken[3][0], 5, *broken[3][2:])
    broken[7] = (*broken[7][:4], ["b"])
    new = spark.createDataFrame(broken, SCHEMA)
    for part in (None, "day"):
        for buckets in (1, 64):
            got = fingerprints.changed_rows(old, new, ["id"], part, buckets)
            assert found(got) == found(symmetric_difference(old, new)) and got.count() > 6
    unique = new.dropDuplicates(["id"])
    assert found(fingerprints.changed_keys(old, unique, "id", ["mb", "note"])) == found(reconcile(old, unique, "id", ["mb", "note"]))


def test_swapped_nulls_and_arrays_are_seen(spark):
    schema = "id long, a string, b string, tags array<string>"
    old = spark.createDataFrame([(1, None, "x", ["a", None]), (2, "x", None, None)], schema)
    new = spark.createDataFrame([(1, "x", None, ["a", None]), (2, "x", None, [None])], schema)
    assert fingerprints.changed_rows(old, new, ["id"]).count() == 4
    swapped = spark.createDataFrame([(1, None, "x", [None, "a"]), (2, "x", None, None)], schema)
    assert fingerprints.changed_rows(old, swapped, ["id"]).count() == 2


def test_equal_tables_types_and_order(spark):
    rows = some_rows()
    old = spark.createDataFrame(rows, SCHEMA)
    other = spark.createDataFrame(rows[::-1], SCHEMA).select("tags", "note", F.col("mb").cast("float").alias("mb"), F.col("day").cast("long").alias("day"), "id")
    assert fingerprints.differing_cells(*fingerprints.same_types(old, other), ["id"], "day").count() == 0
    assert fingerprints.changed_rows(old, other, ["id"], "day").count() == 0
    assert fingerprints.changed_rows(old.limit(0), other.limit(0), ["id"]).count() == 0
    assert fingerprints.changed_rows(old.limit(0), other, ["id"]).count() == old.distinct().count()


def test_only_parts_that_differ_are_read_again(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = spark.range(1000).select("id", (F.col("id") % 10).alias("day"), F.lit("x").alias("note"))
    rows.write.partitionBy("day").parquet(old)
    rows.withColumn("note", F.when(F.col("id") == 503, "y").otherwise("x")).write.partitionBy("day").parquet(new)
    got = fingerprints.changed_rows(spark.read.parquet(old), spark.read.parquet(new), ["id"], "day")
    assert sorted((r.id, r.note) for r in got.collect()) == [(503, "x"), (503, "y")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "= 3)" in plan
