"""Comparing two large tables by fingerprints of cells, and by rows only where these differ.

A cell is a partition value and a bucket of the key. Its fingerprint is a count and sums of two 64-bit hashes of its
rows, so it does not depend on their order and combines before the shuffle: of equal cells nothing but one row a task
is shuffled, and their rows are read once. Rows of the other cells are compared exactly. Two unlike cells have the
same fingerprint with a probability of about 2**-100; a cell may hold 2**31 rows before a sum overflows, which
fails and is not taken for a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from meterline.operators.relations import reconcile, symmetric_difference
from meterline.session import shared_folder

#: Buckets of the key in each partition.
BUCKETS = 256
#: Up to so many partitions, their values go to the scans as a filter; beyond, cells are only joined.
LISTED_PARTS = 1000
SUMS = ["n", "a_low", "a_high", "b_low", "b_high"]


def _hashed(column: str, kind: DataType) -> list[Column]:
    """What is hashed of a column: hashes pass over nulls, so whether it is null is hashed too."""
    value = F.col(column)
    if isinstance(kind, (ArrayType, StructType)):
        value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
    return [F.isnull(F.col(column)), value]


def _mark(schema: StructType, columns: Sequence[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[x for name in columns for x in _hashed(name, schema[name].dataType)])


def same_types(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of left, of the types that a union of the two would have."""
    right = right.select(*left.columns)
    schema = left.limit(0).unionByName(right.limit(0)).schema
    wanted = [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    return left.select(*wanted), right.select(*wanted)


def _cell(schema: StructType, key: Sequence[str], part: str | None, buckets: int) -> list[Column]:
    bucket = F.pmod(_mark(schema, key, 0), F.lit(buckets)).cast("int").alias("_bucket")
    return [(F.col(part) if part else F.lit(None).cast("string")).alias("_part"), bucket]


def differing_cells(
    left: DataFrame, right: DataFrame, key: Sequence[str], part: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """_part and _bucket of the cells whose rows differ, repeated rows counted. Columns and types must be the same."""

    def sides(df: DataFrame, sign: int) -> DataFrame:
        a, b = [_mark(df.schema, df.columns, salt) for salt in (1, 2)]
        halves = [half for x in (a, b) for half in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(x, 32))]
        signed = [(x * F.lit(sign)).alias(name) for name, x in zip(SUMS, [F.lit(1).cast("long"), *halves])]
        return df.select(*_cell(df.schema, key, part, buckets), *signed)

    rows = sides(left, 1).unionByName(sides(right, -1))
    sums = rows.groupBy("_part", "_bucket").agg(*[F.sum(x).alias(x) for x in SUMS])
    return sums.where(" or ".join(f"{x} <> 0" for x in SUMS)).select("_part", "_bucket")


def _unequal(
    left: DataFrame, right: DataFrame, key: Sequence[str], part: str | None, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """The rows of both frames in cells that differ."""
    spark = left.sparkSession
    folder = f"{shared_folder(spark)}/cells-{uuid4().hex}"
    differing_cells(left, right, key, part, buckets).write.parquet(folder)
    cells = spark.read.parquet(folder)
    if part:
        listed = [row[0] for row in cells.select("_part").distinct().limit(LISTED_PARTS + 1).collect()]
        if len(listed) <= LISTED_PARTS:
            among = F.col(part).isin([x for x in listed if x is not None])
            among = among | F.col(part).isNull() if None in listed else among
            left, right = left.where(among), right.where(among)
    elif cells.isEmpty():
        left, right = left.limit(0), right.limit(0)

    def met(df: DataFrame) -> DataFrame:
        own = df.select("*", *_cell(df.schema, key, part, buckets)).alias("o")
        same = F.col("o._part").eqNullSafe(F.col("c._part")) & (F.col("o._bucket") == F.col("c._bucket"))
        return own.join(cells.alias("c"), same, "left_semi").drop("_part", "_bucket")

    return met(left), met(right)


def changed_rows(
    left: DataFrame, right: DataFrame, key: Sequence[str], part: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Rows that only one of two tables has, one row per distinct difference, as symmetric_difference gives them.

    key are columns of both that spread the rows, part a partition column of both if there is one. Nulls equal nulls;
    a row that one side only repeats is no difference; empty tables are equal. Columns of type map can't be compared.
    """
    left, right = same_types(left, right)
    return symmetric_difference(*_unequal(left, right, list(key), part, buckets))


def changed_keys(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Keys missing on one side or with a differing value, as reconcile gives them; a key has one row on each side."""
    left, right = same_types(left.select(key, *columns), right.select(key, *columns))
    return reconcile(*_unequal(left, right, [key], None, buckets), key, columns)
