"""Registered queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, IntegerType, ShortType

from checks.fixtures import FIXTURES, source_tables
from meterline.plans.area import Area, operations_area, personalization_area
from meterline.plans.tables import Tables
from meterline.session import configure_tables

SECRET = "fixture-secret-of-more-than-32-characters"
REFERENCE = "2001-09-01"
RECENT_REFERENCE = "2024-01-31"
#: Parts that a shuffle starts from; small ones are joined at run time, so a task's share stays small on large tables.
FIRST_PARTS = "256"
START, END = "1996-01-01", "1997-01-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
LAYERS: dict[str, str] = {}


class Context:
    """Fixture tables of one folder and the areas built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure_tables(spark)
        self.spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", FIRST_PARTS)
        self.folder = folder
        self.stage: Tables = source_tables(spark, folder)
        self.recent: Tables = source_tables(spark, folder, recent=True)

    @property
    def ops(self) -> Area:
        return operations_area(self.stage, secret=SECRET, reference_date=REFERENCE)

    @property
    def pers(self) -> Area:
        return personalization_area(self.stage, reference_date=REFERENCE)

    @property
    def now(self) -> Area:
        return personalization_area(self.recent, reference_date=RECENT_REFERENCE)


def plain(df: DataFrame) -> DataFrame:
    """Comparable types: decimals as double, small integers as bigint."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DecimalType, FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (IntegerType, ShortType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def check(name: str, sql: str | None = None):
    """Register a builder over a Context, and the SQL that must give the same rows."""

    def register(build: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(build(Context(spark, str(folder))))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def layer(name: str, sql: str) -> None:
    """A named step of the oracle SQL."""
    LAYERS[name] = sql


def _words(text: str) -> set[str]:
    for mark in "(),;":
        text = text.replace(mark, " ")
    return set(text.split())


def oracle_text(body: str) -> str:
    """Body with the layers and fixtures it uses as common table expressions."""
    known = {**FIXTURES, **LAYERS}
    ordered: list[str] = []

    def visit(text: str, own: str | None) -> None:
        used = _words(text)
        for name, definition in known.items():
            if name in used and name != own and name not in ordered:
                visit(definition, name)
                ordered.append(name)

    visit(body, None)
    if not ordered:
        return body
    steps = ",\n".join(f"{name} as materialized ({known[name]})" for name in ordered)
    joiner = ",\n" if body.lstrip().lower().startswith("with ") else "\n"
    body = body.lstrip()[5:] if joiner == ",\n" else body
    return f"with recursive {steps}{joiner}{body}"


# --- SQL text helpers -----------------------------------------------------------------------------


def rnd(num: str, den: str, digits: int) -> str:
    """num/den rounded half up in integer arithmetic, as double; null for a zero divisor."""
    scale = 10**digits
    d = f"nullif(cast({den} as hugeint),0)"
    return f"(cast((2*cast({num} as hugeint)*{scale}+{d})//(2*{d}) as double)/{scale})"


def key_sql(domain: str, prefix: str, column: str) -> str:
    key = SECRET.encode().ljust(64, b"\0")
    inner = "".join(f"\\x{b ^ 0x36:02X}" for b in key)
    outer = "".join(f"\\x{b ^ 0x5C:02X}" for b in key)
    return (
        f"case when {column}<>'' then '{prefix}'||upper(substring(sha256('{outer}'::blob||"
        f"unhex(sha256('{inner}'::blob||encode('{domain}:'||{column})))),1,24)) end"
    )


BAND_SQL = (
    "case when age between 8 and 12 then '8-12' when age between 13 and 18 then '13-18' "
    "when age between 19 and 24 then '19-24' when age between 25 and 34 then '25-34' "
    "when age between 35 and 49 then '35-49' when age between 50 and 64 then '50-64' "
    "else '65+' end"
)


def day_key(column: str) -> str:
    return f"cast(strftime({column},'%Y%m%d') as bigint)"


def month_of(column: str) -> str:
    return f"cast(date_trunc('month',{column}) as date)"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: oracle_text(sql) for name, sql in ORACLES.items()}
