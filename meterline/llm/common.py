"""Helpers of several operators: tables in the shared folder, Arrow batches of texts, hashes and words."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import shared_folder

#: Bytes of text that a task turns into numpy arrays at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20

#: Spark's limit on the bytes of an Arrow batch, 64 MB unless set; a task holds a batch in the JVM and in its worker.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """df written once to a new table of the shared folder and read again.

    It cuts the lineage, and rows that depend on task order cannot change when a task runs again later.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches of size at most, or one row, for the jobs that run inside."""
    before = spark.conf.get(BATCH_LIMIT)
    spark.conf.set(BATCH_LIMIT, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_LIMIT, before)


def literal_rows(spark: SparkSession, schema: str, rows: list[dict]) -> DataFrame:
    """A few rows as a constant of the plan."""
    import json

    text = json.dumps(rows)
    parsed = F.from_json(F.lit(text), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def worker_cache() -> dict:
    """What a Python worker keeps from task to task, such as a tokenizer it has read."""
    module = sys.modules.setdefault("_text_worker_cache", types.ModuleType("_text_worker_cache"))
    return module.__dict__


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text with a null text as an empty one, and the columns of more."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def mapped(
    df: DataFrame, block: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, limit: int = BLOCK_BYTES
) -> DataFrame:
    """block over slices of df whose text has limit bytes at most, or one row."""
    return df.mapInArrow(lambda batches: map(block, slices(batches, limit=limit)), schema)


def appended(docs: DataFrame, add: Callable[[pa.Array], dict[str, pa.Array]], schema: str) -> DataFrame:
    """docs with columns (named by schema) that add makes from the texts, a null text being an empty one."""

    own = fresh_name(docs, "text")

    def extend(batches):
        for batch in batches:
            text = batch.column("text")
            rows = batch.append_column(own, text.fill_null("") if text.null_count else text)
            for part in slices([rows], own):
                new = add(part.column(own))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *new.values()], [*batch.schema.names, *new]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(extend, f"{fields}, {schema}")


def fresh_name(docs: DataFrame, base: str) -> str:
    """A column name that docs doesn't have, in any case of letters."""
    taken = {name.lower() for name in docs.columns}
    while base in taken:
        base = f"_{base}"
    return base


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _ends(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)


def byte_lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text of a column without nulls."""
    return np.diff(_ends(texts)).astype(np.int64) if len(texts) else np.zeros(0, np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column without nulls, one after another, and where each starts and ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = _ends(texts).astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(data: np.ndarray, seed: int = 7) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of starts and ends that gives the 64-bit hash of data[start:end] for each of them."""
    cache = worker_cache()
    size = 1 << max(16, int(len(data)).bit_length())
    if cache.get("power_size", 0) < size:
        base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            cache["power"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]))
            cache["root"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse, np.uint64)]))
        cache["power_size"] = size
    letters = np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * cache["power"][: len(data)], out=sums[1:])

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * cache["root"][start] + (end - start).astype(np.uint64))

    return hashes


def word_bounds(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the words [^\\x20\\x09-\\x0D]+ of all texts, and the first word of each text (and the end)."""
    inside = ~SPACES[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = ends[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, ends)


def by_segment(reduce: np.ufunc, values: np.ndarray, bounds: np.ndarray, empty) -> np.ndarray:
    """reduce over values[bounds[i]:bounds[i + 1]] for each i, empty where there are none."""
    sizes = np.diff(bounds)
    out = np.full((len(sizes), *values.shape[1:]), empty, values.dtype)
    if (full := sizes > 0).any():
        out[full] = reduce.reduceat(values, bounds[:-1][full], axis=0)
    return out


def batch(schema: str | None = None, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)
