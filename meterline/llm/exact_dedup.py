"""Exact duplicates of texts through an extendible-hash index on shared files.

A text's key is a 64-bit hash of its normalised form. The index holds one chain for each key: its rows' number and the
row that stays, summed before they are shuffled, so copies without end are one chain. Chains lie in buckets named by the first
bits of the key. The directory doubles (one bit more at a time) wherever a bucket holds more than CAPACITY chains,
and only there. Its owner tasks write the index in key ranges to the shared folder, from where all later steps read it.

Rows that share a key are compared byte by byte. Keys that hold several texts are collisions; their chains are
told apart by the texts themselves. Texts of unshared keys never leave the task that reads them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settle

#: Chains of a bucket, at most (but for keys that no further bit tells apart).
CAPACITY = 1 << 16
#: Doublings of the directory that one aggregation decides on.
DOUBLINGS = 6
#: Shared keys that travel to every task, at most: 16 MiB of them. Beyond that, texts are joined with them by key.
HELD_KEYS = 1 << 20


def normalised() -> Column:
    """The text with A-Z (and no other letters) in lower case, a null as an empty one."""
    return F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def start_of(key: str, depth: Column | int) -> Column:
    """Where the range of keys begins that share their first depth bits (1 to 64) with key."""
    rest = F.lit(64) - depth
    return F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col(key), rest), rest)


def directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """cell, cell_depth, bucket, depth: which bucket (named by its first key) each cell of the key space lies in.

    A cell is a range of keys with equal first cell_depth bits. Cells are counted in one aggregation; the directory
    then doubles over these counts, which are some 2 ** DOUBLINGS for each bucket.
    """
    n = keys.count()
    low = min(bits, max(1, (n // capacity).bit_length() - 1))
    parts, left = [], keys
    while True:
        high = min(bits, low + DOUBLINGS)
        counted = left.groupBy(start_of("key", high).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        depth = F.lit(None).cast("int") if high < bits else F.lit(bits)
        for g in range(high, low - 1, -1):
            held = F.sum("n").over(Window.partitionBy(start_of("cell", g)))
            depth = F.when(held <= capacity, F.lit(g)).otherwise(depth)
        cells = settle(counted.select("cell", "n", depth.alias("depth")), "cells")
        kept = cells.filter("depth is not null").withColumn("bucket", start_of("cell", F.col("depth")))
        parts.append(kept.select("cell", F.lit(high).alias("cell_depth"), "bucket", "depth"))
        over = cells.filter("depth is null").select("cell")
        if over.isEmpty():
            break
        left = settle(left.withColumn("cell", start_of("key", high)).join(over, "cell", "left_semi").select("key"), "overfull")
        low = high
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def index(entries: DataFrame, capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """bucket, depth, key, n (rows), keep (largest doc_id, and its row) of each chain, in files by key range."""
    chains = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
    chains = settle(chains, "chains")
    cells = settle(directory(chains.select("key"), capacity, bits), "directory")
    placed = None
    for row in cells.select("cell_depth").distinct().collect():  # at most 64 / DOUBLINGS depths
        some = cells.filter(F.col("cell_depth") == row["cell_depth"]).drop("cell_depth")
        part = chains.withColumn("cell", start_of("key", row["cell_depth"])).join(some, "cell").drop("cell")
        placed = part if placed is None else placed.unionByName(part)
    if placed is None:
        return chains.select(F.col("key").alias("bucket"), F.lit(1).alias("depth"), "key", "n", "keep")
    owners = placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return settle(owners.select("bucket", "depth", "key", "n", "keep"), "index")


def collisions(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The keys of shared under which different texts lie, found by comparing their bytes."""
    few = shared.count() <= HELD_KEYS
    met = rows.select("key", "norm").join(F.broadcast(shared) if few else shared, "key", "left_semi")
    texts = met.distinct()
    return settle(texts.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("key"), "collisions")


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs.

    Texts are equal when identical after lower-casing A-Z; a null text equals an empty one. Of equal texts the row with
    the largest doc_id stays, exactly one even where rows repeat an id. A row without an id stays only if no
    row of its group has one; keep_id is null then. An empty table gives no rows; other columns are neither read nor
    returned. bits and capacity are the key's length and the room of a bucket; a short key means collisions, not
    other results.
    """
    norm = normalised()
    key = F.xxhash64(norm)
    rows = docs.select("doc_id", norm.alias("norm"), (key if bits == 64 else start_of_column(key, bits)).alias("key"))
    entries = settle(
        rows.select("doc_id", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
        .withColumn("row", F.monotonically_increasing_id()),
        "entries",
    )
    chains = index(entries, capacity, bits)
    shared = chains.filter("n > 1").select("key", "n", "keep")
    mixed = collisions(rows, shared.select("key"))

    plain = entries.join(shared.join(mixed, "key", "left_anti"), "key", "left")
    told = plain if mixed.isEmpty() else plain.join(mixed, "key", "left_anti")
    out = result(told)
    if not mixed.isEmpty():
        # Different texts under one key: each has a chain of its own, named by the text.
        texts = settle(rows.join(mixed, "key", "left_semi").withColumn("row", F.monotonically_increasing_id()), "mixed")
        each = texts.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
        met = texts.join(each, ["key", "norm"])
        out = out.unionByName(result(met.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))))
    return out


def start_of_column(key: Column, bits: int) -> Column:
    rest = F.lit(64 - bits)
    return F.call_function("shiftleft", F.call_function("shiftrightunsigned", key, rest), rest)


def result(rows: DataFrame) -> DataFrame:
    """The contract's columns of rows with the n and keep of their chain, both null for a text that is alone."""
    alone = F.col("n").isNull()
    return rows.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep")["doc_id"]).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep")["row"])).alias("kept"), "text_sha256",
    )
