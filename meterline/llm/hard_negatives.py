"""Hard negatives of anchor vectors by a vertical scan of columnar blocks.

Rows are cut into blocks whose components lie dimension by dimension, with the least and largest value of each. An
anchor reads a block's dimensions in the order of its own magnitudes, some at a time. What the dimensions still unread
can add to a score lies between two bounds, from the block's extremes; rows that these bounds exclude leave the
anchor's bitmap of candidates, so later dimensions are read for fewer and fewer rows.

The scan is made twice: for the positives (the best rows of the anchor's label), and, once these are known, for the
windows of scores that they open, each with its best rows of other labels. A block answers with as many rows as
the whole table could at most; the answers of all blocks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settle

#: Components are multiplied by SCALE and rounded down.
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least LOW and at most HIGH hundredths of its positive's.
LOW, HIGH = 30, 90
#: Rows or anchors of a block at most, on average, and bytes of its components.
BLOCK, BLOCK_BYTES = 4096, 8 << 20
#: Dimensions that are read before the candidates are looked over again.
STEP = 8
#: Partitions of the scan, at most.
TASKS = 4096
#: Components up to this size have scores that double precision holds exactly, in up to 2 ** 13 dimensions.
PLAIN = 1 << 20


def usable(rows: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label, dim, vec (floor(SCALE * x) of each component, as doubles) of rows that take part."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    plain = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter("vec_id is not null and label is not null").filter(fine)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))

    def whole(batches):
        for part in batches:
            vecs = part.column("embedding")
            x = np.floor(vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            ends = np.concatenate([[0], np.cumsum(vecs.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
            yield pa.RecordBatch.from_pydict({
                "vec_id": part.column("vec_id"), "label": part.column("label"),
                "dim": pa.array(np.diff(ends).astype(np.int32)),
                "vec": pa.array([x[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
            })

    made = plain.select("vec_id", label.alias("label"), "embedding").mapInArrow(
        whole, "vec_id long, label long, dim int, vec binary"
    )
    return settle(made.withColumn("row", F.monotonically_increasing_id()), "vectors")


def blocks(rows: DataFrame, name: str) -> DataFrame:
    """dim, block (from 0 in each dimension), rows, ids, labels, and cells: components as bytes, dimension by dimension."""
    sizes = {row["dim"]: row["n"] for row in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = {dim: -(-n // max(1, min(BLOCK, BLOCK_BYTES // (8 * dim or 8)))) for dim, n in sizes.items()}
    if not parts:
        parts = {0: 1}
    count = F.create_map(*[F.lit(x) for item in parts.items() for x in item])[F.col("dim")]
    block = F.pmod(F.xxhash64("row"), count).cast("int").alias("block")

    def turn(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        cells = np.frombuffer(b"".join(table.column("vec").to_pylist())).reshape(table.num_rows, dim)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "block": table.column("block").slice(0, 1),
            **{f"{name}s": whole_list(table.column(name)) for name in ("row", "id", "label")},
            "cells": [np.ascontiguousarray(cells.T).tobytes()],
        })

    dealt = rows.select("dim", block, "row", F.col("vec_id").alias("id"), "label", "vec").repartition(max(1, min(TASKS, sum(parts.values()))), "dim", "block")
    schema = "dim int, block int, rows array<long>, ids array<long>, labels array<long>, cells binary"
    return settle(dealt.groupBy("dim", "block").applyInArrow(turn, schema), name)


def whole_list(column: pa.ChunkedArray) -> pa.Array:
    """One list of all values of a column."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), pa.concat_arrays(column.chunks))


def met(anchors: DataFrame, held: DataFrame) -> DataFrame:
    """Every block of anchors beside every block of rows of its dimension, spread over the blocks of rows."""
    last = {row["dim"]: row["last"] for row in held.groupBy("dim").agg(F.max("block").alias("last")).collect()}
    if not last:
        last = {0: 0}
    tasks = max(1, min(TASKS, sum(last.values()) + len(last)))
    upto = F.create_map(*[F.lit(x) for item in last.items() for x in item])[F.col("dim")]
    left = anchors.select("dim", *[F.col(x).alias(f"{x}_a") for x in anchors.columns if x != "dim"])
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), upto))).repartition(tasks, "dim", "block")
    return left.join(held.repartition(tasks, "dim", "block"), ["dim", "block"])


class Columns:
    """A block as a task reads it."""

    def __init__(self, dim: int, rows: pa.Array, ids: pa.Array, labels: pa.Array, cells: bytes):
        self.rows, self.ids, self.labels = (x.to_numpy() for x in (rows, ids, labels))
        self.cells = np.frombuffer(cells).reshape(dim, len(self.rows))
        self.extremes()
        if dim > 1 << 13 or np.abs(self.cells).max(initial=0) >= PLAIN:
            self.widen()

    def widen(self) -> None:
        """Whole numbers of any size from here on, exact but slow."""
        self.cells = np.array([[int(x) for x in row] for row in self.cells], object).reshape(self.cells.shape)
        self.extremes()

    def extremes(self) -> None:
        self.least, self.most = (f(1) if len(self.cells) else np.zeros(0) for f in (self.cells.min, self.cells.max))


def scan(anchor: np.ndarray, block: Columns, some: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
    """The candidates (of places some in the block) that keep leaves after all dimensions, and their scores.

    keep(low, high, places) says which candidates stay, given the bounds of their scores.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.sort(np.stack([anchor * block.least, anchor * block.most]), 0)[:, order]
    # What the dimensions from each place of the order on can add, at least and at most.
    rest = np.concatenate([np.cumsum(ends[:, ::-1], 1)[:, ::-1], np.zeros((2, 1), ends.dtype)], 1)
    score = np.zeros(len(some), block.cells.dtype)
    for at in range(0, len(order), STEP):
        if not len(some):
            break
        dims = order[at : at + STEP]
        # Rows are gathered only once the candidates are few; until then whole dimensions are read.
        whole = len(some) == block.cells.shape[1]
        read = block.cells[dims] if whole else block.cells[np.ix_(dims, some)]
        score = score + anchor[dims] @ read
        done = min(at + STEP, len(order))
        stay = keep(score + rest[0, done], score + rest[1, done], some)
        if not stay.all():
            some, score = some[stay], score[stay]
    return some, score


def best(n: int, scores: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    """Places of the n largest scores, ties by the smallest of ties."""
    return np.lexsort((*ties[::-1], -scores))[:n]


def most_at_least(low: np.ndarray, n: int):
    """The n-th largest of low: what a row must be able to reach."""
    return np.partition(low, len(low) - n)[len(low) - n] if len(low) >= n else None


def positives(pairs: DataFrame) -> DataFrame:
    """anchor (its row), anchor_id, label, positive_id, positive_score: the best POSITIVES other rows of the anchor's label."""

    def find(batches):
        for block, first, anchors in sides(batches):
            out = []
            for k in range(len(anchors.rows)):
                some = np.flatnonzero((block.labels == anchors.labels[k]) & (block.rows != anchors.rows[k]))

                def keep(low, high, places):
                    least = most_at_least(low, POSITIVES)
                    return np.ones(len(low), bool) if least is None else (high >= least).astype(bool)

                some, score = scan(first[:, k], block, some, keep)
                for i in best(POSITIVES, score, block.ids[some], block.rows[some]):
                    out.append((anchors.rows[k], anchors.ids[k], anchors.labels[k], block.ids[some[i]], block.rows[some[i]], score[i]))
            yield lines(out, ("anchor", "anchor_id", "label", "positive_id", "positive", "positive_score"))

    found = pairs.mapInArrow(find, "anchor long, anchor_id long, label long, positive_id long, positive long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= POSITIVES)
    return settle(ranked, "positives")


def negatives(pairs: DataFrame) -> DataFrame:
    """anchor, positive, negative_id, negative_score, rank: the best NEGATIVES rows of other labels in each positive's window."""

    def find(batches):
        for block, first, anchors in sides(batches):
            out = []
            for k in range(len(anchors.rows)):
                windows = [w for w in anchors.windows[k] if w["low"] <= w["high"]]
                if not windows:
                    continue
                some = np.flatnonzero(block.labels != anchors.labels[k])

                def keep(low, high, places):
                    stay = np.zeros(len(low), bool)
                    for w in windows:
                        sure = (low >= w["low"]) & (high <= w["high"])
                        least = most_at_least(low[sure.astype(bool)], NEGATIVES)
                        floor = w["low"] if least is None else max(w["low"], least)
                        stay |= ((high >= floor) & (low <= w["high"])).astype(bool)
                    return stay

                some, score = scan(first[:, k], block, some, keep)
                for w in windows:
                    inside = np.flatnonzero(((score >= w["low"]) & (score <= w["high"])).astype(bool))
                    for i in inside[best(NEGATIVES, score[inside], block.ids[some[inside]], block.rows[some[inside]])]:
                        out.append((anchors.rows[k], w["positive"], block.ids[some[i]], block.rows[some[i]], score[i]))
            yield lines(out, ("anchor", "positive", "negative_id", "negative", "negative_score"))

    found = pairs.mapInArrow(find, "anchor long, positive long, negative_id long, negative long, negative_score long")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id", "negative")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES)


def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Columns, np.ndarray, Columns]]:
    """Each pair of a block and its anchors, with the anchors' components."""
    for part in batches:
        for k in range(part.num_rows):
            value = {name: part.column(name)[k] for name in part.schema.names}
            dim = value["dim"].as_py()
            block, anchors = (
                Columns(dim, *(value[name + end].values for name in ("rows", "ids", "labels")), value["cells" + end].as_py())
                for end in ("", "_a")
            )
            if anchors.cells.dtype != block.cells.dtype:
                (anchors if block.cells.dtype == object else block).widen()
            if "windows_a" in value:
                known = {w["anchor"]: w["windows"] for w in value["windows_a"].as_py() or []}
                anchors.windows = [known.get(row, []) for row in anchors.rows.tolist()]
            yield block, anchors.cells, anchors


def lines(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    limit = (1 << 63) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array([max(-limit - 1, min(limit, int(x))) for x in column], pa.int64()) for column in columns], list(names)
    )


def hard_negatives(rows: DataFrame, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for anchors whose vec_id is divisible by every.

    Rows without an id, and rows with a null label, a null vector, or a null or non-finite component take no
    part. Where vec_id is divisible by 7 the label first becomes (label + 1) % 10. Vectors of different lengths have no
    score with each other; empty ones score 0 with each other. Repeated rows, and rows that share an id, count
    each for itself. Equal scores are ranked by vec_id, then by a number of the row. A score
    beyond 64 bits counts as the nearest 64-bit number once it leaves its block. An anchor without positives, or whose windows hold nothing,
    has no rows, and so has an empty table. Other columns are neither read nor returned.
    """
    taking = usable(rows)
    held = blocks(taking, "blocks")
    heads = blocks(taking.filter(F.col("vec_id") % every == 0), "anchors")
    found = positives(met(heads, held))
    # A window's bounds in whole numbers: LOW * p <= 100 * n <= HIGH * p.
    windows = found.select(
        "anchor", "positive", F.ceil(F.col("positive_score").cast("decimal(20,0)") * LOW / 100).cast("long").alias("low"),
        F.floor(F.col("positive_score").cast("decimal(20,0)") * HIGH / 100).cast("long").alias("high"),
    ).groupBy("anchor").agg(F.collect_list(F.struct("positive", "low", "high")).alias("windows"))
    of_block = heads.select("dim", "block", F.explode("rows").alias("anchor"))
    of_block = of_block.join(windows, "anchor").groupBy("dim", "block").agg(F.collect_list(F.struct("anchor", "windows")).alias("windows"))
    heads = settle(heads.join(of_block, ["dim", "block"]), "windows")
    chosen = negatives(met(heads, held))
    return chosen.join(found.drop("rank"), ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )

