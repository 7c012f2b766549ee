"""Shards of whole groups with near-equal bytes: the minimax cut of an ordered sequence of group sizes.

Rows with equal texts form a group and stay together. Groups are ordered by a digest of their text, sizes are
summed once per group, and the smallest capacity for which a greedy walk over that order needs at most
n_shards shards is found by search; the shards are cut where that walk cuts. A row learns its shard by comparing
its digest with the n_shards - 1 cut digests, so no group is ever gathered or joined.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settle

#: Hex digits of the digest that name the first stretches of the order, and those by which a stretch is split.
FIRST_DIGITS, MORE_DIGITS = 3, 2
#: Parts of a shard that number their rows on their own.
SLOT_PARTS = 1024


def shard_by_bytes(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ("bytes"), shard, slot, grown_shard (null) of every row of docs.

    A null text weighs 1 like an empty one and shares its group. Repeated rows each get a slot of their own. Null
    ids are rows like others. An empty table gives no rows. With fewer groups than shards, some shards stay
    empty. Other columns of docs are neither read nor returned.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"),
    )
    cuts = minimax_cuts(rows.groupBy("digest").agg(F.sum("size").alias("size")), n_shards)
    shard = sum((F.col("digest") > F.lit(cut)).cast("int") for cut in cuts) if cuts else F.lit(0)
    rows = rows.select(
        "doc_id", "size", "text_crc32", shard.alias("shard"),
        F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOT_PARTS)).cast("int").alias("part"),
    )
    return numbered(rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """rows with slot, gapless from 0 in each shard; each part of a shard numbers its rows after those before it."""
    sums = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    own = rows.withColumn("place", F.row_number().over(place) - 1)
    # Shards x parts rows: a bound that holds for any input.
    return own.join(F.broadcast(starts), ["shard", "part"]).withColumn("slot", F.col("first") + F.col("place"))


def minimax_cuts(groups: DataFrame, n_shards: int) -> list[str]:
    """The digests after which to cut so that the largest of n_shards stretches of the order is as small as can be.

    groups has one row per digest with its size. The driver holds sums of stretches of the order, named by the first
    digits of their digests. The capacity is bounded from above by the walk that cuts at known ends of stretches
    only, and from below by the walk that may cut anywhere inside a stretch of several groups; stretches that a cut
    can lie in are then split by further digits until both bounds meet. Each step is one aggregation, and brings a
    few hundred stretches times 16**MORE_DIGITS sums to the driver, whatever the size of the input.
    """
    line = settle(groups, "groups")
    known = _sums(line, FIRST_DIGITS, None)
    digits = FIRST_DIGITS
    if n_shards < 2 or not known:
        return []
    while True:
        ends = [0, *accumulate(size for _, size, _, _ in known)]
        inner = [n > 1 for _, _, n, _ in known]
        low = _least(n_shards, ends, inner, loose=True)
        high = _least(n_shards, ends, inner, loose=False)
        from_, to = _walk(low, n_shards, ends, inner, False), _walk(high, n_shards, ends, inner, True)
        split = {
            known[k][0]
            for a, b in zip([0, *from_], [0, *to])
            for k in range(bisect_right(ends, a + low) - 1, min(bisect_right(ends, b + high), len(known)))
            if k < len(known) and inner[k]
        }
        if low == high or not split:
            return [known[bisect_right(ends, at) - 2][3] for at in _walk(high, n_shards, ends, inner, False)]
        finer = _sums(line, digits + MORE_DIGITS, (digits, sorted(split)))
        known = sorted([*(x for x in known if x[0] not in split), *finer])
        digits += MORE_DIGITS


def _sums(line: DataFrame, digits: int, within: tuple[int, list[str]] | None) -> list[tuple[str, int, int, str]]:
    """Name, size, groups and last digest of each stretch named by so many digits, in order."""
    if within:
        line = line.filter(F.substring("digest", 1, within[0]).isin(within[1]))
    found = line.groupBy(F.substring("digest", 1, digits).alias("stretch")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.max("digest").alias("last")
    )
    return sorted((row["stretch"], row["size"], row["n"], row["last"]) for row in found.collect())


def _walk(capacity: int, n_shards: int, ends: list[int], inner: list[bool], loose: bool) -> list[int]:
    """Where the greedy walk cuts; loose: it may cut anywhere inside a stretch of several groups."""
    cuts, at = [], 0
    for _ in range(n_shards - 1):
        target = at + capacity
        if target >= ends[-1]:
            break
        k = bisect_right(ends, target) - 1
        at = target if loose and inner[k] else ends[k]
        cuts.append(at)
    return cuts


def _least(n_shards: int, ends: list[int], inner: list[bool], loose: bool) -> int:
    """The least capacity for which the walk ends within n_shards shards."""
    low, high = 1, ends[-1]
    while low < high:
        mid = (low + high) // 2
        cuts = _walk(mid, n_shards, ends, inner, loose)
        if (cuts[-1] if cuts else 0) + mid >= ends[-1]:
            high = mid
        else:
            low = mid + 1
    return low
