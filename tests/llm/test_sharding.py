"""Shards of equal bytes against a brute-force search."""

import zlib
from collections import defaultdict

import pytest

from meterline.llm.sharding import shard_by_bytes

SCHEMA = "doc_id long, text string, shard string"


def best(sizes, n):
    """Least largest part of a cut of sizes into n runs, by dynamic programming."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    now = total[:]
    for _ in range(n - 1):
        now = [min((max(now[k], total[i] - total[k]) for k in range(i + 1)), default=0) for i in range(len(total))]
    return now[-1]


@pytest.mark.parametrize("case", ["mixed", "hot", "few", "even"])
def test_smallest_capacity(spark, case):
    import hashlib

    texts = {
        "mixed": ["x" * (i * 37 % 90) + str(i % 60) for i in range(150)],
        "hot": ["same text"] * 80 + [f"own {i}" for i in range(120)],
        "few": ["a", "b", "a"],
        "even": [f"{i:05d}" for i in range(64)],
    }[case] + [None, ""]
    rows = [(i, t, "other") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, None, "other")]
    got = shard_by_bytes(spark.createDataFrame(rows, SCHEMA), 8).collect()
    assert len(got) == len(rows)
    size, shards, slots = defaultdict(int), defaultdict(set), defaultdict(list)
    text_of = {row[0]: row[1] or "" for row in rows}
    load = defaultdict(int)
    for row in got:
        text = text_of[row.doc_id]
        assert row.size == len(text) + 1 and row.text_crc32 == zlib.crc32(text.encode()) and row.law == "bytes"
        size[hashlib.sha256(text.encode()).hexdigest()] += row.size
        shards[text].add(row.shard)
        slots[row.shard].append(row.slot)
        load[row.shard] += row.size
    assert all(len(x) == 1 for x in shards.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(load) <= set(range(8))
    assert max(load.values()) == best([size[k] for k in sorted(size)], 8)


def test_empty(spark):
    assert shard_by_bytes(spark.createDataFrame([], SCHEMA)).collect() == []
