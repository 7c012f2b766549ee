"""Exact groups against grouping in Python, with keys of all lengths, so that chains collide."""

import hashlib
from collections import defaultdict

import pytest

from meterline.llm.exact_dedup import directory, exact_duplicates

SCHEMA = "doc_id long, text string, row string, key string, norm string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("bits, capacity", [(64, 1 << 16), (64, 4), (6, 4), (2, 1), (1, 1000)])
def test_groups(spark, bits, capacity):
    texts = ["Same Text"] * 70 + ["same text", "SAME TEXT", "", None, "É", "é", "K", "k", "x" * 200_000, "X" * 200_000]
    texts += [f"Own {i % 90}" for i in range(150)]
    rows = [(i * 7 % 1000, t, "a", "b", "c") for i, t in enumerate(texts)]
    rows += [rows[0], rows[75], (None, "Same Text", "", "", ""), (None, "no id", "", "", ""), (None, "No id", "", "", "")]
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lowered(text)].append(doc_id)
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA), capacity, bits).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    known = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for row in got:
        ids = known[row.text_sha256]
        most = max((x for x in ids if x is not None), default=None)
        assert row.doc_id in ids and (row.keep_id, row.group_size) == (most, len(ids))
        assert not row.kept or row.doc_id == most
        kept[row.text_sha256] += row.kept
    assert dict(kept) == {digest: 1 for digest in known}


def test_directory_doubles_only_where_it_must(spark):
    # Half of the keys share their first 20 bits.
    keys = spark.range(4000).selectExpr("case when id % 2 = 0 then id else shiftleft(cast(id % 2000 as long), 53) + id end as key")
    cells = directory(keys, capacity=50)
    buckets = keys.sparkSession.createDataFrame(keys.collect(), "key long")
    depth = {row.bucket: row.depth for row in cells.collect()}
    filled = defaultdict(set)
    for row in buckets.collect():
        own = [b for b, d in depth.items() if (row.key >> (64 - d)) == (b >> (64 - d))]
        assert len(own) == 1
        filled[own[0]].add(row.key)
    assert max(len(x) for x in filled.values()) <= 50 and max(depth.values()) > 40 > min(depth.values())


def test_empty(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
