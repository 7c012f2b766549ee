"""Hard negatives against a plain search in whole numbers."""

import math

import numpy as np
import pytest

from meterline.llm import hard_negatives as module
from meterline.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row long, block int"


def expected(rows, every):
    taking = []
    for vec_id, x, label, *_ in rows:
        if None not in (vec_id, x, label) and all(c is not None and math.isfinite(c) for c in x):
            taking.append((vec_id, [math.floor(256 * c) for c in x], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for i, (a, x, label) in enumerate(taking):
        if a % every:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), b, m) for j, (b, y, m) in enumerate(taking) if j != i and len(x) == len(y)]
        for score, positive, _ in sorted(s for s in scores if s[2] == label)[:5]:
            inside = sorted(s for s in scores if s[2] != label and -30 * score <= -100 * s[0] <= -90 * score)
            out += [(a, positive, k, s[1], -score, -s[0]) for k, s in enumerate(inside[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [4096, 16])
def test_rows(spark, size, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", size)
    draw = np.random.default_rng(5)
    centers = draw.normal(size=(6, 20))
    rows = [
        (i, (centers[i % 6] + draw.normal(size=20) * 0.6).round(1).tolist(), int(draw.integers(0, 10)), 1, 2) for i in range(300)
    ]
    rows += [(300 + i, [0.5] * 20, i % 3, 0, 0) for i in range(40)]  # ties
    rows += [(400 + i, draw.normal(size=3).tolist(), i % 2, 0, 0) for i in range(30)]  # another length
    rows += [(500 + i, [float(10 ** (i % 7)), 1e6, -3.0, 0.25], i % 2, 0, 0) for i in range(14)]  # large components
    rows += [(600, [], 1, 0, 0), (601, [], 1, 0, 0), (602, [], 2, 0, 0)]
    rows += [
        (None, [0.5] * 20, 1, 0, 0), (710, None, 1, 0, 0), (720, [0.5] * 20, None, 0, 0), (730, [None] + [0.5] * 19, 1, 0, 0),
        (740, [math.nan] + [0.5] * 19, 1, 0, 0), (750, [math.inf] + [0.5] * 19, 1, 0, 0),
    ]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), every=10)
    assert sorted(map(tuple, got.collect())) == expected(rows, 10)
    assert dict(got.dtypes)["rank"] == "int"


def test_repeated_rows(spark):
    rows = [(10, [1.0, 0.5], 1, 0, 0), (10, [1.0, 0.5], 1, 0, 0), (11, [0.5, 0.5], 2, 0, 0), (11, [0.5, 0.5], 2, 0, 0)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), every=10)
    assert sorted(map(tuple, got.collect())) == expected(rows, 10)


def test_empty(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []


def test_scan_reads_fewer_rows(monkeypatch):
    """The bitmap shrinks: far rows leave before all dimensions are read."""
    draw = np.random.default_rng(1)
    cells = np.floor(256 * np.concatenate([draw.normal(size=(64, 990)) * 0.01, draw.normal(size=(64, 10)) + 3], 1))
    block = module.Columns.__new__(module.Columns)
    block.cells = cells
    block.extremes()
    left = []

    def keep(low, high, places):
        stay = high >= module.most_at_least(low, 5)
        left.append(int(stay.sum()))
        return stay

    some, score = module.scan(cells[:, 995], block, np.arange(1000), keep)
    full = cells[:, 995] @ cells
    assert set(np.argsort(-full)[:5]) <= set(some) and (score == full[some]).all()
    assert left[len(left) // 2] < 100
