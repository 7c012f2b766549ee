"""Near-duplicate texts and vectors against comparing all pairs."""

import importlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import near_text, near_vectors
from meterline.llm.common import BATCH_LIMIT, batches_of
from meterline.llm.components import components


def grouped(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_set(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("shape", ["path", "star", "mixed"])
def test_components(spark, shape):
    draw = random.Random(1)
    links = {
        "path": [(i, i + 1) for i in range(60)], "star": [(7, i) for i in range(50)],
        "mixed": [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(3, 3)],
    }[shape]
    want = grouped({x for link in links if link[0] != link[1] for x in link}, links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == want and len(got) == len(want)


def test_a_star_is_one_round(spark, monkeypatch):
    module, names = importlib.import_module("meterline.llm.components"), []
    settle = module.settle
    monkeypatch.setattr(module, "settle", lambda df, name: names.append(name) or settle(df, name))
    got = module.components(spark.range(1, 2001).selectExpr("1000 - id as a", "1000L as b"))
    assert got.filter("component <> -1000").isEmpty() and got.count() == 2001
    assert names.count("joins") == 1


def test_small_batches(spark, monkeypatch):
    seen, settle, before = set(), near_text.settle, spark.conf.get(BATCH_LIMIT)
    monkeypatch.setattr(near_text, "settle", lambda df, name: seen.add(spark.conf.get(BATCH_LIMIT)) or settle(df, name))
    rows = [(i, f"a b c d e {i // 2}") for i in range(4)]
    got = near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.component_id for r in got.orderBy("doc_id").collect()] == [0, 0, 2, 2]
    assert seen == {near_text.BATCH} and spark.conf.get(BATCH_LIMIT) == before

    def sizes(batches):
        for batch in batches:
            yield batch.select(["n"]).set_column(0, "n", pa.array([batch.nbytes] * len(batch), pa.int64()))

    wide = spark.range(0, 200, 1, 1).select(F.col("id").alias("n"), F.repeat(F.lit("x"), 100_000).alias("text"))
    with batches_of(spark, "1MB"):
        assert wide.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 1_500_000


def test_texts(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(30):
        base = [draw.choice(words) for _ in range(draw.randint(3, 90))]
        texts.append(base)
        for _ in range(draw.randint(0, 3)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(copy)
    texts += [passage + [draw.choice(words) for _ in range(draw.randint(5, 40))] for _ in range(60)]
    family = [draw.choice(words) for _ in range(200)]
    for _ in range(80):
        copy = list(family)
        copy[draw.randrange(200)] = draw.choice(words)
        texts.append(copy)
    rows = [(i, " ".join(t).upper() if i % 9 == 0 else "\t".join(t), "x", i) for i, t in enumerate(texts)]
    rows += [(900, None, "x", 0), (901, "", "x", 0), (902, " \n", "x", 0), (903, "only three words", "x", 0), (904, "Only three words", "x", 0), (0, rows[0][1], "x", 0), (905, "é a b c d " * 9000, "x", 0)]
    docs = spark.createDataFrame(rows + [(None, rows[0][1], "x", 0)], "doc_id long, text string, kept string, id long")
    sets = {i: shingle_set(t) for i, t, *_ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = grouped(sets, links)
    got = near_text.near_duplicates(docs).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_text.near_duplicates(docs.limit(0)).collect() == []


def test_crowded_nodes_branch(spark, monkeypatch):
    """Texts that share a long passage but are not similar enough fill the same nodes; links among them are found."""
    monkeypatch.setattr(near_text, "SMALL", 1)
    draw = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    own = [" ".join(f"q{draw.randrange(10**6)}" for _ in range(45)) for _ in range(80)]
    rows = [(i, f"{passage} {own[i % 40 if i >= 70 else i]} z{i % 3}") for i in range(80)]
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    got = near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert links and {r.doc_id: r.component_id for r in got} == grouped(sets, links)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors(spark, kind):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + draw.normal(scale=0.1, size=(20, 16)), base[5] + draw.normal(scale=0.08, size=(150, 16)), 3 * base[:5], base[:5]])
    x = x.astype(np.float32 if kind == "float" else np.float64)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    nan = float("nan")
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [nan] + [1.0] * 15, 0), (904, [None] + [1.0] * 15, 0), (905, [1.0, 2.0], 0), (0, x[0].tolist(), 1)]
    docs = spark.createDataFrame(rows + odd + [(None, x[0].tolist(), 0)], f"vec_id long, embedding array<{kind}>, component_id int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    s = unit @ unit.T
    np.fill_diagonal(s, 0)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(s >= 0.95)) if a < b]
    want, n = grouped([*range(len(x)), *range(900, 906)], links), (s >= 0.95).sum(1)
    got = near_vectors.near_vectors(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id] if r.vec_id < 900 else 0, want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert near_vectors.near_vectors(docs.limit(0)).collect() == []


def test_isolated_pair_beside_a_large_family(spark):
    """Pairs at the threshold are found although the family has nearly all links, and all of the family's are counted."""
    draw, dim, n = np.random.default_rng(8), 64, 3000
    base = draw.normal(size=(2400, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    other = draw.normal(size=(1200, dim))
    own = base[:1200]
    other -= (other * own).sum(1)[:, None] * own
    other /= np.linalg.norm(other, axis=1)[:, None]
    pairs = 0.951 * own + np.sqrt(1 - 0.951**2) * other
    x = np.concatenate([base, pairs, base[2000] + draw.normal(scale=0.01, size=(n, dim))])
    s = (unit := x / np.linalg.norm(x, axis=1)[:, None]) @ unit.T
    np.fill_diagonal(s, 0)
    want = (s >= 0.95).sum(1)
    assert want[:1200].min() == 1 and want[-1] >= n - 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_vectors.near_vectors(rows).collect()}
    assert [got[i].n_links for i in range(len(x))] == want.tolist()
    assert all(got[2400 + i].component_id == i for i in range(1200))


def test_blocks_out_of_reach_are_left_out(spark):
    """Directions far apart fall into blocks of which only few meet; no link is lost by that."""
    draw = np.random.default_rng(2)
    base = np.repeat(np.eye(8), 60, 0) + draw.normal(scale=0.05, size=(480, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    points = near_vectors.stored(docs).select(F.col("vec_id").alias("id"), F.lit(1).cast("long").alias("m"), "dim", "vec", F.lit(True).alias("open"))
    held = near_vectors.blocks(points)
    n = held.count()
    assert near_vectors.pairs(held).count() < n * (n + 1) // 2
    s = (unit := base / np.linalg.norm(base, axis=1)[:, None]) @ unit.T
    np.fill_diagonal(s, 0)
    want = (s >= 0.95).sum(1)
    assert {r.vec_id: r.n_links for r in near_vectors.near_vectors(docs).collect()} == dict(enumerate(want.tolist()))


@pytest.mark.parametrize("kept", [False, True])
def test_audits_that_fail_open_all_rows(spark, monkeypatch, kept):
    """A search that starts from two orders misses threshold pairs; the audits see it, and all links come out all the same."""
    draw, dim = np.random.default_rng(4), 32
    base = draw.normal(size=(900, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    away = draw.normal(size=(900, dim))
    away -= (away * base).sum(1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    x = np.concatenate([base, 0.9505 * base + np.sqrt(1 - 0.9505**2) * away, base[0] + draw.normal(scale=0.005, size=(100, dim))])
    s = (unit := x / np.linalg.norm(x, axis=1)[:, None]) @ unit.T
    np.fill_diagonal(s, 0)
    want = (s >= 0.95).sum(1)
    for name, value in [("ORDERS", 1), ("GROUP", 8), ("ROUNDS", 1), ("SEARCHES", 40 if kept else 1)]:
        monkeypatch.setattr(near_vectors, name, value)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(rows).collect()}
    right = np.mean([got[i] == n for i, n in enumerate(want.tolist())])
    assert right >= 0.99 if kept else right == 1


def test_rows_with_many_links_are_open(spark):
    """A family wider than the lists is handed to the exact pass, a pair is not; the lists hold both links of a pair."""
    draw = np.random.default_rng(6)
    base = draw.normal(size=(300, 48))
    x = np.concatenate([base, base[:100] + draw.normal(scale=0.05, size=(100, 48)), base[200] + draw.normal(scale=0.05, size=(150, 48))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    points = near_vectors.stored(rows).select(F.col("vec_id").alias("id"), F.lit(1).cast("long").alias("m"), "dim", "vec")
    graph, fine = near_vectors.descended(points)
    got = graph.filter("s >= 0.95 and u >= 0 and v >= 0").select("u", "v", "open").collect()
    assert fine and {r.u for r in got if r.open} == {200, *range(400, 550)}
    assert {(r.u, r.v) for r in got if not r.open} == {(i, 300 + i) for i in range(100)} | {(300 + i, i) for i in range(100)}


def test_different_vectors_of_one_id(spark):
    """Each vector of an id has its own links and component, the smallest id in it."""
    a, near_a, b, near_b = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 0.0, 1.0], [0.0, 0.1, 1.0]
    rows = [(5, a), (5, b), (7, near_a), (8, near_b), (3, near_b), (9, [0.0, 1.0, 0.0])]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = [(5, 1, 5, True), (5, 2, 3, False), (7, 1, 5, False), (8, 2, 3, False), (3, 2, 3, True), (9, 0, 9, True)]
    assert sorted(map(tuple, got)) == sorted(want)
