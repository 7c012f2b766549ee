"""The stages one after another, each against what it should keep."""

import random

import pytest

import corpus_pipeline
from meterline.llm.pii import find, masked

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw, path = random.Random(4), tmp_path_factory.mktemp("corpus")
    words = [a + b for a in ("the", "and", "water", "house", "some", "river") for b in ("", "s", "ing", "ed", "ly")]
    rows = []
    for i in range(160):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(30, 90)))
        if i % 8 == 7:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text))
    rows += [(200 + i, rows[i][1]) for i in range(0, 40)]  # copies
    rows += [(300 + i, rows[i][1] + " more") for i in range(0, 6)]  # near copies
    rows += [(400, "1234 5678"), (401, None), (402, ""), (403, rows[1][1] + " mail me@x.org or 10.1.2.3"), (5, rows[5][1])]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 8 != 7), 0) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), dict(rows)


def test_stages(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    (_, quality), (_, language), (_, near), (_, pii), (_, pack) = corpus_pipeline.STAGES
    good = quality(spark, docs, path)
    assert good.columns == docs.columns
    got = {r.doc_id for r in good.collect()}
    assert not any(i % 8 == 7 for i in got if i < 160) and got >= {i for i in range(160) if i % 8 != 7}
    known = language(spark, good, path)
    ids = {r.doc_id for r in known.collect()}
    assert not ids & {400, 401, 402} and ids >= {i for i in got if i < 400}
    once = near(spark, known, path)
    kept = sorted(r.doc_id for r in once.collect())
    assert len(kept) == len(set(kept)) and set(kept) >= {i for i in ids if i < 160} and not set(kept) & set(range(200, 240))
    clean = pii(spark, once, path)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r.text == masked(texts[r.doc_id], find(texts[r.doc_id])) and r.n_chars == len(r.text)
    pieces = pack(spark, clean, path).collect()
    assert {r.doc_id for r in pieces} == set(kept) and sum(r.length for r in pieces if r.start == 0) > 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).collect()} == set(kept)


def test_empty(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


def test_rows_of_one_id_and_clashing_names(spark, folder):
    """Unlike texts of one id stay, repeats and near copies go, working names of the stages clash with nothing."""
    path, texts = folder
    names = ["score", "told", "sure", "row", "_text", "_row", "group", "id", "component_id"]
    a, b, c = (texts[i] for i in (0, 1, 2))
    rows = [(9, a), (9, b), (9, b), (3, b + " more"), (None, c), (None, c), (None, None), (None, None), (5, None), (5, ""), (6, "")]
    more = [(i, t, "en", "s", 0, *(f"v{k}" for k in range(len(names)))) for i, t in rows]
    docs = spark.createDataFrame(more, COLUMNS + "".join(f", {name} string" for name in names))
    got = corpus_pipeline.one_of_each(spark, docs, path)
    assert got.columns == docs.columns and {tuple(r[5:]) for r in got.collect()} == {tuple(f"v{k}" for k in range(len(names)))}
    kept = sorted(((r.doc_id, r.text or "") for r in got.collect()), key=repr)
    assert kept == sorted([(9, a), (3, b + " more"), (None, c), (None, ""), (None, ""), (5, ""), (6, "")], key=repr)
    for name, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[3:4]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        assert all(tuple(r[5:]) == tuple(f"v{k}" for k in range(len(names))) for r in out.collect())
    assert {r.doc_id for r in corpus_pipeline.known_language(spark, docs, path).collect()} == {9, 3, None}
    assert corpus_pipeline.packed(spark, docs, path).filter("start = 0").count() == len(rows)
