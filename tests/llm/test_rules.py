"""Counts and distances against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import rules
from meterline.llm.common import text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    triples = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é#|\n\t\x1c\r"), max_size=60), max_size=6))
def test_counts(texts):
    data, ends = text_bytes(pa.array(texts, pa.string()))
    got = rules.counts(data, ends)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert list(zip(*(got[k].tolist() for k in names))) == [plain(x) for x in texts]


def test_distance():
    p, q = np.array([[3.0, 1.0, 0.0], [0, 0, 0]]), np.array([1.0, 1.0, 2.0])
    a, b = p[0] / 4, q / 4
    m = (a + b) / 2
    want = sum(x * math.log2(x / y) for x, y in zip(a, m) if x) / 2 + sum(x * math.log2(x / y) for x, y in zip(b, m) if x) / 2
    got = rules.distance(p, q)
    assert abs(got[0] - math.sqrt(want)) < 1e-12 and got[1] == 0


def test_rows(spark):
    draw = random.Random(3)
    good = " ".join(draw.choice("the of and to in is that it river stone house walking green".split()) for _ in range(150)) + " "
    junk = " ".join(f"### {i}$$$ %%% {i}&&& |||{i}" for i in range(60))
    rows = [(i, good + str(i), "en", "k") for i in range(20)] + [(30, junk, "en", "k"), (31, None, None, "k"), (32, "", "en", "k"), (33, "a b\n" * 200, None, "k"), (None, good, None, "k"), (0, good + "0", "en", "k")]
    schema = "doc_id long, text string, lang string, kept string"
    docs = spark.createDataFrame(rows, schema)
    got = rules.quality_rules(docs).collect()
    assert len(got) == len(rows)
    kept = sorted(str(r.doc_id) for r in got if r.kept)
    assert kept == sorted([*map(str, range(20)), "0", "None"])
    assert {r.doc_id: r.base_failed for r in got if r.doc_id in (30, 31, 32, 33)} == {30: False, 31: True, 32: True, 33: True}
    for r in got:
        text = {x[0]: x[1] or "" for x in rows}[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text)
    assert rules.quality_rules(docs.limit(0)).collect() == []
    assert all(r.nearest is None for r in rules.quality_rules(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("doc_id = 31")).collect())
