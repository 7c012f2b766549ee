"""Encoding by the tree and packing against the tokenizers library over whole texts."""

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterline.llm.bpe import Codec, encode_decode
from meterline.llm.packing import END_ID, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
CODEC, LIBRARY = Codec(PATH), Tokenizer.from_file(PATH)
TEXTS = [None, "", " ", "\n", "a", "the cat's  hat \n\n x", "<|endoftext|> a<|endoftext|>b", "é" * 999, "あ\U0001f600" * 400,
         "abracadabra" * 2000, " " * 5000, "1" * 3000 + "a" * 3000, "wörd " * 3000, "don't we'll " * 700, "�\x00\x1f"]
SCHEMA = "doc_id long, text string, ids string, row string"


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdeth 's\näßあ\U0001f6001.!<|>"), max_size=200), st.integers(1, 40))
def test_tree_is_exact(text, leaf):
    assert CODEC.whole(text, leaf).tolist() == library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcdefghilnorst"), min_size=50, max_size=900), st.integers(20, 200))
def test_tree_is_exact_without_any_split(text, leaf):
    assert CODEC.whole(text, leaf).tolist() == library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.integers(1, 20))
def test_any_text(text, leaf):
    assert CODEC.whole(text, leaf).tolist() == library(text)


@pytest.mark.parametrize("leaf", [64, 32768])
def test_rows(spark, leaf):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(3, TEXTS[5], "x", "y"), (None, "b" * 100, "x", "y")]
    got = encode_decode(spark.createDataFrame(rows, SCHEMA), leaf=leaf).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array(library(text), "<u4").tobytes()
        want.append((doc_id, hashlib.sha256(ids).hexdigest(), LIBRARY.decode(library(text), skip_special_tokens=False)))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.decoded)) for r in got)


def test_packing(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(100 + i, "word " * (i * 13 % 200), "x", "y") for i in range(300)]
    got = pack(spark.createDataFrame(rows, SCHEMA).repartition(3), length=128, open_windows=4).collect()
    pieces, windows = defaultdict(dict), defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids) and 0 < r.length <= 128
        pieces[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
        windows[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, *_ in rows:
        joined = [x for start in sorted(pieces[doc_id]) for x in pieces[doc_id][start]]
        assert joined == [*library(text), END_ID]
        assert {r.doc_tokens for r in got if r.doc_id == doc_id} == {len(joined)}
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(windows) <= 1.05 * sum(r.length for r in got) / 128 + 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert encode_decode(none).collect() == [] and pack(none).collect() == []
