"""Language, quality and toxicity models against brute force and on held-out rows."""

import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import language, letters, quality, toxicity
from meterline.llm.letters import joined, letter_words, lowered


def pieces_of(*names):
    return np.array(sorted(int.from_bytes(x.replace("_", "\x01").encode(), "big") for x in names), np.uint64)


NAMES = ["_", "_a", "a", "b", "ab", "_ab", "bca", "c"]
PIECES = pieces_of(*NAMES)


def segmentations(text):
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        bounds = [0, *[k + 1 for k, cut in enumerate(cuts) if cut], len(text)]
        yield [text[a:b] for a, b in zip(bounds, bounds[1:])]


def chances():
    by_code = {int.from_bytes(x.replace("_", "\x01").encode(), "big"): k + 1 for k, x in enumerate(NAMES)}
    prob = {x.replace("_", "\x01"): (k + 1) / 40 for k, x in enumerate(NAMES)}
    return np.array([by_code[int(x)] / 40 for x in PIECES] + [0])[:, None], prob


def marked(word):
    return np.frombuffer(("\x01" + word).encode(), np.uint8)[None, :]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=7))
def test_sum_over_segmentations(word):
    chance, prob = chances()
    each = lambda x: prob.get(x, language.FLOOR if len(x) == 1 else 0)
    want = sum(math.prod(map(each, parts)) for parts in segmentations("\x01" + word))
    lattice = language.Lattice(PIECES)
    *_, last = language.forward(lattice.edges(marked(word)), language.logs_of(chance), lattice.longest)
    assert math.isclose(last[0, 0], math.log(want), rel_tol=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abcd", min_size=1, max_size=5), st.integers(1, 4)), min_size=1, max_size=4))
def test_expected_uses(words):
    """Learning counts each piece by its share of all segmentations."""
    chance, prob = chances()
    lattice, want, got = language.Lattice(PIECES), {}, np.zeros(len(PIECES) + 1)
    for word, n in words:
        each = lambda x: prob.get(x, language.FLOOR if len(x) == 1 else 0)
        every = [(parts, math.prod(map(each, parts))) for parts in segmentations("\x01" + word)]
        total = sum(p for _, p in every)
        for parts, p in every:
            for x in parts:
                want[x] = want.get(x, 0) + n * p / total
        got += language.expected(list(lattice.edges(marked(word))), chance, np.array([float(n)]))
    names = {int(code): k for k, code in enumerate(PIECES)}
    for x in NAMES:
        x = x.replace("_", "\x01")
        assert math.isclose(got[names[int.from_bytes(x.encode(), "big")]], want.get(x, 0), rel_tol=1e-9, abs_tol=1e-12)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=40), min_size=1, max_size=4), st.integers(1, 12))
def test_cuts_change_no_sum(words, short):
    """Runs cut where no piece lies across have the same likelihood as whole ones, whatever their length."""
    chance, _ = chances()
    lattice, data = language.Lattice(PIECES), joined([" ".join(words).encode()])
    before = language.SHORT
    try:
        language.SHORT = 10**9
        want, n = language.likelihoods(*data, lattice, chance)
        language.SHORT = short
        got, m = language.likelihoods(*data, lattice, chance)
    finally:
        language.SHORT = before
    assert n.tolist() == m.tolist() == [len(words)] and np.allclose(want, got, rtol=1e-12)


@pytest.fixture(scope="module")
def real():
    pieces = language.vocabulary()
    units = [(name, b"\x01" + w.encode(), 3) for name, words in WORDS.items() for w in words.split()]
    return language.Lattice(pieces), *language.learn(units + [("xx", "\x01🦊🦊".encode() * 30, 5)], pieces)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80), st.integers(1, 60))
def test_any_text_has_finite_likelihoods(real, text, times):
    lattice, names, chance = real
    assert names == ["de", "en", "fr", "xx"] and np.isfinite(chance).all()
    totals, _ = language.likelihoods(*joined([(text * times).encode("utf-8", "ignore"), b"haus wasser"]), lattice, chance)
    assert np.isfinite(totals).all() and totals[1].argmax() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aZÉ é1-", max_size=12), max_size=5))
def test_letter_words(texts):
    data, ends = joined([x.encode() for x in texts])
    data = lowered(data)
    start, end, first = letter_words(data, ends)
    got = [[bytes(data[s:e]).decode() for s, e in zip(start[a:b], end[a:b])] for a, b in zip(first, first[1:])]
    assert got == ["".join(c if c.isalpha() else " " for c in x.lower()).split() for x in texts]


def test_shared_backoff_against_plain_counts():
    draw = random.Random(1)
    texts = [(0, y, " ".join(draw.choice(["abc", "abd", "bcd", "xy", "xyz"][: 3 + 2 * y]) for _ in range(20)).encode()) for y in (0, 1) for _ in range(4)]
    keys, counts = toxicity.counted(texts)
    plain = {0: {}, 1: {}}
    for _, y, text in texts:
        for word in text.split():
            marked = b"\x01" + word + b"\x02"
            for k in range(1, len(marked)):
                gram = marked[max(0, k - toxicity.HISTORY) : k + 1]
                plain[y][gram] = plain[y].get(gram, 0) + 1
    grams = sorted(set(plain[0]) | set(plain[1]))
    assert len(keys) == len(grams)
    chance, types = {}, {k: set() for k in range(1, toxicity.HISTORY + 2)}
    for gram in grams:
        types[len(gram)].add(gram)
    def shared(gram):  # probability of the last byte of gram, by continuation counts
        if not gram:
            return 1 / 256
        ends = [g for g in longer[len(gram)] if g[1:][:-1] == gram[:-1]]
        n = {}
        for g in ends:
            n[g[-1]] = n.get(g[-1], 0) + 1
        total = sum(n.values())
        return max(n.get(gram[-1], 0) - 0.75, 0) / total + 0.75 * len(n) / total * shared(gram[1:])
    longer = {}
    level = set()
    for k in range(toxicity.HISTORY, 0, -1):
        level = {g[1:] for g in level if len(g) == k + 2} | {g for g in level if len(g) == k + 1} | types[k + 1]
        longer[k] = level = {g for g in level if len(g) == k + 1} | types[k + 1]
        level = level | {g[1:] for g in level}
    got = dict(zip([int(x) for x in keys], toxicity.shared_chances(keys)))
    for gram in grams:
        assert math.isclose(got[int.from_bytes(gram, "big")], shared(gram[1:]), rel_tol=1e-9), gram
    for gram in grams:
        logs = []
        for y in (0, 1):
            total = sum(n for g, n in plain[y].items() if g[:-1] == gram[:-1])
            kinds = sum(g[:-1] == gram[:-1] for g in plain[y])
            n = plain[y].get(gram, 0)
            logs.append(math.log((max(n - 0.75, 0) + 0.75 * kinds * shared(gram[1:])) / total if total else shared(gram[1:])))
        code = np.array([int.from_bytes(gram, "big")], np.uint64)
        assert abs(toxicity.Contrast(keys, counts).find(code)[0][0] - (logs[1] - logs[0])) < 1e-5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=1200), min_size=1, max_size=5))
def test_pooling_covers_the_text(texts):
    net = quality.Network()
    data, ends = joined(texts)
    pooled, first = net.pooled(data, ends)
    for text, a, b in zip(texts, first, first[1:]):
        padded = np.frombuffer(text + bytes(quality.FILTER), np.uint8)
        every = np.maximum(net.responses(padded)[: max(len(text), 1)] + net.b, 0)
        span = quality.CELL * quality.CELLS
        starts = range(0, max(1, len(every)), quality.CELL * quality.STEP)
        want = [every[s : s + span].max(0) for k, s in enumerate(starts) if k == 0 or starts[k - 1] + span < len(every)]
        assert b - a == len(want) and np.allclose(pooled[a:b], want, atol=1e-4)


WORDS = {"en": "the and of with have from house water they some", "de": "der und mit haben von haus wasser nicht eine sie", "fr": "le et avec avoir maison eau les dans une pour"}
SCHEMA = "doc_id long, text string, lang string, score string, held_out string"


def documents(n=400):
    draw, rows = random.Random(2), []
    for i in range(n):
        lang = draw.choice(list(WORDS))
        words = [draw.choice(WORDS[lang].split()) for _ in range(draw.randint(20, 120))]
        toxic, bad = i % 5 == 0, i % 4 == 1
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["grumbler", "grumblest", "nasty"])
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        rows.append((i, text, lang, "x", "y", int(not bad), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = documents()
    odd = [(1000, None, None, "x", "y"), (1001, "", "en", "x", "y"), (1002, "1234 !!", "en", "x", "y"), (None, rows[0][1], "en", "x", "y"), (3, rows[3][1], rows[3][2], "x", "y"), (1003, "wort " * 40000, None, "x", "y")]
    docs = spark.createDataFrame([r[:5] for r in rows] + odd, SCHEMA).cache()
    labels = spark.createDataFrame([(r[0], r[5], r[6]) for r in rows] + [(1002, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_language_rows(tables):
    rows, docs, _ = tables
    got = language.identify(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    pred = {r.doc_id: r.lang_pred for r in got}
    assert all(pred[i] == "und" for i in (1000, 1001, 1002)) and pred[1003] == "de"
    held = {r.doc_id for r in got if r.held_out}
    assert held and all(pred[r[0]] == r[2] for r in rows)
    assert language.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(docs.filter("lang is null")).collect()} == {"und"}


@pytest.mark.parametrize("score, column", [(quality.score_quality, 5), (toxicity.score_toxicity, 6)])
def test_scores_of_held_out_rows(tables, score, column):
    rows, docs, labels = tables
    got = score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = {r.doc_id: r.predicted for r in got if r.held_out}
    right = [held[r[0]] == r[column] for r in rows if r[0] in held]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right)
    assert score(docs.limit(0), labels).collect() == []
    assert len(set(r.score for r in score(docs, labels.limit(0)).collect())) == 1


def test_toxicity_counts_every_labelled_text_whole(spark):
    """A word that only lies beyond the first and last parts of long texts, or outside any sample, counts."""
    draw = random.Random(6)
    plain = lambda n: " ".join(draw.choice(WORDS["en"].split()) for _ in range(n))
    rows = [(i, plain(30) + (" zzqx" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(300)]
    rows += [(1000 + i, plain(9000) + " vrakk " + plain(9000), 1) for i in range(12)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    contrast, _ = toxicity.learn(docs, labels, sample=30)
    seen = [r.doc_id for r in docs.filter(toxicity.remainder("doc_id", 4) != 2).select("doc_id").collect()]
    keys, counts = toxicity.counted([(0, y, text.encode()) for i, text, y in rows if i in seen])
    want = toxicity.Contrast(keys, counts)
    assert (contrast.keys == want.keys).all() and np.allclose(contrast.gains, want.gains)
    word = np.frombuffer(b"vrakk", np.uint8)[None, :]
    assert contrast.of_words(word)[0] > 0


def test_vocabulary_has_pieces_of_all_lengths():
    """Pieces of more than eight bytes are found in words, each at its own number."""
    pieces = language.vocabulary()
    lattice = language.Lattice(pieces)
    word = "information"
    row = list(lattice.edges(marked(word)))[-1]
    found = {k: int(x[0]) for k, x in enumerate(row, 1) if x[0] < len(pieces)}
    whole = b"\x01" + word.encode()
    assert len(whole) in found and all(int(pieces[n]) == language.code_of(whole[-k:]) for k, n in found.items())
    assert pieces.longest > language.PLAIN and len(set(pieces.tolist())) == len(pieces)


def test_one_odd_text_leaves_a_table_alone(spark):
    """Long runs of characters that are no piece, in a learned text and in a scored one."""
    rows = documents(60) + [(500 + i, "das haus " + x * 46, "de", "x", "y", 1, 0) for i, x in enumerate("🦊ꀀ຀ᚠ╬")]
    rows += [(600 + i, "🦊" * 3000, None, "x", "y", 1, 0) for i in range(2)]
    got = language.identify(spark.createDataFrame([r[:5] for r in rows], SCHEMA)).collect()
    assert all(0 <= r.score <= 1 for r in got)
    pred = {r.doc_id: r.lang_pred for r in got}
    assert all(pred[r[0]] == r[2] for r in rows if r[0] < 500) and pred[600] == "und"


def test_learns_from_whole_texts(spark):
    """What lies beyond the first 16 KiB of a labelled text is learned."""
    rows = [(i, "the and " * 4000 + "krzyz", "en") for i in range(8)] + [(20 + i, "der und " * 4000 + "strasz", "de") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    found = {(label, unit) for label, unit, _ in language.learned_units(language.some_of_each(docs, "label", 100), language.vocabulary())}
    assert ("en", b"\x01krzyz") in found and ("de", b"\x01strasz") in found


def test_sample_of_many_labels_and_repeated_ids(spark):
    """Each of more labels than the sample has documents gives one; an id gives one text, however often it is repeated."""
    rows = [(i, f"word{i}", f"l{i % 50}") for i in range(200)] + [(7, "again", "l7")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    taken = letters.learned_from(letters.some_of_each(docs, "label", 10))
    assert {label for _, label, _ in taken} == {f"l{k}" for k in range(50)}
    every = letters.learned_from(letters.some_of_each(docs, "label", 10**6))
    assert len(every) == 200
