"""Quality rules: counts over words and lines, and the distance of a document's make-up from its language's.

A document is described by two histograms: the classes of its characters and its common words. The same
histograms summed over all documents of a language are that language's reference. A document is kept if for some
language both Jensen-Shannon distances (square root of the divergence to base 2) stay under their limits, and the base
rules hold.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, by_segment, mapped, mix, rolling, text_bytes, text_rows, word_bounds

# Symbols, and common words of the languages.
SYMBOLS = b"#*$%&|<>"
COMMON = (
    "the of and to in is that it for on was with as by be this are from at or an a not have "
    "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "le la les de des et un une du en que qui dans pour par sur pas au plus il elle est ce ne se "
    "el los las del que y por con para una su al lo como más pero sus se es no"
).split()
#: Least words for the base rules.
MIN_WORDS = 50
#: Characters in words, and words, below which the one and the other distance say nothing.
CHAR_GUARD, WORD_GUARD = 200, 100
#: Largest distances from the nearest language.
CHAR_LIMIT, WORD_LIMIT = 0.27, 0.33
CLASSES = ["lower", "upper", "digit", "space", "line", "mark", "symbol", "other", "letter"]


def _class_of_byte() -> np.ndarray:
    """Class of each byte; bytes inside a character are counted nowhere (the last, extra class)."""
    of = np.full(256, CLASSES.index("other"), np.int64)
    of[97:123], of[65:91], of[48:58] = CLASSES.index("lower"), CLASSES.index("upper"), CLASSES.index("digit")
    of[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], of[0x0A] = CLASSES.index("space"), CLASSES.index("line")
    of[list(b".,;:!?'\"()-")] = CLASSES.index("mark")
    of[list(SYMBOLS)] = CLASSES.index("symbol")
    of[0xC0:], of[0x80:0xC0] = CLASSES.index("letter"), len(CLASSES)
    return of


def common_words() -> list[str]:
    return list(dict.fromkeys(COMMON))


def _trimmed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """End of each word without one mark after it."""
    return end - ((end - start > 1) & np.isin(data[end - 1], np.frombuffer(b".,;:!?", np.uint8)))


def describe(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Histograms of character classes and of common words (the last bin: all others) of each text."""
    n, kinds = len(ends) - 1, len(CLASSES) + 1
    owner = np.repeat(np.arange(n) * kinds, np.diff(ends))
    chars = np.bincount(owner + _class_of_byte()[data], minlength=n * kinds).reshape(n, kinds)[:, :-1]
    names = [np.frombuffer(x.encode(), np.uint8) for x in common_words()]
    joined = np.concatenate(names)
    bounds = np.cumsum([0, *map(len, names)])
    known = rolling(joined)(bounds[:-1], bounds[1:])
    order = np.argsort(known)
    start, end, first = word_bounds(data, ends)
    lowered = LOWER[data]
    words = rolling(lowered)(start, _trimmed(data, start, end))
    at = np.minimum(np.searchsorted(known[order], words), len(known) - 1)
    bins = np.where(known[order][at] == words, order[at], len(known))
    owner = np.repeat(np.arange(n), np.diff(first))
    counts = np.bincount(owner * (len(known) + 1) + bins, minlength=n * (len(known) + 1))
    return chars, counts.reshape(n, -1)


def distance(histograms: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row from a reference; 0 for a row without counts."""
    p = histograms / np.maximum(histograms.sum(1, keepdims=True), 1)
    q = np.broadcast_to(reference / max(reference.sum(), 1), p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    out = np.sqrt(np.maximum(parts.sum(1) / 2, 0))
    return np.where(histograms.sum(1) > 0, out, 0.0)


def counts(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(ends) - 1
    start, end, first = word_bounds(data, ends)
    inside = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(inside[end] - inside[start])])
    symbol = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))])
    hashes = rolling(data)

    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate([ends[:-1], breaks + 1])) if n else ends
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))[: len(line_start)]
    line_end = line_end - (data[line_end - 1] == 0x0A)
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    owner = np.searchsorted(ends, line_start, "right") - 1
    salt = mix(owner.astype(np.uint64) + np.uint64(1))
    _, seen = np.unique(hashes(line_start, line_end) ^ salt, return_index=True)
    lines = np.bincount(owner, minlength=n) - np.bincount(owner[seen], minlength=n)

    words = hashes(start, end)
    owner = np.repeat(np.arange(n), np.diff(first))
    repeated = np.zeros(len(words), bool)
    if len(words) > 2:
        a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        window = mix(mix(words[:-2] * a + words[1:-1]) * b + words[2:]) ^ mix(owner[:-2].astype(np.uint64) + np.uint64(1))
        whole = np.flatnonzero(owner[:-2] == owner[2:])
        order = whole[np.argsort(window[whole])]
        same = window[order][1:] == window[order][:-1]
        twice = np.concatenate([order[1:][same], order[:-1][same]])
        for k in range(3):
            repeated[twice + k] = True
    return {
        "n_words": np.diff(first),
        "word_chars": chars[first[1:]] - chars[first[:-1]],
        "n_symbols": symbol[ends[1:]] - symbol[ends[:-1]],
        "n_dup_lines": lines,
        "n_repeat_words": by_segment(np.add, repeated.astype(np.int64), first, 0),
    }


def references(docs: DataFrame) -> dict[str, dict[str, list[int]]]:
    """The two histograms of each language, summed over all documents that name it.

    A task adds up its own documents; the driver receives one row for each language.
    """

    def add(part: pa.RecordBatch) -> pa.RecordBatch:
        chars, words = describe(*text_bytes(part.column("text")))
        langs = np.array(part.column("lang").to_pylist(), object)
        names = sorted(set(langs))
        return pa.RecordBatch.from_pydict({
            "lang": pa.array(names, pa.string()),
            "chars": pa.array([chars[langs == x].sum(0).tolist() for x in names], pa.list_(pa.int64())),
            "words": pa.array([words[langs == x].sum(0).tolist() for x in names], pa.list_(pa.int64())),
        })

    parts = mapped(text_rows(docs.filter("lang is not null"), "lang"), add, "lang string, chars array<long>, words array<long>")
    n_words = len(common_words()) + 1
    sums = [F.sum(F.col("chars")[k]).alias(f"c{k}") for k in range(len(CLASSES))]
    sums += [F.sum(F.col("words")[k]).alias(f"w{k}") for k in range(n_words)]
    return {
        row["lang"]: {"chars": [row[f"c{k}"] for k in range(len(CLASSES))], "words": [row[f"w{k}"] for k in range(n_words)]}
        for row in parts.groupBy("lang").agg(*sums).collect()
    }


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance,
    word_distance, nearest, kept of every row of docs.

    A null text has no words, so its base rules fail. Short texts (CHAR_GUARD, WORD_GUARD) are not judged by the
    distance in question, nor is any text if no document names a language. Repeated rows and null ids are judged each for itself,
    an empty table gives no rows, and columns but doc_id, text and lang are not read.
    """
    known = json.dumps(references(docs))

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        data, ends = text_bytes(part.column("text"))
        base = counts(data, ends)
        chars, words = describe(data, ends)
        refs = json.loads(known)
        names, n = sorted(refs), part.num_rows
        failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
        out = {"doc_id": part.column("doc_id")} | {k: pa.array(v.astype(np.int64)) for k, v in base.items()}
        if names:
            by_char = np.stack([distance(chars, np.array(refs[x]["chars"], float)) for x in names])
            by_word = np.stack([distance(words, np.array(refs[x]["words"], float)) for x in names])
            nearest = np.argmin(np.maximum(by_char / CHAR_LIMIT, by_word / WORD_LIMIT), 0)
            char, word = by_char[nearest, np.arange(n)], by_word[nearest, np.arange(n)]
            nearest = [names[k] for k in nearest]
        else:
            nearest, char, word = [None] * n, np.zeros(n), np.zeros(n)
        near = (base["word_chars"] < CHAR_GUARD) | (char <= CHAR_LIMIT)
        near &= (base["n_words"] < WORD_GUARD) | (word <= WORD_LIMIT)
        return pa.RecordBatch.from_pydict(out | {
            "base_failed": pa.array(failed), "char_distance": pa.array(char), "word_distance": pa.array(word),
            "nearest": pa.array(nearest, pa.string()), "kept": pa.array(~failed & near),
        })

    return mapped(
        text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long")), judge,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, char_distance double, word_distance double, nearest string, kept boolean",
    )
