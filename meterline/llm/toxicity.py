"""Toxicity by two Kneser-Ney models of words, one of toxic and one of ordinary documents.

The models spell words byte by byte. Each class counts, for each history of up to HISTORY bytes (the mark of a word's
start included), the bytes that follow; discounted mass goes to shorter histories, whose continuation
counts both classes share. So where a class has not seen a history, it says what the other says of it, and a rare
spelling counts only as far as one class has evidence for it. A stretch of words is compared by the difference of
both log-likelihoods for each byte, and so is the whole text; a logistic function joins them into one score.

All labelled texts are counted, whole, so the models grow with the different spellings of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_segment, mapped, settle, slices, text_bytes, text_rows
from .letters import by_length, distinct, joined, letter_words, lowered, remainder
from .quality import SCORED, scored

#: Bytes before the one that is predicted; history and byte fit an unsigned 64-bit integer.
HISTORY = 6
DISCOUNT = 0.75
#: A third of this is the number of documents that the weights of the score are learned from, at most a third of each label.
SAMPLE = 6000
#: Different codes that a task holds at once, about.
HELD = 1 << 20
#: Words of the stretches that are compared.
STRETCHES = (1, 6, 24)
BEGIN, END = 1, 2


def spelled(words: np.ndarray) -> np.ndarray:
    """History and byte at each place of words of one length and at their end, as integers [words, places]."""
    n, size = words.shape
    marked = np.concatenate([np.full((n, 1), BEGIN, np.uint8), words, np.full((n, 1), END, np.uint8)], 1).astype(np.uint64)
    out = np.empty((n, size + 1), np.uint64)
    code = marked[:, 0]
    keep = np.uint64((1 << (8 * (HISTORY + 1))) - 1)
    for k in range(1, size + 2):
        code = ((code << np.uint64(8)) | marked[:, k]) & keep
        out[:, k - 1] = code
    return out


def sizes(codes: np.ndarray) -> np.ndarray:
    """Bytes of each code."""
    return sum((codes >= np.uint64(1 << (8 * k))).astype(np.int64) for k in range(HISTORY + 1))


def tail(codes: np.ndarray, size: int) -> np.ndarray:
    return codes & np.uint64((1 << (8 * size)) - 1)


def shared_chances(codes: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of each code's byte after its history less the first byte, from the codes of both classes."""
    size = sizes(codes)
    types = {k: codes[size == k] for k in range(2, HISTORY + 2)}
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k in range(HISTORY, 0, -1):  # continuation counts: how many longer codes end in a code of k bytes
        longer = np.concatenate([types[k + 1], known[k + 1][0]] if k < HISTORY else [types[k + 1]])
        known[k] = np.unique(tail(np.unique(longer), k), return_counts=True)
    chance = {0: np.full(1, 1 / 256)}
    for k in range(1, HISTORY + 1):
        codes_k, n = known[k]
        _, which = np.unique(codes_k >> np.uint64(8), return_inverse=True)
        total, kinds = np.bincount(which, n)[which], np.bincount(which)[which]
        lower = chance[k - 1][np.searchsorted(known[k - 1][0], tail(codes_k, k - 1))] if k > 1 else chance[0]
        chance[k] = np.maximum(n - DISCOUNT, 0) / total + DISCOUNT * kinds / total * lower
    out = np.empty(len(codes))
    for k in range(2, HISTORY + 2):
        at = size == k
        out[at] = chance[k - 1][np.searchsorted(known[k - 1][0], tail(codes[at], k - 1))]
    return out


class Contrast:
    """What toxic texts' log-likelihood exceeds ordinary ones' by, for each history and byte."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """codes sorted and different; counts [2, codes] of the ordinary and the toxic class."""
        lower = shared_chances(codes)
        history, which = np.unique(codes >> np.uint64(8), return_inverse=True)
        logs, rest = [], []
        for n in counts.astype(float):
            total, kinds = np.bincount(which, n), np.bincount(which, n > 0)
            left = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            own = np.where(n > 0, (n - DISCOUNT) / np.maximum(total[which], 1), 0)
            logs.append(np.log(own + left[which] * lower))
            rest.append(np.log(left))
        # A history stands for itself with the byte 0, which no word holds.
        keys = np.concatenate([codes, history << np.uint64(8)])
        gains = np.concatenate([logs[1] - logs[0], rest[1] - rest[0]]).astype(np.float32)
        order = np.argsort(keys)
        self.keys, self.gains = keys[order], gains[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self._slot(self.keys)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gain of each code, and whether it is known."""
        out, known = np.zeros(len(codes)), np.zeros(len(codes), bool)
        at = np.flatnonzero(self.maybe[self._slot(codes)])
        k = np.minimum(np.searchsorted(self.keys, codes[at]), len(self.keys) - 1)
        at, k = at[same := self.keys[k] == codes[at]], k[same]
        out[at], known[at] = self.gains[k], True
        return out, known

    def of_words(self, words: np.ndarray) -> np.ndarray:
        codes = spelled(words)
        flat = codes.ravel()
        gain, known = self.find(flat)
        other = np.flatnonzero(~known)
        gain[other] = self.find(flat[other] >> np.uint64(8) << np.uint64(8))[0]
        return gain.reshape(codes.shape).sum(1)

    def features(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each text: the largest difference for each byte of its stretches of each size, and that of the whole."""
        data = lowered(data)
        start, end, first = letter_words(data, ends)
        out = np.zeros((len(ends) - 1, len(STRETCHES) + 1))
        if not len(start):
            return out
        place, which = distinct(data, start, end)
        gains = np.zeros(len(place))
        for group, words in by_length(data, start[place], end[place]):
            gains[group] = self.of_words(words)
        gain = np.concatenate([[0], np.cumsum(gains[which])])
        size = np.concatenate([[0], np.cumsum(end - start + 1)])
        last = np.repeat(first[1:], np.diff(first))
        for k, n in enumerate(STRETCHES):
            # A stretch at the end of a text reaches back, so that it is whole if the text has so many words.
            to = np.minimum(np.arange(len(start)) + n, last)
            back = np.maximum(to - n, np.repeat(first[:-1], np.diff(first)))
            mean = (gain[to] - gain[back]) / (size[to] - size[back])
            out[:, k] = by_segment(np.maximum, mean, first, 0.0)
        out[:, -1] = (gain[first[1:]] - gain[first[:-1]]) / np.maximum(size[first[1:]] - size[first[:-1]], 1)
        return out


def codes_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of texts, and how often each occurs; a code may come several times."""
    data = lowered(data)
    start, end, _ = letter_words(data, ends)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place, which = distinct(data, start, end)
    n, found = np.bincount(which, minlength=len(place)), []
    for group, words in by_length(data, start[place], end[place]):
        codes = spelled(words)
        found.append((codes.ravel(), np.repeat(n[group], codes.shape[1])))
    codes, n = (np.concatenate(x) for x in zip(*found))
    return codes, n


def summed(parts: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different codes of parts (codes, counts, class), and their counts [classes, codes]."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros((classes, 0), np.int64)
    keys, which = np.unique(np.concatenate([codes for codes, _, _ in parts]), return_inverse=True)
    counts, at = np.zeros((classes, len(keys)), np.int64), 0
    for codes, n, y in parts:
        counts[y] += np.bincount(which[at : at + len(codes)], n, len(keys)).astype(np.int64)
        at += len(codes)
    return keys, counts


def counted(sample: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of the sample, and their counts in class 0 and class 1."""
    return summed([(*codes_of(*joined([text for _, y, text in sample if y == label])), label) for label in (0, 1)], 2)


#: Columns of counts: of texts that only teach the models, and of those that the weights are learned from, by label.
COUNTS = ["n0", "n1", "w0", "w1"]


def all_counted(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of texts (text, label, weigh), and their counts as COUNTS has them."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, int]] = []
        size = 0
        for part in slices(batches):
            kind = part.column("label").to_numpy() + 2 * part.column("weigh").to_numpy()
            for y in np.unique(kind):
                codes, n = codes_of(*text_bytes(part.column("text").filter(pa.array(kind == y))))
                held.append((codes, n, int(y)))
                size += len(codes)
            if size > 4 * HELD:
                keys, counts = summed(held, len(COUNTS))
                held, size = [(keys[at], n[at], y) for y, n in enumerate(counts) if len(at := np.flatnonzero(n))], len(keys)
                if size > HELD:
                    yield rows_of(keys, counts)
                    held, size = [], 0
        yield rows_of(*summed(held, len(COUNTS)))

    def rows_of(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), *map(pa.array, counts)], ["code", *COUNTS])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield pa.RecordBatch.from_pydict({x: pa.array([part.column(x).to_numpy().tobytes()], pa.binary()) for x in ("code", *COUNTS)})

    longs, blobs = (", ".join(f"{x} {kind}" for x in ("code", *COUNTS)) for kind in ("long", "binary"))
    each = texts.mapInArrow(tally, longs).groupBy("code").agg(*[F.sum(x).alias(x) for x in COUNTS])
    # Partitions come one after another, so that the driver holds one of them besides the arrays.
    found = [[np.frombuffer(bytes(x), np.int64) for x in row] for row in settle(each, "codes").mapInArrow(pack, blobs).toLocalIterator()]
    if not found:
        return np.zeros(0, np.uint64), np.zeros((len(COUNTS), 0), np.int64)
    codes, *counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(codes)
    return codes[order].astype(np.uint64), np.stack(counts)[:, order]


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic function (the last: its constant), with a small penalty, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return w


def labelled(labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, label and weigh (1: the weights are learned from it) of the ids to learn from."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    known = known.filter(remainder("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1 / 3, sample / 6 / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(1 << 30)
    return known.withColumn("weigh", (place < share).cast("int"))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Contrast, np.ndarray] | None:
    """The models and the weights of their differences; none without both labels among either kind of texts.

    The weights are learned from texts that the models do not yet count; then these are counted, too.
    """
    known = settle(labelled(labels, sample), "labelled")
    rows = docs.select("doc_id", "text").filter("text is not null")
    keys, counts = all_counted(rows.join(known, "doc_id").select("text", "label", "weigh"))
    if not counts.any(1).all():
        return None
    seen = counts[:2].any(0)
    contrast = Contrast(keys[seen], counts[:2, seen])

    def measure(part: pa.RecordBatch) -> pa.RecordBatch:
        x = contrast.features(*text_bytes(part.column("text")))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(list(x))], ["doc_id", "label", "x"])

    some = F.broadcast(known.filter("weigh = 1").select("doc_id", "label"))
    kind = dict(known.dtypes)["doc_id"]
    # A row for each id, however often it is repeated.
    measured = mapped(rows.join(some, "doc_id"), measure, f"doc_id {kind}, label int, x array<double>")
    found = sorted((row["y"], row["x"]) for row in measured.groupBy("doc_id").agg(F.max("label").alias("y"), F.min("x").alias("x")).collect())
    weights = fitted(np.array([x for _, x in found]), np.array([y for y, _ in found], float))
    return Contrast(keys, counts[:2] + counts[2:]), weights


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Learned from labelled rows whose remainder (crc32 of the id, modulo 4) is not 2; a null label is none, and of
    several labels of an id the largest holds; labels but 0 and 1 are none. A null text is scored like an empty one, which has no stretches. Without both labels to learn
    from, all scores are 0. A null id is not held out. Repeated rows are scored each for itself, an empty table gives no rows, and other columns
    are not read.
    """
    model = learn(docs, labels, sample)

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        score = np.zeros(part.num_rows)
        if model:
            contrast, w = model
            x = contrast.features(*text_bytes(part.column("text")))
            score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        return scored(part, score)

    rows = text_rows(docs, (remainder("doc_id", 4) == 2).alias("held_out"))
    return mapped(rows.withColumn("doc_id", F.col("doc_id").cast("long")), judge, SCORED)
