"""Language of a text by unigram models of pieces, summed over all segmentations.

Each language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum over
all ways to put it together from pieces, which a forward pass finds in logarithms; a text's is the product over its
words. The piece probabilities are learned by expectation maximisation from the whole texts of a bounded number of documents
that name a language.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, by_segment, mapped, mix, text_bytes, text_rows, worker_cache
from .letters import by_length, distinct, joined, letter_words, lowered, remainder, some_of_each

#: Bytes, with the mark of a word's start, up to which a piece is its own code; the code of a longer one is a hash.
PLAIN = 8
MARK = 1
#: Documents that the models are learned from, all languages together.
SAMPLE = 2400
ROUNDS = 3
#: Probability of a byte that is no piece by itself.
FLOOR = 1e-7
#: Marked runs of letters of more bytes are looked through for places that no piece lies across.
SHORT = 48
#: Bytes of units whose edges are held at once while learning.
HELD = 1 << 20
#: Words' worth of evidence that a score rests on at most: longer texts are not surer than that.
EVIDENCE = 12


def longer(code: np.ndarray, byte: np.ndarray, size: int) -> np.ndarray:
    """Codes of pieces of size bytes, from the codes of all but their first byte, and this byte."""
    if size <= PLAIN:
        return code | (byte << np.uint64(8 * (size - 1)))
    return mix(code * np.uint64(0x9E3779B97F4A7C15) + (byte | np.uint64(size << 8)))


def code_of(piece: bytes) -> int:
    code = np.zeros(1, np.uint64)
    for size, byte in enumerate(reversed(piece), 1):
        code = longer(code, np.array([byte], np.uint64), size)
    return int(code[0])


class Vocabulary(np.ndarray):
    """Sorted codes of pieces, and the bytes of the longest as longest."""

    longest = PLAIN

    def __reduce__(self):
        return restored, (np.asarray(self), self.longest)


def restored(codes: np.ndarray, longest: int) -> Vocabulary:
    out = codes.view(Vocabulary)
    out.longest = longest
    return out


def vocabulary(path: str | None = None) -> Vocabulary:
    """Codes of all pieces of letters; the mark of a word's start is the byte MARK."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    found, longest = set(), PLAIN
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k) or model.is_byte(k):
            continue
        piece = model.id_to_piece(k).lower()
        body = piece.removeprefix("▁")
        if body and all(c.isalpha() for c in body):
            data = bytes([MARK]) * (piece != body) + body.encode()
            found.add(code_of(data))
            longest = max(longest, len(data))
    return restored(np.array(sorted(found), np.uint64), longest)


class Lattice:
    """The pieces of a vocabulary that end at each place of a word."""

    def __init__(self, pieces: np.ndarray):
        self.longest = getattr(pieces, "longest", PLAIN)
        self.pieces = pieces = np.asarray(pieces)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(pieces)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Number of each piece, or their count where the code is none."""
        out = np.full(len(codes), len(self.pieces))
        at = np.flatnonzero(self.maybe[self._slot(codes)])
        k = np.minimum(np.searchsorted(self.pieces, codes[at]), len(self.pieces) - 1)
        same = self.pieces[k] == codes[at]
        out[at[same]] = k[same]
        return out

    def edges(self, units: np.ndarray) -> Iterator[list[np.ndarray]]:
        """For each end j from 1 and each size k from 1: the piece units[:, j - k:j]."""
        units = units.astype(np.uint64)
        for j in range(1, units.shape[1] + 1):
            code, row = np.zeros(len(units), np.uint64), []
            for k in range(1, min(self.longest, j) + 1):
                code = longer(code, units[:, j - k], k)
                row.append(self.find(code))
            yield row

    def cuts(self, run: np.ndarray) -> np.ndarray:
        """The places of a marked run that no piece lies across, its two ends included.

        What is on both sides of such a place is segmented independently, so the run's sum is a product there.
        """
        across, code = np.zeros(len(run) + 1, np.int64), np.zeros(len(run), np.uint64)
        wide = run.astype(np.uint64)
        for k in range(1, min(self.longest, len(run)) + 1):
            code = longer(code[1:] if k > 1 else code, wide[: len(run) - k + 1], k)  # of run[i:i + k] for each i
            if k > 1:
                at = np.flatnonzero(self.find(code) < len(self.pieces))
                np.add.at(across, at + 1, 1)
                np.add.at(across, at + k, -1)
        return np.append(np.flatnonzero(np.cumsum(across[:-1]) == 0), len(run))


def lattice_of(pieces: np.ndarray) -> Lattice:
    """The lattice of pieces, built once in each worker."""
    cache = worker_cache()
    if "lattice" not in cache or not np.array_equal(cache["lattice"].pieces, pieces):
        cache["lattice"] = Lattice(pieces)
    return cache["lattice"]


def units(data: np.ndarray, start: np.ndarray, end: np.ndarray, lattice: Lattice) -> tuple[np.ndarray, ...]:
    """Marked runs, with those above SHORT bytes cut where no piece lies across: bytes, begin, end, and the run of each unit."""
    size = end - start + 1
    close = np.cumsum(size)
    flat = np.full(int(size.sum()), MARK, np.uint8)
    inside = np.ones(len(flat), bool)
    inside[close - size] = False
    flat[inside] = data[np.repeat(start - (close - size) - 1, size)[inside] + np.flatnonzero(inside)]
    begin, stop, owner = [close - size], [close], [np.arange(len(size))]
    long = np.flatnonzero(size > SHORT)
    if len(long):
        keep = np.ones(len(size), bool)
        keep[long] = False
        begin, stop, owner = [begin[0][keep]], [stop[0][keep]], [owner[0][keep]]
        for k in long:
            at = lattice.cuts(flat[close[k] - size[k] : close[k]]) + close[k] - size[k]
            begin.append(at[:-1])
            stop.append(at[1:])
            owner.append(np.full(len(at) - 1, k))
    return flat, np.concatenate(begin), np.concatenate(stop), np.concatenate(owner)


def logs_of(chance: np.ndarray) -> np.ndarray:
    """Logarithms of chances; the last row is that of no piece."""
    with np.errstate(divide="ignore"):
        return np.log(chance)


def forward(edges: Iterator[list[np.ndarray]], logs: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Log of the sum over the segmentations of each unit's first j bytes, for j from 0 and each column of logs.

    A single byte always counts with FLOOR at least, so every unit has a finite sum. Only the last `longest` sums are held.
    """
    floor, held = np.log(FLOOR), deque(maxlen=longest + 1)
    for j, row in enumerate(edges, 1):
        if j == 1:
            held.append(np.zeros((len(row[0]), logs.shape[1])))
            yield held[-1]
        alpha = held[-1] + np.maximum(logs[row[0]], floor)
        for k, piece in enumerate(row[1:], 2):
            hit = np.flatnonzero(piece < len(logs) - 1)
            if len(hit):
                alpha[hit] = np.logaddexp(alpha[hit], held[-k][hit] + logs[piece[hit]])
        held.append(alpha)
        yield alpha


def expected(edges: list[list[np.ndarray]], chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in units of these weights, for one language (a column of chance)."""
    logs, floor = logs_of(chance), np.log(FLOOR)
    alpha = np.stack([a[:, 0] for a in forward(iter(edges), logs, len(edges))])
    beta, out = np.full_like(alpha, -np.inf), np.zeros(len(chance))
    beta[-1] = np.log(weight) - alpha[-1]
    p = logs[:, 0]
    for j in range(len(edges), 0, -1):
        for k, piece in enumerate(edges[j - 1], 1):
            flow = np.maximum(p[piece], floor) if k == 1 else p[piece]
            hit = np.flatnonzero(flow > -np.inf)
            beta[j - k][hit] = np.logaddexp(beta[j - k][hit], beta[j][hit] + flow[hit])
            out += np.bincount(piece[hit], np.exp(alpha[j - k][hit] + flow[hit] + beta[j][hit]), len(chance))
    return out


def learned_units(taken: DataFrame, pieces: np.ndarray) -> list[tuple[str, bytes, int]]:
    """Label, unit and number of every different unit in the whole texts that some_of_each() took; an id gives one text a label."""

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        data, ends = text_bytes(part.column("text"))
        data, lattice = lowered(data), lattice_of(pieces)
        start, end, first = letter_words(data, ends, None)
        found: Counter = Counter()
        for label, a, b in zip(part.column("label").to_pylist(), first, first[1:]):
            if a < b:
                flat, begin, stop, _ = units(data, start[a:b], end[a:b], lattice)
                found.update((label, flat[x:y].tobytes()) for x, y in zip(begin, stop))
        return pa.RecordBatch.from_pydict({
            "label": pa.array([k[0] for k in found], pa.string()), "unit": pa.array([k[1] for k in found], pa.binary()),
            "n": pa.array(list(found.values()), pa.int64()),
        })

    texts = taken.dropna(subset=["text"]).groupBy("doc_id", "label", "place").agg(F.min("text").alias("text"))
    counted = mapped(texts.select("label", "text"), count, "label string, unit binary, n long")
    rows = counted.groupBy("label", "unit").agg(F.sum("n").alias("n")).collect()
    return sorted((row["label"], bytes(row["unit"]), row["n"]) for row in rows)


def learn(sample: list[tuple[str, bytes, int]], pieces: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Languages, and the probabilities of each piece (and of none) in each of them."""
    lattice, names, columns = Lattice(pieces), sorted({label for label, _, _ in sample}), []
    for name in names:
        own = [(unit, n) for label, unit, n in sample if label == name]
        data, ends = joined([unit for unit, _ in own])
        counts = np.array([n for _, n in own], float)
        groups = [
            (list(lattice.edges(some)), counts[group])
            for group, words in by_length(data, ends[:-1], ends[1:]) for group, some in parts_of(group, words)
        ]
        chance = np.full((len(pieces) + 1, 1), 1 / len(pieces))
        for _ in range(ROUNDS + 1):
            chance[-1] = 0
            uses = sum((expected(edges, chance, weight) for edges, weight in groups), np.zeros(len(chance)))[:-1] + 0.02
            chance = np.append(uses / uses.sum(), 0)[:, None]
        columns.append(chance[:, 0])
    return names, np.stack(columns, 1) if columns else np.zeros((len(pieces) + 1, 0))


def parts_of(group: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units of one length, in parts of bounded size."""
    step = max(1, HELD // words.shape[1])
    for at in range(0, len(group), step):
        yield group[at : at + step], words[at : at + step]


def likelihoods(data: np.ndarray, ends: np.ndarray, lattice: Lattice, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each text in each language, and its number of runs of letters."""
    data = lowered(data)
    start, end, first = letter_words(data, ends, None)
    place, which = distinct(data, start, end)
    sums, logs = np.zeros((len(place), chance.shape[1])), logs_of(chance)
    if len(place):
        flat, begin, stop, owner = units(data, start[place], end[place], lattice)
        for group, words in by_length(flat, begin, stop):
            last = None
            for last in forward(lattice.edges(words), logs, lattice.longest):
                pass
            np.add.at(sums, owner[group], last)
    return by_segment(np.add, sums[which], first, 0.0), np.diff(first)


def identify(docs: DataFrame, vocabulary_path: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs.

    Learned from rows whose remainder (crc32 of the id, modulo 4) is not 2 and that name a language. lang_pred is
    "und" with score 0 for a null text or one without letters, and if nothing could be learned. Of equally likely
    languages the first by name is taken. A null id is not held out. Repeated rows are judged each for itself, an
    empty table gives no rows, and columns but doc_id, text and lang are not read.
    """
    judge = judged(docs, vocabulary_path, sample)

    def rows_of(part: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = judge(part.column("text"))
        return pa.RecordBatch.from_pydict({
            "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": langs, "score": scores,
        })

    rows = text_rows(docs, (remainder("doc_id", 4) == 2).alias("held_out"))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    return mapped(rows, rows_of, "doc_id long, held_out boolean, lang_pred string, score double")


def judged(
    docs: DataFrame, vocabulary_path: str | None = None, sample: int = SAMPLE
) -> Callable[[pa.Array], tuple[pa.Array, pa.Array]]:
    """A function of texts that gives their languages and scores."""
    source = docs.select("doc_id", "text", F.col("lang").alias("label")).filter(remainder("doc_id", 4) != 2)
    pieces = vocabulary(vocabulary_path)
    names, chance = learn(learned_units(some_of_each(source.dropna(), "label", sample), pieces), pieces)

    def judge(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        if names:
            data, ends = text_bytes(texts)
            totals, n = likelihoods(data, ends, lattice_of(pieces), chance)
            best = totals.argmax(1)
            scaled = (totals - totals.max(1, keepdims=True)) / np.maximum(n, 1)[:, None] * np.minimum(n, EVIDENCE)[:, None]
            sure = 1 / np.exp(scaled).sum(1)
            plain = by_segment(np.logical_or, (data | 0x20 >= 97) & (data | 0x20 <= 122), ends, False)
            for k in range(len(texts)):
                if n[k] and (plain[k] or any(c.isalpha() for c in texts[k].as_py())):
                    langs[k], scores[k] = names[best[k]], sure[k]
        return pa.array(langs, pa.string()), pa.array(scores, pa.float64())

    return judge


def with_language(docs: DataFrame, name: str, sure: str) -> DataFrame:
    """docs with the language and the score of each row as columns."""
    judge = judged(docs)
    return appended(docs, lambda texts: dict(zip((name, sure), judge(texts))), f"{name} string, {sure} double")
