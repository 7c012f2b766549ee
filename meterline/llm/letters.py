"""Words of letters, and bounded samples of labelled documents, for the language and toxicity models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, rolling, slices

#: Bytes of the longest word; a longer run of letters is cut into such words.
LONGEST = 48
#: Bytes of a sampled document that a model may learn from, taken at a place that its id decides.
SAMPLE_BYTES = 16384

LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[0x80:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters in UTF-8."""
    data = LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97))
    data[accented + 1] += 0x20
    return data


def letter_words(
    data: np.ndarray, ends: np.ndarray, longest: int | None = LONGEST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the runs of letters (and other characters beyond ASCII) in lower-cased texts, cut at longest
    bytes if that is given, and the first word of each text (and the end)."""
    inside = LETTER[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = ends[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    pieces = -(-(end - start) // longest) if longest else np.ones(len(start), np.int64)
    if (pieces > 1).any():
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(start, pieces) + k * longest
        end = np.minimum(np.repeat(end, pieces), start + longest)
    return start, end, np.searchsorted(start, ends)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A position of each different word, and for each word which of them it is."""
    _, place, which = np.unique(rolling(data)(start, end), return_index=True, return_inverse=True)
    return place, which


def by_length(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """For each length: the words that have it, and their bytes as a matrix."""
    sizes = end - start
    order = np.argsort(sizes, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(group):
            yield group, data[start[group][:, None] + np.arange(sizes[group[0]])]


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo divisor; null ids count as 1, so that they are learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor)), F.lit(1))


def some_of_each(rows: DataFrame, label: str, total: int) -> DataFrame:
    """Rows (doc_id and label) of about total ids, the same number for each label or all it has; place is added.

    The hash of its id decides whether an id is taken. The ids of each label are counted first; then the share of them
    that comes near the label's part of total is taken, and the first by hash in any case.
    """
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(1 << 30)
    rows = rows.filter(F.col(label).isNotNull()).withColumn("place", place)
    sizes = rows.select("doc_id", label, "place").distinct().groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    counts = {row[label]: (row["n"], row["least"]) for row in sizes.collect()}
    if not counts:
        return rows.limit(0)
    part = total / len(counts)
    shares = F.create_map(*[F.lit(x) for k, (n, least) in counts.items() for x in (k, max(least, min(1.0, part / n)))])
    return rows.filter(F.col("place") <= shares[F.col(label)])


def learned_from(taken: DataFrame) -> list[tuple]:
    """Place, label and text of the rows that some_of_each() took.

    An id gives SAMPLE_BYTES bytes of text at most for a label, from a place that the hash decides, so the driver receives
    no more than the sample's size times that, however often an id is repeated.
    """

    def cut(batches):
        for part in slices(batches):
            texts = []
            for text, place in zip(part.column("text"), part.column("place").to_pylist()):
                data = text.as_buffer().to_pybytes()
                at = int(place * max(0, len(data) - SAMPLE_BYTES))
                texts.append(data[at : at + SAMPLE_BYTES])
            names = ["doc_id", "label", "place"]
            yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(texts, pa.binary())], [*names, "text"])

    rows = taken.filter("text is not null").select("doc_id", "label", "place", "text")
    kinds = dict(rows.dtypes)
    parts = rows.mapInArrow(cut, f"doc_id {kinds['doc_id']}, label {kinds['label']}, place double, text binary")
    found = parts.groupBy("doc_id", "label", "place").agg(F.min("text").alias("text")).collect()
    return sorted((row["place"], row["label"], bytes(row["text"])) for row in found)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As text_bytes() of common, for texts in a list."""
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
