"""Quality of a text by a byte-level convolutional network, written in numpy.

Filters look at FILTER bytes each, as one-hot input; so a filter is a table with a row for each byte value at each of
its places. A document is cut into overlapping chunks that cover it, each filter's response is rectified and
max-pooled over each chunk, a small dense layer turns the pooled responses into a chunk's evidence, and the mean
evidence of all chunks gives one probability. Positions that run past the end of a text see zero bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, mapped, text_bytes, text_rows
from .letters import joined, learned_from, remainder, some_of_each

FILTER, FILTERS, HIDDEN = 5, 16, 16
#: Bytes of a cell; a chunk is CELLS cells, and the next chunk begins STEP cells further.
CELL, CELLS, STEP = 64, 6, 3
#: Labelled documents that the network learns from.
SAMPLE = 3000
EPOCHS, GROUP, CHUNKS = 6, 32, 4
#: Bytes whose filter responses are held at once.
STRIP = 1 << 16
#: Predicted 1 from this score on.
THRESHOLD = 0.3


class Network:
    """w: [FILTER, 256, FILTERS]; the rest are the biases and the dense layers."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.w = rng.normal(0, 0.4, (FILTER, 256, FILTERS)).astype(f)
        self.b = np.full(FILTERS, -0.5, f)
        self.v = rng.normal(0, 0.4, (FILTERS, HIDDEN)).astype(f)
        self.c = np.zeros(HIDDEN, f)
        self.u = rng.normal(0, 0.4, HIDDEN).astype(f)
        self.d = np.zeros(1, f)

    def parts(self) -> list[np.ndarray]:
        return [self.w, self.b, self.v, self.c, self.u, self.d]

    def evidence(self, pooled: np.ndarray) -> np.ndarray:
        return np.tanh(pooled @ self.v + self.c) @ self.u + self.d[0]

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter sums at each place of data but the last FILTER - 1."""
        n = len(data) - FILTER + 1
        out = self.w[0][data[:n]]
        for k in range(1, FILTER):
            out += self.w[k][data[k : k + n]]
        return out

    def pooled(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max-pooled responses of all chunks of all texts, and the first chunk of each text (and the end)."""
        sizes = np.diff(ends)
        pad = FILTER  # an empty text, too, is followed by as many zeros as a filter sees
        shift = np.arange(len(sizes)) * pad
        padded = np.zeros(len(data) + pad * (len(sizes) + 1), np.uint8)
        padded[np.arange(len(data)) + np.repeat(shift, sizes)] = data
        n_cells = np.maximum(-(-sizes // CELL), 1)
        first_cell = np.concatenate([[0], np.cumsum(n_cells)])
        within = np.arange(first_cell[-1]) - np.repeat(first_cell[:-1], n_cells)
        starts = np.repeat(ends[:-1] + shift, n_cells) + within * CELL
        stops = np.minimum(starts + CELL, np.repeat(np.maximum(ends[1:] + shift, ends[:-1] + shift + 1), n_cells))
        cells = np.empty((len(starts), FILTERS), np.float32)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(stops, starts[at] + STRIP, "right")))
            strip = self.responses(padded[starts[at] : stops[to - 1] + FILTER - 1])
            # Cells follow one another, but for the padding between two texts, which is left out of the maximum.
            bounds = np.stack([starts[at:to], stops[at:to]], 1).ravel() - starts[at]
            cells[at:to] = np.maximum.reduceat(strip, bounds[:-1] if bounds[-1] == len(strip) else bounds, axis=0)[::2]
            at = to
        cells = np.maximum(cells + self.b, 0)
        n_chunks = np.maximum(-(-(n_cells - CELLS) // STEP) + 1, 1)
        first = np.concatenate([[0], np.cumsum(n_chunks)])
        begin = np.repeat(first_cell[:-1], n_chunks) + (np.arange(first[-1]) - np.repeat(first[:-1], n_chunks)) * STEP
        end = np.minimum(begin + CELLS, np.repeat(first_cell[1:], n_chunks))
        out = cells[begin]
        for k in range(1, CELLS):
            out = np.maximum(out, cells[np.minimum(begin + k, end - 1)])
        return out, first

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(ends) < 2:
            return np.zeros(0)
        pooled, first = self.pooled(data, ends)
        sums = np.add.reduceat(self.evidence(pooled), first[:-1])
        return 1 / (1 + np.exp(-(sums / np.diff(first)).astype(np.float64)))


def learn(sample: list[tuple], seed: int = 5) -> Network | None:
    """A network for texts labelled 0 and 1; none without both labels.

    Each pass looks at CHUNKS chunks of each text, drawn anew, and both labels weigh the same.
    """
    labels = np.array([label for _, label, _ in sample], np.float32)
    if len(set(labels.tolist())) < 2:
        return None
    data, ends = joined([text for _, _, text in sample])
    net, rng = Network(seed), np.random.default_rng(seed)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in net.parts()]
    size, step = CELL * CELLS, 0
    padded = np.concatenate([data, np.zeros(size + FILTER, np.uint8)])
    for epoch in range(EPOCHS):
        for docs in np.array_split(rng.permutation(len(sample)), max(1, len(sample) // GROUP)):
            room = np.maximum(np.diff(ends)[docs] - size, 0)
            begin = (ends[docs][:, None] + rng.random((len(docs), CHUNKS)) * (room[:, None] + 1)).astype(np.int64)
            begin = np.minimum(begin, (ends[docs] + room)[:, None])
            places = begin[:, :, None] + np.arange(size + FILTER - 1)
            chunk = np.where(places < ends[docs + 1][:, None, None], padded[places], 0).reshape(-1, size + FILTER - 1)
            stop = (ends[docs + 1][:, None] - begin).ravel()
            sums = sum(net.w[k][chunk[:, k : k + size]] for k in range(FILTER))
            sums[np.arange(size)[None, :] >= np.maximum(stop, 1)[:, None]] = -1e9
            peak = sums.argmax(1)
            pooled = np.maximum(np.take_along_axis(sums, peak[:, None, :], 1)[:, 0] + net.b, 0)
            hidden = np.tanh(pooled @ net.v + net.c)
            logit = (hidden @ net.u + net.d[0]).reshape(len(docs), CHUNKS).mean(1)
            error = (1 / (1 + np.exp(-logit)) - labels[docs]) * weight[docs] / len(docs)
            each = np.repeat(error / CHUNKS, CHUNKS)[:, None]
            d_hidden = each * net.u * (1 - hidden**2)
            d_pooled = (d_hidden @ net.v.T) * (pooled > 0)
            grad_w = np.zeros_like(net.w)
            column = np.arange(FILTERS)[None, :]
            for k in range(FILTER):
                seen = np.take_along_axis(chunk, peak + k, 1)
                np.add.at(grad_w[k], (seen, np.broadcast_to(column, seen.shape)), d_pooled)
            grads = [grad_w, d_pooled.sum(0), pooled.T @ d_hidden, d_hidden.sum(0), (each * hidden).sum(0), each.sum(0)]
            step += 1
            rate = 0.01 * 0.5 ** (epoch // 2)
            for x, g, (m, s) in zip(net.parts(), grads, moments):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-6)
    return net


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Learned from labelled rows whose remainder (crc32 of the id, modulo 5) is not 0; a null label is none, and of
    several labels of an id the largest holds. A null text is scored like an empty one. Without both labels to learn from, all scores are
    0.5. A null id is not held out. Repeated rows are scored each for itself, an empty table gives no rows, and
    other columns are not read.
    """
    score = scorer(docs, labels, sample)

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        return scored(part, score(part.column("text")))

    rows = text_rows(docs, (remainder("doc_id", 5) == 0).alias("held_out"))
    return mapped(rows.withColumn("doc_id", F.col("doc_id").cast("long")), judge, SCORED)


def scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Callable[[pa.Array], np.ndarray]:
    net = learn(labelled_sample(docs, labels, "quality", 5, 0, sample))
    return lambda texts: net.scores(*text_bytes(texts)) if net else np.full(len(texts), 0.5)


def with_quality(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """docs with the score of each row as column name."""
    score = scorer(docs, labels)
    return appended(docs, lambda texts: {name: pa.array(score(texts), pa.float64())}, f"{name} double")


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def scored(part: pa.RecordBatch, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": pa.array(score, pa.float64()),
        "predicted": pa.array((score >= THRESHOLD).astype(np.int32)),
    })


def labelled_sample(docs: DataFrame, labels: DataFrame, name: str, divisor: int, out: int, sample: int) -> list[tuple]:
    """Bounded sample of texts with label name, of rows whose remainder is not out.

    The labelled ids are sampled before they meet the texts. They are about so many as sample says, whatever the size
    of the input, so they are broadcast.
    """
    known = labels.select("doc_id", F.col(name).alias("label")).dropna()
    known = known.filter(remainder("doc_id", divisor) != out).groupBy("doc_id").agg(F.max("label").alias("label"))
    taken = some_of_each(known, "label", sample)
    return learned_from(docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id"))
