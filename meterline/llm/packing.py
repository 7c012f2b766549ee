"""Packing of token sequences by bounded-space online best fit.

Each task reads its documents in order and keeps a fixed number of open windows. A document's last piece goes to the
window that it fills best; if none has room for it, the fullest window is emitted and a new one opened. What is
still open when the tasks end is packed once more, several tasks' pieces together, the longest first.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import END_ID, LEAF, codec, default_path
from .common import settle, slices, text_rows

#: Tokens of a sequence.
LENGTH = 2048
#: Windows that a task holds open.
OPEN = 64
#: Pieces of open windows that one task of the last step packs.
LAST_STEP_PIECES = 50_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, done boolean"


class Packer:
    """Open windows of one task; a piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, length: int, most: int | None, first_id: int):
        self.length, self.most, self.next_id = length, most, first_id
        self.room: list[tuple[int, int]] = []  # room left and window id, in order
        self.pieces: dict[int, list[tuple]] = {}

    def _opened(self) -> int:
        self.next_id += 1
        self.pieces[self.next_id] = []
        return self.next_id

    def place(self, piece: tuple) -> list[tuple]:
        """Put a piece where it fits best; returns the rows of a window that is thereby emitted."""
        n, out = len(piece[2]), []
        at = bisect_left(self.room, (n, -1))
        if at < len(self.room):
            left, window = self.room.pop(at)
        else:
            if self.most and len(self.room) == self.most:
                out = self.close(self.room.pop(0)[1], True)  # the least room: the fullest
            left, window = self.length, self._opened()
        self.pieces[window].append((*piece, window, self.length - left))
        if left == n:
            return out + self.close(window, True)
        insort(self.room, (left - n, window))
        return out

    def close(self, window: int, done: bool) -> list[tuple]:
        return [(*row, done) for row in self.pieces.pop(window)]

    def rest(self, done: bool) -> list[tuple]:
        return [row for window in list(self.pieces) for row in self.close(window, done)]


def record(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, start, ids, tokens, window, offset, done = zip(*rows) if rows else [()] * 7
    long_ = pa.int64()
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(doc_id, long_), "start": pa.array(start, long_),
        "length": pa.array([len(x) for x in ids], long_), "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
        "doc_tokens": pa.array(tokens, long_), "sequence_id": pa.array(window, long_),
        "offset": pa.array(offset, long_), "done": pa.array(done, pa.bool_()),
    })


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, open_windows: int = OPEN) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (binary: little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.

    A document's ids end with END_ID; a null text is an empty one, which has only that id. Whole windows are cut from
    the front of a long document, the rest is packed. Repeated rows are documents of their own, a null id is kept, an
    empty table gives no rows, and other columns are neither read nor returned. The first step is written once to the
    shared folder, so a lost executor cannot pack its documents a second time in another way.
    """
    path = path or default_path()

    def first(batches):
        tokens, task = codec(path), TaskContext.get().partitionId()
        packer, rows = Packer(length, open_windows, task << 32), []
        for part in slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = tokens.encode(text) if len(text) <= LEAF else tokens.whole(text)
                ids = np.append(ids, np.uint32(END_ID))
                for start in range(0, len(ids), length):
                    rows += packer.place((doc_id, start, ids[start : start + length], len(ids)))
            yield record(rows)
            rows = []
        yield record(packer.rest(False))

    def last(batches):
        task = TaskContext.get().partitionId()
        packer, pieces = Packer(length, None, (1 << 62) | (task << 32)), []
        for part in batches:
            columns = [part.column(x).to_pylist() for x in ("doc_id", "start", "ids", "doc_tokens")]
            pieces += [(d, s, np.frombuffer(i, np.uint32), n) for d, s, i, n in zip(*columns)]
        pieces.sort(key=lambda x: -len(x[2]))
        for piece in pieces:
            if rows := packer.place(piece):
                yield record(rows)
        yield record(packer.rest(True))

    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    packed = settle(rows.mapInArrow(first, SCHEMA), "packed")
    open_ = packed.filter(~F.col("done"))
    tasks = -(-open_.count() // LAST_STEP_PIECES)
    # Dealt out by a hash of the row: as even as may be, and the same rows again if a task is run again.
    again = open_.drop("sequence_id", "offset").repartition(max(tasks, 1), F.xxhash64("doc_id", "start", "ids"))
    return packed.filter("done").unionByName(again.mapInArrow(last, SCHEMA)).drop("done")
