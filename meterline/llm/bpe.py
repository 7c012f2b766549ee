"""Byte-level BPE over whole texts: encoding by tree concatenation, and decoding.

A text of up to LEAF characters is encoded where it lies. A longer one is halved until its parts are that short; the
parts are rows of their own, so that tasks share one long text, and then are joined two by two up the tree. At each
join a window of tokens around it is encoded again and doubled until it agrees with the left side at some point
and with the right side at another one. What lies outside the two points is kept, what lies between them is taken
from the window. Two things make agreement exact:

- A pre-token never holds a character that is no white space followed by white space, so a cut there separates any
  text into parts that are encoded independently.
- Inside a run of letters, a sequence of tokens is the encoding of its text if and only if each two neighbours are the
  encoding of theirs. So a token that one side and the window share, at the same place, joins both.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_rows, worker_cache

#: Characters of the longest text or part that is encoded in one call.
LEAF = 32768
#: Tokens on each side of a join that are encoded first.
WINDOW = 16
#: Letters of scripts whose character classes have not changed for long.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁ]*")
END_ID = 1

# The split pattern of the vocabulary, and the bytes that its file writes as themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


class Codec:
    """Encoder and decoder of a tokenizers file with byte-level BPE and no normalizer."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        others = [b for b in range(256) if b not in set(PRINTED)]
        byte_of = {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(others)}
        vocab: dict[str, int] = spec["model"]["vocab"]
        merged = [vocab["".join(x if isinstance(x, list) else x.split(" "))] for x in spec["model"]["merges"]]
        plain = spec["pre_tokenizer"] | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if merged != sorted(merged) or spec["normalizer"] or spec["pre_tokenizer"] != plain:
            raise ValueError(f"{path} is not a byte-level BPE whose ids follow the order of its merges")
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.lengths = np.zeros(self.encoding.max_token_value + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        for token, i in special.items():
            self.lengths[i] = len(token.encode())

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text in one call."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8", "replace")

    def whole(self, text: str, leaf: int = LEAF) -> np.ndarray:
        """Ids of a text by the tree, in this process."""
        parts = halves(text, leaf)
        return self.joined([(part.encode(), self.encode(part)) for part in parts])[1]

    def joined(self, nodes: list[tuple[bytes, np.ndarray]]) -> tuple[bytes, np.ndarray]:
        while len(nodes) > 1:
            nodes = [self.join(*nodes[k], *nodes[k + 1]) if k + 1 < len(nodes) else nodes[k] for k in range(0, len(nodes), 2)]
        return nodes[0]

    def join(self, left: bytes, left_ids: np.ndarray, right: bytes, right_ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text left + right and its ids, from those of both."""
        whole = left + right
        if not left or not right:
            return whole, left_ids if left else right_ids
        at = np.concatenate([[0], np.cumsum(self.lengths[left_ids])])
        on = len(left) + np.concatenate([[0], np.cumsum(self.lengths[right_ids])])
        room = WINDOW
        while True:
            a, b = max(0, len(at) - 1 - room), min(len(on) - 1, room)
            while a and whole[at[a]] & 0xC0 == 0x80:
                a -= 1
            while b < len(on) - 1 and whole[on[b]] & 0xC0 == 0x80:
                b += 1
            begin, end = int(at[a]), int(on[b])
            text = whole[begin:end].decode()
            ids = self.encode(text)
            near = begin + np.concatenate([[0], np.cumsum(self.lengths[ids])])
            unsplit = LETTERS.fullmatch(text) is not None
            p = 0 if begin == 0 else agreed(whole, begin, len(left), at[a:], near, unsplit, first=True)
            q = len(whole) if end == len(whole) else agreed(whole, len(left), end, on[: b + 1], near, unsplit, first=False)
            if p is not None and q is not None:
                inside = ids[np.searchsorted(near, p) : np.searchsorted(near, q)]
                before, after = left_ids[: np.searchsorted(at, p)], right_ids[np.searchsorted(on, q) :]
                return whole, np.concatenate([before, inside, after])
            room *= 2


def agreed(text: bytes, begin: int, end: int, own: np.ndarray, near: np.ndarray, unsplit: bool, first: bool) -> int | None:
    """A place inside text[begin:end] where a side's token bounds (own) and the window's (near) join exactly."""
    common = np.intersect1d(own, near)
    common = common[(common > begin) & (common < end)]
    if unsplit:
        # A shared token: both of its bounds are common, and neither side has a bound between them.
        follows = np.searchsorted(own, common[1:]) - np.searchsorted(own, common[:-1]) == 1
        follows &= np.searchsorted(near, common[1:]) - np.searchsorted(near, common[:-1]) == 1
        places = common[1:][follows]
    else:
        spaces = np.frombuffer(b"\t\n\v\f\r ", np.uint8)
        if not len(common):
            return None
        data = np.frombuffer(text, np.uint8)
        # ASCII on both sides: the bytes are characters, of which only these are white space.
        before, after = data[common - 1], data[common]
        places = common[(before < 0x80) & (before > 0x20) & (before != 0x7F) & np.isin(after, spaces)]
    return None if not len(places) else int(places[0] if first else places[-1])


def halves(text: str, leaf: int = LEAF) -> list[str]:
    """text halved until no part has over leaf characters."""
    levels = max(0, (max(len(text), 1) - 1) // leaf).bit_length()
    return [text[(k * len(text)) >> levels : ((k + 1) * len(text)) >> levels] for k in range(1 << levels)]


def codec(path: str) -> Codec:
    cache = worker_cache()
    if ("codec", path) not in cache:
        cache["codec", path] = Codec(path)
    return cache["codec", path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_decode(docs: DataFrame, path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit), decoded (text) of every row of docs.

    A null text is an empty one and has no ids. Repeated rows and null ids are encoded each for itself; an empty
    table gives no rows; other columns are neither read nor returned. path must be readable on the executors.
    """
    path = path or default_path()

    def short(batches):
        tokens = codec(path)
        for part in slices(batches):
            ids = [tokens.encode(text) for text in part.column("text").to_pylist()]
            yield result(tokens, part.column("doc_id"), ids)

    def split(batches):
        for part in slices(batches):
            for row in part.to_pylist():
                texts = halves(row["text"], leaf)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row["row"]] * len(texts), pa.int64()), "doc_id": pa.array([row["doc_id"]] * len(texts), pa.int64()),
                    "k": pa.array(range(len(texts)), pa.int32()), "text": pa.array(texts, pa.string()),
                })

    def encoded(batches):
        tokens = codec(path)
        for part in slices(batches):
            ids = [tokens.encode(text).tobytes() for text in part.column("text").to_pylist()]
            yield part.append_column("ids", pa.array(ids, pa.binary()))

    def join(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("k")
        tokens = codec(path)
        nodes = [(x.encode(), np.frombuffer(y, np.uint32)) for x, y in zip(parts["text"].to_pylist(), parts["ids"].to_pylist())]
        ids = tokens.joined(nodes)[1]
        return pa.Table.from_batches([result(tokens, parts["doc_id"].combine_chunks()[:1], [ids])])

    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, ids binary, decoded string"
    brief = rows.filter(F.length("text") <= leaf).mapInArrow(short, schema)
    long_ = rows.filter(F.length("text") > leaf).withColumn("row", F.monotonically_increasing_id())
    leaves = long_.mapInArrow(split, "row long, doc_id long, k int, text string").repartition("row", "k")
    leaves = leaves.mapInArrow(encoded, "row long, doc_id long, k int, text string, ids binary")
    return brief.unionByName(leaves.groupBy("row").applyInArrow(join, schema))


def result(tokens: Codec, doc_id: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_id,
        "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
        "decoded": pa.array([tokens.decode(x) for x in ids], pa.string()),
    })
