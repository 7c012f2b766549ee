"""Prefix tree of conversations: double-array tries of prefix shards, merged into one table of nodes.

Conversations are cut into stretches of STRETCH turns. Stretches that begin alike (same place, same turns before, same
first turn) belong to one shard, and a shard takes many such beginnings; where one beginning holds more than ROOM turns,
its conversations are dealt to several shards. So a conversation without end, or a first turn that a third of
all conversations share, is spread over tasks.

A shard numbers its different turns densely, packs its tree into the arrays BASE and CHECK (the child of node s by turn
t is BASE[s] + t if CHECK of that place is s) and walks its conversations through them. What it knows of its nodes is
then merged globally by the node's name: its depth and 128 bits over the places and digests of all turns before.

Sums over subtrees need no walk from node to node: each node charges its own part to its smallest member. The nodes
charged to one conversation are a run of that conversation's path, so a subtree's sum is the rest of the run of
its top's smallest member, and the whole runs of its other members.
"""

from __future__ import annotations

import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import literal_rows, settle

#: A conversation may begin with at most so many turns of the first of its EVERY neighbours.
LENGTHS, EVERY = 9, 5
STRETCH = 64
#: Turns of a shard, on average, and of one beginning before it is dealt to several shards.
ROOM = 1 << 16
#: Nodes of a run that are summed together before the run's parts are.
RUN = 1024
#: Ids whose text is joined before it is hashed.
CHUNK = 4096
KEY = ["depth", "k1", "k2"]


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0, by turn, then role and digest), d1, d2 (digest of role and text), bytes of every row.

    Rows are sorted over all tasks, so that one conversation may fill many of them. A task numbers the rows of
    each conversation from 0; only the first conversation of a task can have begun before it.
    """
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text).cast("binary"), 256))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches):
        last, seen = None, 0
        for part in batches:
            ids = part.column("conv_id").to_numpy()
            if not len(ids):
                continue
            fresh = np.ones(len(ids), bool)
            fresh[1:] = ids[1:] != ids[:-1]
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
            at = np.arange(len(ids)) - begin
            if ids[0] == last:
                at[begin == 0] += seen
            last, seen = ids[-1], at[-1] + 1
            halves = np.frombuffer(b"".join(part.column("digest").to_pylist()), "<i8").reshape(-1, 4)
            yield pa.RecordBatch.from_pydict({
                "part": part.column("part"), "conv_id": part.column("conv_id"), "at": pa.array(at.astype(np.int64)),
                "d1": pa.array(halves[:, 0].copy()), "d2": pa.array(halves[:, 1].copy()), "bytes": part.column("bytes"),
            })

    schema = "part int, conv_id long, at long, d1 long, d2 long, bytes long"
    own = settle(dealt.select(F.spark_partition_id().alias("part"), "conv_id", "digest", "bytes").mapInArrow(number, schema), "turns")
    ends = own.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.max(F.struct("conv_id", "at"))["at"].alias("at")
    )
    # One row for each task of the sort.
    before, open_, starts = 0, None, []
    for row in sorted(ends.collect(), key=lambda x: x["part"]):
        if row["first"] == open_ and before:
            starts.append({"part": row["part"], "conv_id": row["first"], "before": before})
        before = row["at"] + 1 + (before if row["first"] == open_ and row["last"] == open_ else 0)
        open_ = row["last"]
    if not starts:
        return own.select("conv_id", F.col("at").alias("pos"), "d1", "d2", "bytes")
    known = literal_rows(own.sparkSession, "part int, conv_id long, before long", starts)
    met = own.join(F.broadcast(known), ["part", "conv_id"], "left")
    return met.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "d1", "d2", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, size: turns once rebuilt), and their turns (conv_id, depth from 1, d1, d2, bytes, size)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENGTHS
    base = F.col("conv_id") - F.col("conv_id") % EVERY
    counts = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("own")).withColumn("h", h).withColumn("base", base)
    counts = settle(counts, "counts")
    found = counts.join(counts.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own")), "base", "left")
    taken = F.least("h", F.coalesce("base_own", F.lit(0)))
    rest = F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = settle(found.select("conv_id", "base", "h", taken.alias("taken"), (taken + rest).alias("size")), "convs")

    heads = turns.filter((F.col("pos") < LENGTHS) & (F.col("conv_id") % EVERY == 0)).withColumnRenamed("conv_id", "base")
    first = heads.join(convs, "base").filter("pos < h").withColumn("depth", F.col("pos") + 1)
    own = turns.join(convs, "conv_id").filter("pos >= h").withColumn("depth", F.col("pos") - F.col("h") + F.col("taken") + 1)
    names = ["conv_id", "depth", "d1", "d2", "bytes", "size"]
    return convs.select("conv_id", "size"), first.select(*names).unionByName(own.select(*names))


def stretches(turns: DataFrame, length: int = STRETCH) -> DataFrame:
    """conv_id, size, stretch, p1, p2 (of the turns before it), turns (an array of length turns at most, in order)."""
    # Turns are named by their place too, so the exclusive or of the names of all turns before is that of their sequence.
    keyed = turns.withColumn("z1", F.xxhash64("depth", "d1", "d2")).withColumn("z2", F.xxhash64("d2", "d1", "depth", F.lit(1)))
    own = keyed.groupBy("conv_id", ((F.col("depth") - 1) / length).cast("long").alias("stretch")).agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("depth", "d1", "d2", "bytes", "z1", "z2"))).alias("turns"),
        F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"),
    )
    own = settle(own, "stretches")
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    long = own.filter(F.col("size") > length)
    starts = long.select("conv_id", "stretch", *[F.bit_xor(f"x{k}").over(before).alias(f"p{k}") for k in (1, 2)])
    names = ["conv_id", "size", "stretch", "turns"]
    short = own.filter(F.col("size") <= length).select(*names, F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"))
    met = long.select(*names).join(starts, ["conv_id", "stretch"])
    return short.unionByName(met.select(*names, *[F.coalesce(p, F.lit(0).cast("long")).alias(p) for p in ("p1", "p2")]))


def sharded(rows: DataFrame, room: int = ROOM) -> DataFrame:
    """rows with shard, and split: whether their beginning is dealt to several shards."""
    first = F.element_at("turns", 1)
    rows = settle(rows.withColumn("start", F.xxhash64("stretch", "p1", "p2", first["d1"], first["d2"])), "starts")
    weights = settle(rows.groupBy("start").agg(F.sum(F.size("turns")).alias("n")), "weights")
    total = weights.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = weights.filter(F.col("n") > room).select("start", F.ceil(F.col("n") / room).alias("parts"))
    met = rows.join(hot, "start", "left")
    part = F.coalesce(F.pmod(F.xxhash64("conv_id"), F.col("parts")), F.lit(0))
    shards = max(1, -(-total // room))
    return met.select(
        *rows.columns, F.pmod(F.xxhash64("start", part), F.lit(shards)).alias("shard"), F.col("parts").isNotNull().alias("split")
    )


class DoubleArray:
    """A tree in two arrays: the child of node s by symbol t is at BASE[s] + t if CHECK is s there. Node 0 is the top."""

    def __init__(self, size: int):
        self.base = np.zeros(max(16, size), np.int64)
        self.check = np.full(max(16, size), -1, np.int64)
        self.check[0] = 0
        #: No place before this one is free.
        self.low = 1

    def reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def free(self, n: int) -> np.ndarray:
        """The first n free places."""
        stop = self.low + 2 * n
        while True:
            self.reserve(stop)
            found = np.flatnonzero(self.check[self.low : stop] < 0)[:n] + self.low
            if len(found) == n:
                return found
            stop *= 2

    def add(self, parents: np.ndarray, symbols: np.ndarray) -> None:
        """Give each parent a child by each of its symbols; pairs come once, sorted by parent, and parents have no children yet."""
        begin = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        size = np.diff(np.concatenate([begin, [len(parents)]]))
        for k in np.argsort(-size, kind="stable")[: int((size > 1).sum())]:
            self.place(parents[begin[k]], np.sort(symbols[begin[k] : begin[k] + size[k]]))
        only = begin[size == 1]
        if len(only):
            at = self.free(len(only))
            self.base[parents[only]] = at - symbols[only]
            self.check[at] = parents[only]
        while self.low < len(self.check) and self.check[self.low] >= 0:
            self.low += 1

    def place(self, parent: int, symbols: np.ndarray, tries: int = 32) -> None:
        for at in self.free(tries):
            places = symbols - symbols[0] + at
            self.reserve(int(places[-1]) + 1)
            if (self.check[places] < 0).all():
                break
        else:  # behind everything that is taken
            at = int(np.flatnonzero(self.check >= 0)[-1]) + 1
            places = symbols - symbols[0] + at
            self.reserve(int(places[-1]) + 1)
        self.base[parent] = places[0] - symbols[0]
        self.check[places] = parent

    def child(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of nodes by symbols, -1 where there is none."""
        at = self.base[nodes] + symbols
        inside = (at > 0) & (at < len(self.check))
        hit = np.zeros(len(at), bool)
        hit[inside] = self.check[at[inside]] == nodes[inside]
        return np.where(hit, at, -1)


def dense(names: np.ndarray, order: np.ndarray) -> np.ndarray:
    """A number for each row of names (equal rows the same one), given in the order of first appearance along order."""
    view = np.ascontiguousarray(names[order]).view([("", names.dtype)] * names.shape[1]).ravel()
    _, first, inverse = np.unique(view, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    out = np.empty(len(names), np.int64)
    out[order] = rank[inverse.ravel()]
    return out


def trie(shard: pa.Table) -> pa.Table:
    """What a shard knows of its nodes (kind 0), of paths that several members share (1), and of ends (2)."""
    lists = pa.concat_arrays(shard.column("turns").chunks)
    turns = lists.flatten()
    size = lists.value_lengths().to_numpy().astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    d = np.stack([turns.field(name).to_numpy() for name in ("d1", "d2")], 1)
    z = np.stack([turns.field(name).to_numpy() for name in ("z1", "z2")], 1)
    weight, depth = turns.field("bytes").to_numpy(), turns.field("depth").to_numpy()
    conv, stretch, total = (shard.column(name).to_numpy() for name in ("conv_id", "stretch", "size"))
    split = shard.column("split").to_numpy()
    key = np.stack([shard.column(name).to_numpy() for name in ("p1", "p2")], 1)

    # Symbols: beginnings first, then turns; siblings that are new together get neighbouring numbers.
    starts = dense(np.concatenate([stretch[:, None], key], 1), np.arange(len(conv)))
    order = np.lexsort((np.arange(begin[-1]) - np.repeat(begin[:-1], size),))
    symbol = dense(d, order) + int(starts.max()) + 1

    symbols_in_all = int(symbol.max()) + 1
    tree = DoubleArray(2 * int(begin[-1] + len(conv)))
    node = np.zeros(len(conv), np.int64)
    live = np.arange(len(conv))
    for level in range(int(size.max()) + 1):
        live = live[size[live] >= level]
        symbols = starts[live] if level == 0 else symbol[begin[live] + level - 1]
        tree.add(*np.divmod(np.unique(node[live] * symbols_in_all + symbols), symbols_in_all))
        node[live] = tree.child(node[live], symbols)

    # A second walk, through BASE and CHECK alone, brings each conversation to its nodes.
    out = []
    node, live = np.zeros(len(conv), np.int64), np.arange(len(conv))
    for level in range(int(size.max()) + 1):
        live = live[size[live] >= level]
        at = begin[live] + level - 1
        here = tree.child(node[live], starts[live] if level == 0 else symbol[at])
        node[live] = here
        before = key[live]
        if level:
            key[live] ^= z[at]
        places, first, which = np.unique(here, return_index=True, return_inverse=True)
        n = np.bincount(which)
        least = np.full(len(places), np.iinfo(np.int64).max)
        np.minimum.at(least, which, conv[live])
        deep = depth[at] if level else np.zeros(len(live), np.int64)
        real = np.ones(len(places), bool) if level else stretch[live[first]] == 0  # other beginnings end another stretch
        top, own = live[first][real], first[real]
        out.append(columns(
            0, least[real], deep[own], key[top], before[own], n[real], weight[at[own]] if level else np.zeros(len(own), np.int64)
        ))
        shared = ((n[which] > 1) | split[live] | (level == 0)) & real[which]
        out.append(columns(1, conv[live[shared]], deep[shared], key[live[shared]]))
        ends = deep == total[live]
        out.append(columns(2, conv[live[ends]], deep[ends], key[live[ends]]))
    return pa.concat_tables(out)


def columns(kind: int, conv, depth, key, before=None, n=None, weight=None) -> pa.Table:
    none = np.zeros(len(conv), np.int64)
    before = before if before is not None else np.zeros((len(conv), 2), np.int64)
    values = [conv, depth, key[:, 0], key[:, 1], before[:, 0], before[:, 1], none if n is None else n, none if weight is None else weight]
    names = ["conv", *KEY, "q1", "q2", "n", "bytes"]
    return pa.table({"kind": pa.array(np.full(len(conv), kind, np.int32)), **{
        name: pa.array(np.ascontiguousarray(x).astype(np.int64)) for name, x in zip(names, values)
    }})


SCHEMA = "kind int, conv long, depth long, k1 long, k2 long, q1 long, q2 long, n long, bytes long"


def end_hashes(ends: DataFrame) -> DataFrame:
    """KEY and ends_sha256 of the nodes that conversations end at (conv, KEY).

    Ids are sorted over all tasks and joined in chunks; only a node's chunks are hashed one after another.
    """
    order = [*KEY, "conv"]

    def join(batches):
        open_, ids = None, []
        for part in batches:
            for *key, conv in zip(*(part.column(name).to_pylist() for name in order)):
                if key != open_ or len(ids) == CHUNK:
                    if ids:
                        yield *open_, ids[0], ",".join(map(str, ids))
                    open_, ids = key, []
                ids.append(conv)
        if ids:
            yield *open_, ids[0], ",".join(map(str, ids))

    def digest(batches):
        open_, state = None, None
        for part in batches:
            for *key, _, ids in zip(*(part.column(name).to_pylist() for name in [*order, "ids"])):
                if key == open_:
                    state.update(b"," + ids.encode())
                    continue
                if open_:
                    yield *open_, state.hexdigest()
                open_, state = key, hashlib.sha256(ids.encode())
        if open_:
            yield *open_, state.hexdigest()

    def batched(rows, names, size=1024):
        def run(batches):
            made = rows(batches)
            while some := list(islice(made, size)):
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*some)))))

        return run

    sorted_ = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = batched(join, [*order, "ids"])
    chunks = settle(sorted_.mapInArrow(joined, "depth long, k1 long, k2 long, conv long, ids string"), "chunks")
    placed = chunks.repartition(*KEY).sortWithinPartitions(*order)
    return placed.mapInArrow(batched(digest, [*KEY, "ends_sha256"]), "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, stretch: int = STRETCH, room: int = ROOM, run: int = RUN) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    turns has conv_id, turn, role, text; a null turn comes first, a null role or text counts as an empty one. Turns that
    share a number are ordered by role, then by the SHA-256 digest of role and text; repeated rows are turns of their own.
    Rows without conv_id belong to no conversation and take no part. An empty table has no nodes, not even the root.
    Other columns are neither read nor returned.
    """
    convs, rows = rebuilt(settle(numbered(turns), "numbered"))
    shards = sharded(stretches(rows, stretch), room)
    found = settle(shards.groupBy("shard").applyInArrow(trie, SCHEMA), "tries")
    silent = convs.filter("size = 0").select(F.col("conv_id").alias("conv"), *[F.lit(0).cast("long").alias(x) for x in (*KEY, "q1", "q2")])
    tops = silent.groupBy(*KEY, "q1", "q2").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).withColumn("bytes", F.lit(0).cast("long"))

    own = ["conv", *KEY, "q1", "q2", "n", "bytes"]
    merged = found.filter("kind = 0").select(*own).unionByName(tops.select(*own)).groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("bytes").alias("bytes")
    )
    merged = settle(merged, "merged")
    children = merged.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2"))
    nodes = merged.join(children.agg(F.count(F.lit(1)).alias("n_children")), KEY, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("saved", (F.col("n") - 1) * F.col("bytes")).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = settle(nodes.withColumn("run", (F.col("depth") / run).cast("long")), "nodes")

    # Runs: the nodes charged to one conversation, summed from their deep end in parts of bounded size.
    deep = Window.partitionBy("conv", "run").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("conv").orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    parts = nodes.groupBy("conv", "run").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"), F.min("depth").alias("top"))
    parts = settle(parts, "runs")
    later = parts.select("conv", "run", *[F.coalesce(F.sum(x).over(after), F.lit(0)).alias(f"later_{x}") for x in ("saved", "leaf")])
    rest = nodes.select("*", *[F.sum(x).over(deep).alias(f"rest_{x}") for x in ("saved", "leaf")]).join(later, ["conv", "run"])
    runs = parts.groupBy("conv").agg(F.min("top").alias("top"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))

    paths = found.filter("kind = 1").select("conv", *KEY).unionByName(silent.select("conv", *KEY))
    hung = paths.join(runs, "conv").filter("depth < top").groupBy(*KEY).agg(F.sum("saved").alias("hung_saved"), F.sum("leaf").alias("hung_leaf"))
    ends = end_hashes(found.filter("kind = 2").select("conv", *KEY).unionByName(silent.select("conv", *KEY)))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent"))

    def whole(name: str):
        return F.col(f"rest_{name}") + F.col(f"later_{name}") + F.coalesce(f"hung_{name}", F.lit(0))

    full = rest.join(hung, KEY, "left").join(ends, KEY, "left").join(above, ["depth", "q1", "q2"], "left")
    return full.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        whole("leaf").alias("n_leaves"), whole("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
