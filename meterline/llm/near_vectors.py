"""Near-duplicate vectors by NN-descent, with an exact pass for what its lists cannot hold.

Equal vectors form one class from the start. Neighbour lists start from blocks of orders by random hyperplanes. In each
round the neighbours and reverse neighbours of a vector meet and are compared, if one of both is new to the list; each
vector keeps the NEAREST best. A list whose entries all reach the threshold is saturated and grows, up to WIDEST links.
Rounds end when one brings no link to a list that can still grow.

Two audits follow. Probes, vectors made at the threshold from a hash sample of the rows in directions of their own, take
part in the search; the share of them that is found measures the hardest case, a pair that no neighbour leads to. Rows of
another hash sample are compared with all rows, and their recall is averaged row by row, so that a large family counts
no more than a pair. While either is below RECALL, the search goes on from further orders.

Rows with WIDEST links or more leave the lists as open rows and are compared with all rows in blocks; blocks whose
centers are further apart than both radii and the angle of the threshold allow are left out. Should SEARCHES searches
not satisfy the audits, all rows are open. Of the links between two blocks only their number for each vector and a
forest that connects the linked vectors are written, so a family costs comparisons, but no row for each link.

Every similarity is computed in double precision from the components as they are stored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batch, literal_rows, settle
from .components import components

THRESHOLD = 0.95
#: Orders by random hyperplanes of one search, sides that a key has, vectors of a block and the best that each keeps there.
ORDERS, SIDES, GROUP, SEEDED = 12, 30, 64, 4
#: Entries of a list, links that make a row an open one, and members of a center that meet in one group on average.
NEAREST, WIDEST, TOGETHER = 8, 64, 192
#: Rounds of a search and searches, at most.
ROUNDS, SEARCHES = 6, 8
#: Rows (about) that a probe is made from, its similarity, rows that are compared with all, and the recall both must reach.
PROBES, PROBE, AUDITED, RECALL = 2000, THRESHOLD + 1e-4, 1024, 0.99
#: Blocks that a table has at least, and bytes and vectors that a block has at most on average.
SHARES, BLOCK_BYTES, BLOCK = 16, 4 << 20, 16384
#: Pivots of one dimension, at most.
PIVOTS = 1024
#: Similarities that are held at once.
HELD = 1 << 22
#: What the angle between two blocks must exceed their reach by, against rounding.
MARGIN = 1e-6


def stored(rows: DataFrame) -> DataFrame:
    """vec_id, dim, vec (components as they are stored), digest; the last three null if the vector is not to be linked."""

    def take(batches):
        for batch in batches:
            vecs, digests, dims = [], [], []
            for value in batch.column("embedding"):
                x = value.values.to_numpy(zero_copy_only=False) if value.is_valid and len(value.values) else np.zeros(0)
                fine = len(x) and value.values.null_count == 0 and np.isfinite(x).all() and x.any()
                vecs.append(x.tobytes() if fine else None)
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if fine else None)
                dims.append(len(x) if fine else None)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "dim": pa.array(dims, pa.int32()),
                "vec": pa.array(vecs, pa.binary()), "digest": pa.array(digests, pa.binary()),
            })

    kind = "double" if dict(rows.dtypes)["embedding"] == "array<double>" else "float"
    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return plain.mapInArrow(take, "vec_id long, dim int, vec binary, digest binary")


def unit(vecs: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one dimension as rows of length 1, in double precision."""
    return rows_of(b"".join(vecs.to_pylist()), len(vecs), dim)


def rows_of(data: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.float32 if len(data) == 4 * dim * n else np.float64
    x = np.frombuffer(data, kind).reshape(n, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def sampled(n: int, of: int, seed: int) -> Column:
    """Whether a hash puts a row among about n of so many rows."""
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(min(1.0, n / max(of, 1)) * (1 << 30)))


def edges(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v, s = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return batch(u=pa.array(u, pa.int64()), v=pa.array(v, pa.int64()), s=pa.array(s, pa.float64()))


def probes(points: DataFrame, n: int) -> DataFrame:
    """A partner of similarity PROBE for about PROBES of n points; its id is -1 less the id of its point."""

    def make(batches):
        for part in batches:
            ids, vecs = [], []
            for own, dim, vec in zip(*(part.column(name).to_pylist() for name in ("id", "dim", "vec"))):
                x = rows_of(vec, 1, dim)[0]
                away = np.random.default_rng(own).normal(size=dim)
                away -= (away @ x) * x
                made = PROBE * x + np.sqrt(1 - PROBE**2) * away / np.sqrt(away @ away)
                ids.append(-1 - own)
                vecs.append(made.astype(np.float32 if len(vec) == 4 * dim else np.float64).tobytes())
            yield batch(id=pa.array(ids, pa.int64()), dim=part.column("dim"), vec=pa.array(vecs, pa.binary()))

    some = points.filter("dim > 1").filter(sampled(PROBES, n, 11))
    return some.select("id", "dim", "vec").mapInArrow(make, "id long, dim int, vec binary")


def seeds(rows: DataFrame, search: int) -> DataFrame:
    """u, v, s: the SEEDED best, and all that reach the threshold, of each row's block in each of ORDERS orders.

    Rows are ordered by the sides of random hyperplanes on which they lie, then by a hash, and cut into blocks; rows
    on the same sides fill as many blocks as they need.
    """

    def sides(batches):
        for part in batches:
            dims = part.column("dim").to_numpy()
            keys = np.zeros((part.num_rows, ORDERS), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                planes = np.random.default_rng([search, int(dim)]).normal(size=(int(dim), ORDERS * SIDES))
                above = (unit(part.column("vec").take(pa.array(at)), int(dim)) @ planes > 0).reshape(len(at), ORDERS, SIDES)
                keys[at] = above @ (1 << np.arange(SIDES, dtype=np.int64)[::-1])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, ORDERS, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "keys"])

    def compare(batches):
        for part in batches:
            ids, dims, orders = (part.column(name).to_numpy() for name in ("id", "dim", "order"))
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(orders) != 0)) + 1
            ends, found = np.unique(np.concatenate([np.arange(0, len(ids), GROUP), cuts, [len(ids)]])), []
            for a, b in zip(ends[:-1], ends[1:]):
                if b - a > 1:
                    x = unit(part.column("vec").slice(a, b - a), int(dims[a]))
                    s = x @ x.T
                    np.fill_diagonal(s, -2)
                    k = min(SEEDED, b - a - 1)
                    bar = np.minimum(np.partition(s, -k, 1)[:, -k], THRESHOLD)
                    u, v = np.nonzero(s >= bar[:, None])
                    found.append((ids[a + u], ids[a + v], s[u, v]))
            yield edges(found)

    keyed = rows.mapInArrow(sides, "id long, dim int, vec binary, keys array<long>")
    keyed = keyed.select("id", "dim", "vec", F.posexplode("keys").alias("order", "key"))
    place = ["order", "dim", "key", F.xxhash64("id", F.lit(search))]
    dealt = keyed.repartitionByRange(*place).sortWithinPartitions(*place)
    return dealt.mapInArrow(compare, "u long, v long, s double").withColumn("fresh", F.lit(True))


def nearest(found: DataFrame) -> DataFrame:
    """u, v, s, fresh, open: the NEAREST best of each u, and its links up to WIDEST; open if it has so many."""
    each = found.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    link = F.col("s") >= THRESHOLD
    kept = each.withColumn("rank", rank).filter(F.col("rank") <= WIDEST).filter((F.col("rank") <= NEAREST) | link)
    full = F.max((F.col("rank") == WIDEST) & link).over(Window.partitionBy("u"))
    return kept.withColumn("open", full).drop("rank")


def local_join(graph: DataFrame, rows: DataFrame, turn: int) -> DataFrame:
    """u, v, s of neighbours and reverse neighbours of one row that link, or improve the list of u.

    The members of a center with many reverse neighbours are dealt to several groups, by a hash that differs from round
    to round. Open rows take no part.
    """
    shut = graph.filter("open").select(F.col("u").alias("v")).distinct()
    lists = graph.filter("not open").join(shut, "v", "left_anti")
    out = lists.select(F.col("u").alias("center"), F.col("v").alias("id"), "fresh")
    back = lists.select(F.col("v").alias("center"), F.col("u").alias("id"), "fresh")
    members = out.unionByName(back).groupBy("center", "id").agg(F.max("fresh").alias("fresh"))
    sizes = members.groupBy("center").agg(F.count(F.lit(1)).alias("n"), F.max("fresh").alias("moved"))
    group = F.pmod(F.xxhash64("center", "id", F.lit(turn)), F.ceil(F.col("n") / TOGETHER))
    met = members.join(sizes.filter("moved and n > 1"), "center").select("center", group.alias("group"), "id", "fresh")
    least = F.when(F.count(F.lit(1)) >= NEAREST, F.min("s")).otherwise(-2.0)
    bars = lists.groupBy(F.col("u").alias("id")).agg(F.least(least, F.lit(THRESHOLD)).alias("bar"))
    held = met.join(rows, "id").join(bars, "id", "left").withColumn("bar", F.coalesce("bar", F.lit(-2.0)))
    groups = held.groupBy("center", "group").agg(F.collect_list(F.struct("id", "fresh", "bar", "dim", "vec")).alias("met"))

    def compare(batches):
        for part in batches:
            found = []
            for k in range(part.num_rows):
                met = part.column("met")[k].values
                if len(met) > 1:
                    ids, bar = met.field("id").to_numpy(), met.field("bar").to_numpy()
                    fresh = met.field("fresh").to_numpy(zero_copy_only=False)
                    x = unit(met.field("vec"), met.field("dim")[0].as_py())
                    s = x @ x.T
                    np.fill_diagonal(s, -3)
                    u, v = np.nonzero((s >= bar[:, None]) & (fresh[:, None] | fresh))
                    found.append((ids[u], ids[v], s[u, v]))
            yield edges(found)

    return groups.select("met").mapInArrow(compare, "u long, v long, s double").withColumn("fresh", F.lit(True))


def recalls(graph: DataFrame, rows: DataFrame, n: int) -> tuple[float, float]:
    """Recall of the probes, and mean recall of about AUDITED rows that have links; a pair with an open row counts as found."""
    links = graph.filter(F.col("s") >= THRESHOLD).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    links = links.withColumn("hit", F.lit(1))
    shut = graph.filter("open").select(F.col("u").alias("b")).distinct()
    made = rows.filter("id < 0").select(F.col("id").alias("a"), (-1 - F.col("id")).alias("b"))
    share = made.join(shut, "b", "left_anti").join(links, ["a", "b"], "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    real = rows.filter("id >= 0")
    chosen = real.filter(sampled(AUDITED, n, 13)).limit(2 * AUDITED).collect()
    by_dim = {dim: [row for row in chosen if row["dim"] == dim] for dim in {row["dim"] for row in chosen}}

    def compare(batches):
        for part in batches:
            dims, found = part.column("dim").to_numpy(), []
            for dim, some in by_dim.items():
                y, own = unit(pa.array([bytes(row["vec"]) for row in some], pa.binary()), dim), np.array([row["id"] for row in some])
                at = np.flatnonzero(dims == dim)
                for k in np.array_split(at, max(1, len(at) * len(some) // HELD)) if len(at) else []:
                    ids = part.column("id").to_numpy()[k]
                    s = y @ unit(part.column("vec").take(pa.array(k)), dim).T
                    u, v = np.nonzero((s >= THRESHOLD) & (own[:, None] != ids))
                    found.append((own[u], ids[v], s[u, v]))
            yield edges(found)

    true = real.mapInArrow(compare, "u long, v long, s double")
    for name in ("u", "v"):
        true = true.join(shut.select(F.col("b").alias(name)), name, "left_anti")
    true = true.select("u", F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).join(links, ["a", "b"], "left")
    each = true.groupBy("u").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall")).agg(F.avg("recall")).first()[0]
    return tuple(1.0 if x is None else x for x in (share, each))


def descended(points: DataFrame) -> tuple[DataFrame, bool]:
    """The neighbour graph of points as nearest() gives it, probes included, and whether the audits are satisfied."""
    n = points.count()
    plain = points.select("id", "dim", "vec")
    rows = settle(plain.unionByName(probes(points, n)), "searched")
    graph = None
    for search in range(SEARCHES):
        found = seeds(rows, search)
        graph = settle(nearest(found if graph is None else known(graph).unionByName(found)), "graph")
        for turn in range(ROUNDS):
            graph = settle(nearest(known(graph).unionByName(local_join(graph, rows, turn))), "graph")
            if graph.filter(F.col("fresh") & ~F.col("open") & (F.col("s") >= THRESHOLD)).isEmpty():
                break
        if min(recalls(graph, rows, n)) >= RECALL:
            return graph, True
    return graph, False


def known(graph: DataFrame) -> DataFrame:
    return graph.drop("open").withColumn("fresh", F.lit(False))


def placed(points: DataFrame) -> DataFrame:
    """points with block, and last: the last block of their dimension. Blocks are numbered from 0, without gaps.

    Open and other rows have blocks of their own, those of open rows first. A vector goes to its nearest pivot; what has one pivot is dealt to as many blocks as it fills, by a hash.
    """
    sizes = {row["dim"]: row["n"] for row in points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = {dim: max(1, min(n // SHARES + 1, BLOCK, BLOCK_BYTES // (4 * dim))) for dim, n in sizes.items()}
    wanted = {dim: min(PIVOTS, -(-n // most[dim])) for dim, n in sizes.items()}
    pivots: dict[int, list[bytes]] = {dim: [] for dim in sizes}
    shares = F.create_map(*[F.lit(x) for dim, n in sizes.items() for x in (dim, min(1.0, 2 * wanted[dim] / n))]) if sizes else None
    if sizes:
        place = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) / F.lit(1 << 30)
        for row in points.filter(place < shares[F.col("dim")]).select("dim", "vec").collect():
            if len(pivots[row["dim"]]) < wanted[row["dim"]]:
                pivots[row["dim"]].append(bytes(row["vec"]))
    heads = {dim: unit(pa.array(vecs, pa.binary()), dim) for dim, vecs in pivots.items() if vecs}

    def nearest_pivot(batches):
        for part in batches:
            dims, cell = part.column("dim").to_numpy(), np.zeros(part.num_rows, np.int32)
            for dim in np.unique(dims):
                if dim in heads:
                    at = np.flatnonzero(dims == dim)
                    for some in np.array_split(at, max(1, len(at) * len(heads[dim]) // HELD)):
                        cell[some] = (unit(part.column("vec").take(pa.array(some)), int(dim)) @ heads[dim].T).argmax(1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell)], [*part.schema.names, "cell"])

    schema = "id long, m long, dim int, vec binary, open boolean, cell int"
    rows = settle(points.select("id", "m", "dim", "vec", "open").mapInArrow(nearest_pivot, schema), "cells")
    found, at, cells = rows.groupBy("dim", "open", "cell").agg(F.count(F.lit(1)).alias("n")).collect(), 0, []
    for row in sorted(found, key=lambda x: (x["dim"], not x["open"], x["cell"])):
        parts = -(-row["n"] // most[row["dim"]])
        cells.append({"dim": row["dim"], "open": row["open"], "cell": row["cell"], "first": at, "parts": parts})
        at += parts
    last = {x["dim"]: x["first"] + x["parts"] - 1 for x in cells}
    placing = literal_rows(points.sparkSession, "dim int, open boolean, cell int, first int, parts int, last int", [x | {"last": last[x["dim"]]} for x in cells])
    block = F.col("first") + F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int")
    return rows.join(F.broadcast(placing), ["dim", "open", "cell"]).withColumn("block", block)


def blocks(points: DataFrame) -> DataFrame:
    """A row for each block: its number and the last of its dimension, ids, multiplicities and vectors, center and radius."""

    def pack(batches):
        for part in batches:
            for k in range(part.num_rows):
                rows, dim = part.column("rows")[k].values, part.column("dim")[k].as_py()
                x = unit(rows.field("vec"), dim)
                center = x.sum(0)
                center = center / size if (size := np.sqrt(center @ center)) > 0 else x[0]
                yield batch(
                    block=part.column("block").slice(k, 1), last=part.column("last").slice(k, 1), dim=part.column("dim").slice(k, 1),
                    open=part.column("open").slice(k, 1),
                    ids=[rows.field("id").to_numpy().tobytes()], ms=[rows.field("m").to_numpy().tobytes()],
                    vecs=pa.array([b"".join(rows.field("vec").to_pylist())], pa.binary()), center=[center.tobytes()],
                    radius=[float(np.arccos(np.clip((x @ center).min(), -1, 1)))],
                )

    rows = placed(points).groupBy("block", "last", "dim", "open").agg(F.collect_list(F.struct("id", "m", "vec")).alias("rows"))
    schema = "block int, last int, dim int, open boolean, ids binary, ms binary, vecs binary, center binary, radius double"
    return settle(rows.mapInArrow(pack, schema), "blocks")


def pairs(held: DataFrame) -> DataFrame:
    """Numbers a <= b of the blocks that links are possible between, a being one of open rows."""

    def near(batches):
        reach = np.arccos(THRESHOLD) + MARGIN
        for part in batches:
            x, y = (np.frombuffer(b"".join(part.column(name).to_pylist())).reshape(part.num_rows, -1) if part.num_rows else np.zeros((0, 1)) for name in ("center", "center_b"))
            angle = np.arccos(np.clip((x * y).sum(1), -1, 1))
            a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
            keep = (a == b) | (angle <= part.column("radius").to_numpy() + part.column("radius_b").to_numpy() + reach)
            yield batch(a=pa.array(a[keep]), b=pa.array(b[keep]))

    left = held.filter("open").select(F.col("block").alias("a"), "dim", "center", "radius", F.explode(F.sequence("block", "last")).alias("b"))
    right = held.select(F.col("block").alias("b"), F.col("center").alias("center_b"), F.col("radius").alias("radius_b"))

    def of_one_dim(batches):  # centers of one length in a batch
        for part in batches:
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims):
                yield from near([part.take(pa.array(np.flatnonzero(dims == dim)))])

    return settle(left.join(right, "b").mapInArrow(of_one_dim, "a int, b int"), "pairs")


def merged(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places is connected with by the links u, v."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        open_ = np.flatnonzero(a != b)
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def matched(points: DataFrame) -> DataFrame:
    """u, v, n: n vectors link with u in one pair of blocks (v null), or u and v are connected (n is 0).

    All links of open rows are found, and none between two others.
    """
    held = blocks(points)

    def compare(batches):
        for part in batches:
            for k in range(part.num_rows):
                yield between(*(part.column(name)[k].as_py() for name in ("dim", "a", "ids", "ms", "vecs", "b", "ids_b", "ms_b", "vecs_b")))

    def between(dim, a, ids, ms, vecs, b, ids_b, ms_b, vecs_b):
        ids, ms, ids_b, ms_b = (np.frombuffer(x, np.int64) for x in (ids, ms, ids_b, ms_b))
        x, y = rows_of(vecs, len(ids), dim), rows_of(vecs_b, len(ids_b), dim)
        n, n_b = np.zeros(len(x)), np.zeros(len(y))
        both = np.concatenate([ids, ids_b])
        label, step = np.arange(len(both)), max(1, HELD // len(y))
        for at in range(0, len(x), step):
            hit = x[at : at + step] @ y.T >= THRESHOLD
            if a == b:
                hit[np.arange(len(hit)), np.arange(at, at + len(hit))] = False
            if hit.any():
                u, v = np.nonzero(hit)
                u += at
                n += np.bincount(u, ms_b[v], len(x))
                n_b += np.bincount(v, ms[u], len(y))
                # In a block's comparison with itself both sides are the same places.
                far = v if a == b else v + len(x)
                rest = np.flatnonzero(label != np.arange(len(both)))
                label = merged(len(both), np.concatenate([u, rest]), np.concatenate([far, label[rest]]))
        counts = [(ids, n)] if a == b else [(ids, n), (ids_b, n_b)]
        who, count = (np.concatenate(c) for c in zip(*counts))
        some, tree = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(both)))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([who[some], both[tree]])),
            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(both[label[tree]])]),
            pa.array(np.concatenate([count[some], np.zeros(len(tree))]).astype(np.int64)),
        ], ["u", "v", "n"])

    a = held.select(F.col("block").alias("a"), "dim", "ids", "ms", "vecs")
    b = held.select(F.col("block").alias("b"), *[F.col(x).alias(f"{x}_b") for x in ("ids", "ms", "vecs")])
    met = pairs(held).join(a, "a").join(b, "b")
    return settle(met.mapInArrow(compare, "u long, v long, n long"), "matched")


def links_of(points: DataFrame) -> DataFrame:
    """u, v, n as matched() gives them, for all links: of open rows by matched(), of others from the neighbour lists."""
    graph, fine = descended(points)
    real = graph.filter("u >= 0 and v >= 0")
    shut = graph.filter("open and u >= 0").select(F.col("u").alias("id")).distinct().withColumn("open", F.lit(True))
    marked = points.join(shut, "id", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    if not fine:
        return matched(points.withColumn("open", F.lit(True)))
    link = real.filter(F.col("s") >= THRESHOLD).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    for name in ("u", "v"):
        link = link.join(shut.select(F.col("id").alias(name)), name, "left_anti")
    link = settle(link.select("u", "v"), "links")
    both = link.unionByName(link.select(F.col("v").alias("u"), F.col("u").alias("v")))
    counts = both.join(points.select(F.col("id").alias("v"), "m"), "v").groupBy("u").agg(F.sum("m").alias("n"))
    found = counts.select("u", F.lit(None).cast("long").alias("v"), "n").unionByName(link.withColumn("n", F.lit(0).cast("long")))
    return found if shut.isEmpty() else found.unionByName(matched(settle(marked, "marked")))


def near_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of rows (vec_id, embedding).

    A vector that is null, empty or zero, or that holds null or non-finite components, links with nothing; so do
    vectors of different lengths with each other. Rows that repeat an id with its vector count once as a link;
    different vectors of one id are searched each for itself, and a component is named by the smallest id of its vectors.
    A row without an id is linked with nothing, has no component and is kept. An empty table gives no rows; other columns
    are neither read nor returned. Links between two rows with fewer than WIDEST links each are those that NN-descent
    finds, audited as told above; links of all other rows are complete.
    """
    base = settle(stored(rows), "vectors")
    real = base.filter("vec is not null and vec_id is not null")
    classes = real.select("digest", "vec_id").distinct().groupBy("digest").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("m")
    )
    # A class has a number of its own: an id with different vectors is in several.
    classes = settle(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    points = real.select("digest", "dim", "vec").dropDuplicates(["digest"]).join(classes, "digest")
    points = settle(points.select("id", "m", "dim", "vec"), "points")
    found = links_of(points)
    others = found.filter("v is null").groupBy("u").agg(F.sum("n").alias("others"))
    tree = found.filter("v is not null").select(F.col("u").alias("a"), F.col("v").alias("b"))
    found = classes.join(others.withColumnRenamed("u", "id"), "id", "left").join(components(tree), "id", "left")
    found = found.withColumn("root", F.coalesce("component", "id"))
    least = found.groupBy("root").agg(F.min("first").alias("component"))
    found = found.drop("component").join(least, "root").select(
        "digest", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component"
    )
    out = base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(found, "digest", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
