"""Near-duplicate texts by a chosen-path set similarity join over minwise tokens.

A text's set are its distinct shingles of WIDTH words. Texts with equal sets form one class from the start. For the
rest, TREES independent trees are grown over all sets: a node sends each of its sets on to children named by
the set's minwise token at coordinates that the node chooses, so similar sets tend to meet in the same
children. A node is compared exhaustively once it is small, that is, once it holds few pairs of sets whose classes are not
yet known to be linked; until then it branches. In a first round each set is compared with LEADERS sets of each node only, which
links families of near copies at a cost in proportion to their size; afterwards such families count as one class.
Each tree's node draws its leaders anew, so a member of a family meets many others although its node compares few.

A pair of sets with the least similarity shares a tree's first token with probability 0.75, and then, where nodes are crowded, survives any
number of branchings into CHOICES children of STEP tokens each with probability 0.865, so TREES trees miss it with probability
(1 - 0.649) ** TREES, about 5e-8, if the tokens of each branching were fresh. All draw from the same 48 tokens, so by
calculation, not measured, a pair at the threshold is missed with probability 2e-7 after one branching, 7e-6 after two,
1.3e-4 after four, 4.6e-4 after six and 1.5e-3 after ten; small nodes do not branch. Pairs whose MINS minwise tokens agree
at fewer than AGREE places are not compared; that happens to a pair with the least similarity with probability below 1e-7.
Every link is confirmed on the full sets, inside the node, and a node's parts answer with links that connect, never
with pairs that may link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, batches_of, by_segment, mapped, mix, rolling, settle, slices, text_bytes, text_rows, word_bounds
from .components import components

WIDTH = 5
#: Similarity: 100 * intersection >= PERCENT * union.
PERCENT = 75
MINS, TREES = 64, 16
#: Sets of a node that all its sets are compared with in the first round.
LEADERS = 2
#: Children that a crowded node sends each of its sets to, and tokens that name a child.
CHOICES, STEP = 3, 2
AGREE = 29
#: A node is small if it has at most so many pairs of different classes for each member. Comparing the tokens of so many
#: pairs in a task costs less than the rows that branching shuffles for one member.
SMALL = 2048
#: Members of a part of a node at most, on average, and tokens of their full sets.
BLOCK, TOKENS = 1024, 1 << 21
#: Bytes of text that a task shingles at once; its arrays take some twenty times as much.
TEXT_BYTES = 1 << 20
#: Largest Arrow batch; a batch of nodes with their parts would fill Spark's 64 MB in each task, on both sides.
BATCH = "4MB"
#: Bits of the fixed-size filter that says which texts may be needed again.
FILTER_BITS = 1 << 24


def shingles(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of each text, in order within the text, and where each text's begin (and end).

    A text with fewer than WIDTH words has its whole sequence as one shingle; one without words has none.
    """
    data = LOWER[data]
    start, end, first = word_bounds(data, ends)
    words = rolling(data)(start, end)
    n = np.diff(first)
    count = np.where(n >= WIDTH, n - WIDTH + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), count)
    bounds = np.concatenate([[0], np.cumsum(count)])
    begin = first[:-1][owner] + np.arange(bounds[-1]) - bounds[:-1][owner]
    length = np.minimum(n, WIDTH)[owner]
    code = length.astype(np.uint64)
    for k in range(WIDTH):
        word = words[np.minimum(begin + k, len(words) - 1)] if len(words) else words
        code = np.where(k < length, mix(code * np.uint64(0x9E3779B97F4A7C15) + word), code)
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    code, owner = code[fresh], owner[fresh]
    return code, np.searchsorted(owner, np.arange(len(n) + 1))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), key_a and key_b (of the whole set), mins (MINS minwise tokens) of every row."""
    seeds = np.random.default_rng(29).integers(1, 1 << 63, (2, MINS), np.uint64)

    def sign(part: pa.RecordBatch) -> pa.RecordBatch:
        code, bounds = shingles(*text_bytes(part.column("text")))
        keys = [by_segment(np.add, mix(code ^ np.uint64(s)), bounds, np.uint64(0)).view(np.int64) for s in (3, 5)]
        mins = np.zeros((part.num_rows, MINS), np.int32)
        for k in range(MINS):
            token = (code ^ seeds[0, k]) * (seeds[1, k] | np.uint64(1))
            least = by_segment(np.minimum, token, bounds, np.uint64(0))
            mins[:, k] = mix(least).view(np.int64).astype(np.int32)
        lists = pa.ListArray.from_arrays(np.arange(0, mins.size + 1, MINS, dtype=np.int32), mins.ravel())
        return pa.RecordBatch.from_pydict({
            "doc_id": part.column("doc_id"), "n": pa.array(np.diff(bounds).astype(np.int64)),
            "key_a": pa.array(keys[0]), "key_b": pa.array(keys[1]), "mins": lists,
        })

    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return mapped(rows, sign, "doc_id long, n long, key_a long, key_b long, mins array<int>", TEXT_BYTES)


def likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The different pairs (a, b) that sizes and minwise tokens leave possible."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("mins").alias(f"mins_{name}"))

    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    met = ordered.join(side("a"), "a").join(side("b"), "b")
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    same = F.size(F.filter(F.zip_with("mins_a", "mins_b", lambda x, y: x == y), lambda x: x))
    return met.filter(near & (same >= AGREE)).select("a", "b")


def possible(ids: DataFrame) -> np.ndarray:
    """A bit for each hash of an id, of a fixed size; sent to every task, it spares the shuffle of all texts."""
    slots = ids.select(F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("slot"))
    bits = slots.groupBy(F.expr("cast(slot div 64 as int)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")
    )
    found = bits.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def full_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """id, codes (the whole set, as bytes) of the texts with these ids; only such texts are shingled again."""
    bits = possible(ids)

    def full(batches):
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((bits[slot >> 6] >> (slot & 63)) & 1 == 1))
            for part in slices([batch], limit=TEXT_BYTES):
                code, bounds = shingles(*text_bytes(part.column("text")))
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("doc_id"),
                    "codes": pa.array([code[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary()),
                })

    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    rows = text_rows(docs.filter("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long")))
    return settle(rows.withColumn("slot", slot).mapInArrow(full, "id long, codes binary"), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sets = full_sets(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), docs)

    def compare(batches):
        last, held = None, None
        for part in slices(batches, "codes_b"):
            keep = []
            for a, x, y in zip(part.column("a").to_pylist(), part.column("codes_a"), part.column("codes_b")):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                if a != last or len(held) != len(x):
                    last, held = a, x.copy()
                same = np.intersect1d(held, y, assume_unique=True).size
                keep.append(100 * same >= PERCENT * (len(held) + len(y) - same))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(sets.toDF("a", "codes_a"), "a").join(sets.toDF("b", "codes_b"), "b")
    return settle(met.mapInArrow(compare, "a long, b long"), "links")


def linked(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that join all ids of sets (id, n, mins) that links between them connect.

    From level to level the links found are replaced by one from each class's smallest id to each other member.
    """
    roots = sets.select("id", "n", F.posexplode(F.slice("mins", 1, TREES)).alias("tree", "token"))
    members = crowded(roots.select(F.xxhash64("tree", "token").alias("node"), "tree", "id", "n"))
    drawn = [F.min(F.struct(F.xxhash64("node", "id", F.lit(k)).alias("h"), "id"))["id"] for k in range(LEADERS)]
    leaders = members.groupBy("node").agg(F.array(*drawn).alias("leaders"))
    stars = members.join(leaders, "node").select(F.explode("leaders").alias("a"), F.col("id").alias("b"))
    links = confirmed(settle(likely(stars, sets), "stars"), docs)
    done = None
    while members is not None:
        # Linked sets count as one class from one level to the next.
        classes = components(links)
        links = classes.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
        inside = settle(judged(members, classes), "inside")
        root = done is None
        if root:
            bit = F.expr("shiftleft(1, tree)")
            done = settle(inside.filter("small").groupBy("id").agg(F.bit_or(bit).alias("done")), "done")
        links = links.unionByName(exhaustive(inside.filter("small"), done, sets, root, docs))
        large = inside.filter("not small").select("node", "tree", "id", "n")
        members = None if large.isEmpty() else crowded(
            large.join(sets.select("id", "mins"), "id").select(F.explode(F.array(*children())).alias("node"), "tree", "id", "n")
        )
    return links


def crowded(members: DataFrame) -> DataFrame:
    """The members of nodes with more than one."""
    full = members.groupBy("node").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("node")
    return settle(members.distinct().join(full, "node"), "members")


def judged(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the nodes that hold several classes, with their class, the node's largest one, whether it is small, and
    the parts it is compared in."""
    members = members.join(classes, "id", "left").select("node", "tree", "id", "n", F.coalesce("component", "id").alias("class"))
    each = members.groupBy("node", "class").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    nodes = each.groupBy("node").agg(
        F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("within"), F.sum("n").alias("tokens"),
        F.max(F.struct("m", "class"))["class"].alias("large"),
    )
    crossing = (F.col("m") * F.col("m") - F.col("within")) / 2
    nodes = nodes.filter("m * m > within").withColumn("small", crossing <= SMALL * F.col("m"))
    parts = F.ceil(F.greatest(F.col("m") / F.lit(BLOCK), F.col("tokens") / F.lit(TOKENS))).cast("long").alias("parts")
    return members.join(nodes.select("node", "small", "large", parts), "node")


def exhaustive(small: DataFrame, done: DataFrame, sets: DataFrame, root: bool, docs: DataFrame) -> DataFrame:
    """Links (a, b) of small nodes between sets of which one at least is outside the node's largest class.

    The sets outside the largest class are at most 4 * SMALL. Their tokens travel as one array to the node's members, which
    come in parts; the answer are the members that some other may be linked with, not the pairs. The full sets of these
    meet, part by part, and are compared there; of each pair of parts only links leave that connect sets not yet connected
    in it. A pair that meets in several small root nodes is taken from the first one only (done says in which trees a
    set's root node is small); in other nodes it is left out then.
    """
    part = F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
    rows = small.join(sets.select("id", "mins"), "id").join(done, "id", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    rows = settle(rows.select("node", "tree", "large", "id", "class", "n", "done", "mins", part), "compared")
    own = F.struct("id", "class", "n", "done", "part", "mins")
    blocks = rows.groupBy("node", "tree", "large", "part").agg(F.collect_list(own).alias("block"))
    others = rows.filter(F.col("class") != F.col("large")).groupBy("node").agg(F.collect_list(own).alias("others"))
    met = blocks.join(others, "node").select("node", "tree", "large", "block", "others")

    def survivors(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                node, tree, large = (batch.column(name)[k].as_py() for name in ("node", "tree", "large"))
                x, y = (_columns(batch.column(name)[k].values) for name in ("block", "others"))
                left = {}
                for at in range(0, len(y["id"]), 64):
                    z = {name: values[at : at + 64] for name, values in y.items()}
                    keep = may_link(x, z, tree, large, root)
                    for far in np.unique(z["part"]):
                        a, b = left.setdefault(int(far), (np.zeros(len(x["id"]), bool), np.zeros(len(y["id"]), bool)))
                        hit = keep[:, z["part"] == far]
                        a |= hit.any(1)
                        b[at + np.flatnonzero(z["part"] == far)] = hit.any(0)
                for far, sides in left.items():
                    for side, (held, some) in enumerate(zip((x, y), sides)):
                        at = np.flatnonzero(some)
                        if len(at):
                            yield pa.RecordBatch.from_pydict({
                                "node": [node] * len(at), "tree": pa.array([tree] * len(at), pa.int32()), "large": [large] * len(at),
                                "near": pa.array([int(x["part"][0])] * len(at), pa.int64()), "far": pa.array([far] * len(at), pa.int64()),
                                "side": pa.array([side] * len(at), pa.int32()), "id": held["id"][at], "class": held["class"][at],
                                "n": held["n"][at], "done": pa.array(held["done"][at].astype(np.int32)),
                                "mins": pa.array([row.tobytes() for row in held["mins"][at]], pa.binary()),
                            })

    schema = "node long, tree int, large long, near long, far long, side int, id long, class long, n long, done int, mins binary"
    left = settle(met.mapInArrow(survivors, schema), "survivors")
    sets_of = full_sets(left.select("id").distinct(), docs)

    def forest(group: pa.Table) -> pa.Table:
        tree, large = group.column("tree")[0].as_py(), group.column("large")[0].as_py()
        sides = []
        for side in (0, 1):
            some = group.filter(pa.compute.equal(group.column("side"), side))
            x = {name: some.column(name).to_numpy() for name in ("id", "class", "n", "done")}
            x["mins"] = np.frombuffer(b"".join(some.column("mins").to_pylist()), np.int32).reshape(-1, MINS)
            sides.append((x, [np.frombuffer(c, np.uint64) for c in some.column("codes").to_pylist()]))
        pairs = connecting(*sides, tree, large, root)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    met = left.join(sets_of, "id")
    return settle(met.groupBy("node", "near", "far").applyInArrow(forest, "a long, b long"), "links")


def may_link(x: dict, z: dict, tree: int, large: int, root: bool) -> np.ndarray:
    """For each set of x and each of z: whether this node has to compare them, and tokens and sizes leave a link possible."""
    same = x["mins"][:, None, :] == z["mins"][None, :, :]
    shared = (same[:, :, :TREES] @ (1 << np.arange(TREES))) & x["done"][:, None]
    keep = (shared & -shared) == (1 << tree) if root else shared == 0
    keep &= same.sum(2) >= AGREE
    keep &= x["class"][:, None] != z["class"][None, :]
    keep &= (x["class"] == large)[:, None] | (x["id"][:, None] < z["id"][None, :])
    low = np.minimum(x["n"][:, None], z["n"][None, :])
    return keep & (100 * low >= PERCENT * np.maximum(x["n"][:, None], z["n"][None, :]))


def connecting(side_x: tuple, side_z: tuple, tree: int, large: int, root: bool) -> np.ndarray:
    """Links between the sets of two sides that connect all that is connected by links between them, as rows of two ids."""
    (x, codes_x), (z, codes_z) = side_x, side_z
    if not len(codes_x) or not len(codes_z):
        return np.zeros((0, 2), np.int64)
    ids, place = np.unique(np.concatenate([x["id"], z["id"]]), return_inverse=True)
    place_x, place_z = place[: len(codes_x)], place[len(codes_x) :]
    label, out = np.arange(len(ids)), []
    tokens = np.unique(np.concatenate(codes_z))
    flat = np.searchsorted(tokens, np.concatenate(codes_z))
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in codes_z])])
    mark = np.zeros(len(tokens), bool)
    for at in range(0, len(codes_x), 64):
        some = {name: values[at : at + 64] for name, values in x.items()}
        keep = np.concatenate([may_link(some, {n: v[k : k + 64] for n, v in z.items()}, tree, large, root) for k in range(0, len(codes_z), 64)], 1)
        for k in np.flatnonzero(keep.any(1)):
            own = codes_x[at + k]
            near = np.searchsorted(tokens, own)
            near = near[near < len(tokens)]
            near = near[np.isin(tokens[near], own, assume_unique=True)]
            mark[near] = True
            common = np.add.reduceat(mark[flat].astype(np.int64), bounds[:-1])
            mark[near] = False
            hit = np.flatnonzero(keep[k] & (100 * common >= PERCENT * (len(own) + np.diff(bounds) - common)))
            for h in hit:
                a, b = label[place_x[at + k]], label[place_z[h]]
                if a != b:
                    out.append((ids[place_x[at + k]], ids[place_z[h]]))
                    label[label == b] = a
    return np.array(out, np.int64).reshape(-1, 2)


def _columns(rows: pa.StructArray) -> dict[str, np.ndarray]:
    out = {name: rows.field(name).to_numpy() for name in ("id", "class", "n", "done", "part")}
    return out | {"mins": rows.field("mins").flatten().to_numpy().reshape(len(rows), MINS)}


def children() -> list[Column]:
    """Names of the children that a set goes to: the node chooses coordinates beyond those of the trees' first tokens."""
    room, names = MINS - TREES, []
    for child in range(CHOICES):
        at = F.pmod(F.xxhash64("node", F.lit(2 * child)), F.lit(room)).cast("int")
        skip = F.pmod(F.xxhash64("node", F.lit(2 * child + 1)), F.lit(room // STEP)).cast("int") + 1
        places = [F.pmod(at + skip * k, F.lit(room)) + TREES + 1 for k in range(STEP)]
        names.append(F.xxhash64("node", *[x for place in places for x in (place, F.element_at("mins", place))]))
    return names


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs.

    A null text or one without words has no shingles and is linked with nothing. Rows of the same id count as one
    document: what is linked to one is linked to all. A row without an id is linked with nothing, has no component
    and is kept. An empty table gives no rows; other columns are neither read nor returned.
    """
    with batches_of(docs.sparkSession, BATCH):
        signed = settle(signatures(docs), "signed")
        real = signed.filter("n > 0 and doc_id is not null")
        keys = settle(real.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("id")), "keys")
        chosen = real.withColumn("id", F.col("doc_id")).join(keys, ["key_a", "key_b", "id"], "left_semi")
        sets = settle(chosen.dropDuplicates(["id", "key_a", "key_b"]).select("id", "n", "mins"), "reps")
        links = linked(sets, docs)
        copies = real.select("key_a", "key_b", "doc_id").distinct().join(keys, ["key_a", "key_b"])
        copies = copies.filter("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
        members = components(links.unionByName(copies))
    found = signed.select("doc_id", "n").join(members.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
