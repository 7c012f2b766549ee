"""The prefix tree against one built in dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from meterline.llm.conversation_trie import DoubleArray, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, shard string"


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), role, digest, text))
    plain = {conv: [(role, text) for _, role, _, text in sorted(x)] for conv, x in turns.items()}
    members = defaultdict(list)
    for conv in plain:
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(np.fmod(conv, 5))
        path = tuple(plain.get(base, [])[:h] + plain[conv][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((conv, len(path)))
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, ids in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(ids) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, ids in members.items():
        ends = ",".join(str(c) for c, size in sorted(ids) if size == len(path))
        parent = min(members[path[:-1]])[0] if path else None
        out.append((
            min(ids)[0], len(path), parent, len(ids), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def same(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, prefix_trie(frame, **sizes).collect()), key=repr) == expected(rows)


def conversations():
    draw = random.Random(3)
    rows = []
    for conv in [*range(-7, 60), 1001, 1004, 2003]:
        kind = draw.choice("abc")
        for turn in range(draw.randrange(0, 12)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), f"{kind}{draw.randrange(2)} é", 9, "x"))
    rows += [(100 + k, t, "user", f"all alike {t}", 0, "") for k in range(40) for t in range(6)]  # copies
    rows += [(200 + k, t, "user", "hot" if not t else f"{k}-{t}", 0, "") for k in range(40) for t in range(3)]  # one first turn
    rows += [(301, t, None, f"long {t % 7}", 0, "") for t in range(150)] + [(300, t, None, f"long {t % 7}", 0, "") for t in range(90)]
    rows += [(400, None, None, None, 0, ""), (400, 1, "", "", 0, ""), (400, 1, "", "", 0, ""), (401, 5, "b", "x", 0, ""), (401, 5, "a", "y", 0, "")]
    rows += [(402, 2, "ab", "c", 0, ""), (403, 2, "a", "bc", 0, ""), (None, 1, "user", "nobody's", 0, "")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"stretch": 4, "room": 16, "run": 5}, {"stretch": 1, "room": 3, "run": 1}])
def test_nodes(spark, sizes):
    same(spark, conversations(), **sizes)


def test_repeated_and_empty(spark):
    rows = [(5, 0, "user", "again", 0, "")] * 30 + [(6, 0, "user", "again", 0, "")] * 3
    same(spark, rows, stretch=4, room=8, run=3)
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    same(spark, [(1, 0, "user", "one", 0, "")])  # no conversation 0, so the turn is gone and only the root stays


def test_double_array():
    draw = np.random.default_rng(2)
    tree, known = DoubleArray(16), {(): 0}
    level = [()]
    for _ in range(4):
        parents, symbols = [], []
        for path in level:
            for t in draw.choice(50, draw.integers(1, 9), replace=False):
                parents.append(known[path])
                symbols.append((int(t), path))
        pairs = sorted(zip(parents, (t for t, _ in symbols), (p for _, p in symbols)))
        tree.add(np.array([p for p, _, _ in pairs]), np.array([t for _, t, _ in pairs]))
        at = tree.child(np.array([p for p, _, _ in pairs]), np.array([t for _, t, _ in pairs]))
        assert (at > 0).all()
        known |= {(*path, t): int(x) for (_, t, path), x in zip(pairs, at)}
        level = [(*path, t) for _, t, path in pairs]
    assert len(set(known.values())) == len(known)  # every node has a place of its own
    for path, place in known.items():
        for t in range(50):
            assert tree.child(np.array([place]), np.array([t]))[0] == known.get((*path, t), -1)
