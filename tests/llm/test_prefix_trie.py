"""The prefix trie against a plain trie, whole in containers, all in heads, and in between."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from peernet.llm import prefix_trie as module
from peernet.llm.prefix_trie import prefix_trie, running, sweep
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"


def by_force(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            md5 = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, md5, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    out = []
    for path, who in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) > len(p) and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(children), len(leaves), saved, digest))
    return sorted(out, key=repr)


def conversations(seed: int, n: int = 70):
    rng = random.Random(seed)
    said = ["", "a", "bb", "ccc", "ünï", None]
    rows = []
    for c in [*rng.sample(range(-150, 450), n), 0, 100, 200]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(said)))
    # Copies, a chain, ties in turn, a turn without number, rows without conversation, repeated rows.
    rows += [(1000 + c, t, "user", "same") for c in range(40) for t in range(4)]
    rows += [(2000, t, "user", "again") for t in range(60)] + [(2001, t, "user", "again") for t in range(55)]
    rows += [(7001, 1, "x", "p"), (7001, 1, "x", "q"), (7001, None, "x", "first"), (None, 1, "x", "y"), (7002, 3, "r", "t"), (7002, 3, "r", "t")]
    return rows


@pytest.mark.parametrize("limit", [0, 3, 25, 150, 10_000])
def test_against_a_plain_trie(spark, limit):
    rows = conversations(limit)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "'x' AS id", "2 AS len").repartition(3)
    found = sorted(map(tuple, prefix_trie(frame, container_rows=limit).collect()), key=repr)
    assert found == by_force(rows)


def test_chunks_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 7)
    rows = conversations(9)
    found = sorted(map(tuple, prefix_trie(spark.createDataFrame(rows, SCHEMA), container_rows=20).collect()), key=repr)
    assert found == by_force(rows)


def test_running_sums_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 10)
    rows = [(c, p, (p * 37 + c) % 101) for c in (1, 2) for p in range(1, 95)]
    frame = spark.createDataFrame(rows, "conv long, pos long, v long")
    found = running(frame, F.col("pos"), {"s": ("sum", F.col("v")), "x": ("xor", F.col("v"))})
    state = {(c, 0): (0, 0) for c in (1, 2)}
    for c, p, v in rows:
        s, x = state[c, p - 1]
        state[c, p] = (s + v, x ^ v)
    assert all((r.s, r.x) == state[r.conv, r.pos] for r in found.collect())


def test_sweep_of_one_container():
    a, b, c = (bytes([i]) * 16 for i in (1, 2, 3))
    out = sweep([(a + b, 5, [1, 10]), (a + b, 3, [1, 10]), (a + c, 4, [1, 7]), (a, 9, [1])], 2, 0)
    found = {(r[1], r[0]): r[2:7] for r in out}
    assert found == {(2, 3): [0, 4, 2, 2, 3 + 10], (3, 3): [3, 2, 0, 1, 10], (3, 4): [3, 1, 0, 1, 0]}


def test_empty_table(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []
