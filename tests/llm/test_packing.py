"""Packing against a plain best-fit search over lists."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from peernet.llm.packing import measured, pack_documents, pack_shard


def by_force(rows, capacity):
    """The tightest compatible bin of all bins, for pieces by decreasing length."""
    pieces = []
    for n, (doc, length, source, cluster) in enumerate(rows):
        for p in range(-(-length // capacity)):
            pieces.append((min(capacity, length - p * capacity), n, p, doc, source, cluster))
    pieces.sort(key=lambda x: -x[0])
    bins, out = [], []
    for size, _, p, doc, source, cluster in pieces:
        fits = [
            (b["room"], i)
            for i, b in enumerate(bins)
            if b["room"] >= size
            and (source is None or source not in b["sources"])
            and (cluster is None or cluster not in b["clusters"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        b = bins[i]
        out.append((doc, p, i, capacity - b["room"], size))
        b["room"] -= size
        b["sources"].add(source)
        b["clusters"].add(cluster)
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 200])
    rows = [
        (i, rng.choice([1, 2, 3, 7, 20, 60, 150, 450]), rng.choice([None, *"abcdefg", *["hot"] * 8]), rng.choice([None, *range(300)]))
        for i in range(400)
    ]
    rows = [(d, n, s, None if c is None else f"c{c}") for d, n, s, c in rows]
    frame = pd.DataFrame(rows, columns=["doc_id", "length", "source", "cluster"])
    found = pack_shard(frame, capacity)
    assert sorted(found.itertuples(index=False, name=None)) == by_force(rows, capacity)


def test_bins_hold_what_they_may(spark, sf_dir):
    docs = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    facts = {r.doc_id: r for r in docs.collect()}
    capacity, bins, total = 512, {}, {}
    for r in pack_documents(docs, capacity, shard_rows=60).collect():
        bins.setdefault(r.bin_id, []).append(r)
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {d: f.length for d, f in facts.items()}
    for rows in bins.values():
        end = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == end
            end += r.length
        assert end <= capacity
        sources, clusters = ([getattr(facts[r.doc_id], c) for r in rows] for c in ("source", "cluster"))
        assert len(set(sources)) == len(rows)
        known = [c for c in clusters if c is not None]
        assert len(set(known)) == len(known)


def test_odd_rows(spark):
    rows = [(1, None, "a", "x"), (2, 0, "a", "x"), (None, 5, "a", "x"), (3, 5, None, None), (3, 5, None, None), (4, 25, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, length long, source string, cluster string").selectExpr("*", "1 AS shard", "2 AS bin_id")
    found = sorted((tuple(r) for r in pack_documents(docs, 10).collect()), key=repr)
    unplaced = [(1, 0, None, None, 0), (2, 0, None, None, 0), (None, 0, None, None, 0)]
    assert [r for r in found if r[2] is None] == sorted(unplaced, key=repr)
    assert sorted(r[4] for r in found if r[0] == 4) == [5, 10, 10]
    assert [r[4] for r in found if r[0] == 3] == [5, 5]
    assert pack_documents(docs.where("doc_id = 9"), 10).collect() == []


def test_a_long_document_fills_bins_alone(spark):
    docs = spark.createDataFrame([(1, 10_005, "a", "x"), (2, 3, "b", "y")], "doc_id long, length long, source string, cluster string")
    found = pack_documents(docs, 10).collect()
    assert sum(r.length for r in found) == 10_008 and len({r.bin_id for r in found}) == 1001
