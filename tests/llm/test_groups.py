from __future__ import annotations

import random

from pyspark.sql import functions as F

from peernet.llm.groups import apart, bucket_links, connected, stars


def roots_by_force(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {(x, find(x)) for x in root if find(x) != x}


def test_groups_of_chains_stars_and_random_edges(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)] + [(50, 159)]
    mixed = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    edges = chain + star + mixed
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == roots_by_force(edges)
    assert len(found) == len({r.node for r in found})


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_bucket_whose_smallest_node_is_like_no_other(spark):
    # Linked: 5-6, 6-7, 8-9; the smallest node, 1, meets all and is linked with none.
    linked = {(5, 6), (6, 7), (8, 9)}
    members = spark.createDataFrame([(n, 1) for n in (1, 5, 6, 7, 8, 9)] + [(20, 2), (21, 2)], "node long, bucket long")
    pairs = spark.createDataFrame(list(linked | {(20, 21)}), "a long, b long")
    payloads = members.select("node", (F.col("node") % 10).alias("payload")).distinct()
    refused = lambda x, y: F.abs(x - y) <= 1  # noqa: E731  true of all linked pairs
    bucket = lambda x, y: F.when(F.greatest(x, y) >= 0, F.lit(1).cast("long"))
    links = bucket_links(members, payloads, refused, bucket, lambda p: p.join(pairs, ["a", "b"]))
    assert {(r.a, r.b) for r in links.collect()} == linked | {(20, 21)}


def test_others_that_connect_a_crowd_leave_its_bucket_few_pairs(spark):
    # In each of ten buckets, 40 nodes that are all alike stand with a smaller one that is like none of them.
    members = spark.range(4, 44).withColumnRenamed("id", "node").union(spark.range(1, 2))
    members = members.crossJoin(spark.range(10).withColumnRenamed("id", "bucket"))
    payloads = members.select("node", F.col("node").alias("payload")).distinct()
    others = spark.createDataFrame([(4, n) for n in range(5, 44)], "a long, b long")
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs.where("a > 1")

    alike = lambda x, y: F.least(x, y) > 0
    links = bucket_links(members, payloads, alike, None, verify, others)
    assert {(r.node, r.root) for r in connected(links).collect()} == {(n, 4) for n in range(5, 44)}
    assert asked == [40 + 39, 0]


def test_a_pair_meets_in_one_bucket_or_in_all(spark):
    # 2 and 3 share buckets past the first ones of 2, 3 and 4 share their first ones; 1 is in all and like none.
    buckets = {1: range(40), 2: range(20), 3: range(12, 40), 4: range(10, 40)}
    members = spark.createDataFrame([(n, b) for n, own in buckets.items() for b in own], "node long, bucket long")
    payloads = members.select("node", F.col("node").alias("payload")).distinct()
    linked = spark.createDataFrame([(2, 3), (3, 4)], "a long, b long")
    alike = lambda x, y: F.least(x, y) > 0
    links = bucket_links(members, payloads, alike, None, lambda p: p.join(linked, ["a", "b"]))
    assert sorted((r.a, r.b) for r in links.collect()) == [(2, 3), (3, 4)]


def test_stars_hold_every_node_against_the_smallest_of_its_keys(spark):
    keys = spark.createDataFrame([(5, 1), (7, 1), (7, 1), (9, 1), (7, 2), (9, 2), (3, 3), (5, 4), (9, 4)], "node long, key long")
    assert sorted((r.a, r.b) for r in stars(keys).collect()) == [(5, 7), (5, 9), (7, 9)]


def test_later_pairs_are_verified_if_nothing_connects_them(spark):
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, bucket long")
    payloads = members.select("node", F.col("node").alias("payload"))
    later = spark.createDataFrame([(1, 3), (2, 3), (3, 9), (9, 10)], "a long, b long")
    asked = []

    def verify(pairs):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return pairs.where("b < 10")

    links = bucket_links(members, payloads, lambda x, y: F.lit(True), None, verify, None, later)
    assert {(r.node, r.root) for r in connected(links).collect()} == {(2, 1), (3, 1), (9, 1)}
    assert asked == [{(1, 2), (1, 3)}, {(3, 9), (9, 10)}]
    assert apart(later, connected(links)).collect() == [(9, 10)]
