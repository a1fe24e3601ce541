"""Links and connected groups of nodes that share buckets; DataFrame operations only.

A bucket with two nodes is a pair. In a larger one every node is first held against the bucket's smallest node, so a large
group of alike nodes costs one pair per node. What that leaves unconnected is then compared in full: in every bucket that
still spans several groups, the nodes outside its largest group meet all nodes of the other groups there. A cheap test on
the nodes' payloads, which may only refuse pairs that are not linked, is part of that join, and a pair that shares several
buckets is made in the first of them alone (without a `meeting`, the first that both keep in a short list, if there is one);
so the join makes one row for a likely pair. More pairs that a caller knows are verified with the first ones. So each two nodes that share a bucket are compared or are already in one group.

Groups are found by alternating large-star and small-star steps, which keep hold of edges only, each step written to the
shared folder. Nodes are longs; the group is named by its smallest node.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.llm.common import drop_staged, stage

Verify = Callable[[DataFrame], DataFrame]
Possible = Callable[[Column, Column], Column]


def _smallest(edges: DataFrame) -> DataFrame:
    """(c, m): the smallest neighbour of every node that has a smaller one. Stored, so that a join with it may split."""
    return stage(edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "c"), "least")


def _step(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges are (a, b) with a > b."""
    # Large star: a node's larger neighbours move to its smallest neighbour, or stay if it has no smaller one.
    least = _smallest(edges)
    moved = edges.join(least, F.col("b") == F.col("c"), "left").select("a", F.coalesce("m", "b").alias("b"))
    large = stage(moved.distinct(), "edges")
    drop_staged(least)
    # Small star: a node's smaller neighbours, and the node, move to the smallest of them.
    least = _smallest(large)
    moved = large.join(least, F.col("a") == F.col("c")).where(F.col("b") != F.col("m"))
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = stage(moved.unionByName(least.select(F.col("c").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
    drop_staged(least)
    drop_staged(large)
    return small


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, the root itself left out. `edges` holds (a, b) longs."""
    larger_first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(larger_first.where(F.col("a") != F.col("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, old = state, now
        now = _step(old)
        drop_staged(old)


def first_shared(x: list[Column], y: list[Column]) -> Column:
    """Of two nodes' buckets, listed in one order, the first that is the same; NULL if none is."""
    return F.coalesce(*[F.when(a == b, a) for a, b in zip(x, y, strict=True)])


def stars(keys: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of every node and the smallest that has a key in common; `keys` holds (node, key) rows."""
    keyed = stage(keys, "keys")
    least = stage(keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("key", "a"), "least")
    pairs = stage(keyed.join(least, "key").where(F.col("a") < F.col("node")).select("a", F.col("node").alias("b")).distinct(), "stars")
    drop_staged(keyed)
    drop_staged(least)
    return pairs


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes `roots`, as `connected` gives them, do not place in one group."""
    for node, root in (("a", "a_root"), ("b", "b_root")):
        pairs = pairs.join(roots.select(F.col("node").alias(node), F.col("root").alias(root)), node, "left")
    return pairs.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


FIRST = 8  # of a node's buckets that are kept to tell where a pair meets first


def bucket_links(
    members: DataFrame,
    payloads: DataFrame,
    possible: Possible,
    meeting: Possible | None,
    verify: Verify,
    others: DataFrame | None = None,
    later: DataFrame | None = None,
) -> DataFrame:
    """Verified edges (a, b), a < b, between nodes that share a bucket, enough to connect all that are linked.

    `members` holds (node, bucket) rows and `payloads` one (node, payload) row per node; `possible` tells from two
    payloads whether the nodes can be linked, `meeting` which of their common buckets is the first, and `verify` keeps the
    pairs (a, b) that are linked. Without `meeting`, the first of those among the FIRST smallest buckets of both counts; only
    a pair that has none there is made in every common bucket. `others` are more pairs (a, b), a < b, to verify; what they
    connect needs no pairs in the buckets. `later` are pairs (a, b), a < b, to verify if nothing has connected them by then.
    """
    sizes = members.groupBy("bucket").agg(
        F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n")
    )
    shared = stage(sizes.where(F.col("n") > 1), "buckets")
    large = shared.where(F.col("n") > 2).select("bucket", "pivot")
    crowd = stage(members.join(large, "bucket"), "members")
    pairs = (
        shared.where((F.col("n") == 2) & (F.col("pivot") != F.col("last")))
        .select(F.col("pivot").alias("a"), F.col("last").alias("b"))
        .unionByName(
            crowd.where(F.col("node") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        )
    )
    if others is not None:
        pairs = pairs.unionByName(others.select("a", "b"))
    links = stage(verify(pairs.distinct()), "links")
    # What the smallest nodes have not brought together.
    roots = connected(links)
    group = F.coalesce("root", "node").alias("group")
    placed = stage(crowd.join(roots, "node", "left").select("bucket", "node", "pivot", group), "members")
    split = (
        placed.groupBy("bucket", "group")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("groups"), F.max_by("group", F.struct("n", "group")).alias("largest"))
    )
    split = stage(split.where(F.col("groups") > 1).drop("groups"), "buckets")
    bare = stage(placed.join(split, "bucket").where(F.col("node") != F.col("pivot")).drop("pivot"), "members")
    if meeting is None:
        # A pair of these nodes meets in each bucket that both have here, whichever of them asks.
        first = F.slice(F.array_sort(F.collect_list("bucket")), 1, FIRST).alias("first")
        payloads = bare.groupBy("node").agg(first).join(payloads, "node")
        payloads = payloads.select("node", F.struct("payload", "first").alias("payload"))
    open_members = stage(bare.join(payloads, "node"), "members")
    outside = open_members.where(F.col("group") != F.col("largest")).select(
        F.col("bucket").alias("x_bucket"),
        F.col("node").alias("x"),
        F.col("group").alias("x_group"),
        F.col("payload").alias("x_payload"),
    )
    x, y = F.col("x_payload"), F.col("payload")
    if meeting is None:
        same = F.array_min(F.array_intersect(x["first"], y["first"]))
        likely, where = possible(x["payload"], y["payload"]), F.coalesce(same, F.col("bucket"))
    else:
        likely, where = possible(x, y), meeting(x, y)
    meet = (
        (F.col("x_bucket") == F.col("bucket"))
        & (F.col("x_group") != F.col("group"))
        # Of two nodes outside the largest group, the smaller one asks.
        & ((F.col("group") == F.col("largest")) | (F.col("x") < F.col("node")))
        & likely
        & (where == F.col("bucket"))
    )
    across = outside.join(open_members, meet).select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))
    if later is not None:
        across = across.unionByName(apart(later, roots))
    more = stage(verify(across.distinct()), "links")
    for used in (shared, crowd, placed, split, bare, open_members):
        drop_staged(used)
    return links.unionByName(more)
