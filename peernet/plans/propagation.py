"""fact_hash: in which order nodes and peers announced each later confirmed hash, and by how much the first one won."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.functions.arrays import index_of
from peernet.functions.scalars import bytes_to_hex, nanos_between
from peernet.operators.confirmation import explode_hashes, hash_messages, preconfirmation_join


def recent_from(cfg: RunConfig) -> str:
    """A week before the run, as text, so that it reaches the scans as a literal."""
    week_ago = datetime.fromisoformat(cfg.as_of) - timedelta(weeks=1)
    return week_ago.isoformat(sep=" ")


def recent_messages(feed: DataFrame, cfg: RunConfig) -> DataFrame:
    """Hash messages of the last week, with the peer id as bytes."""
    return (
        hash_messages(feed)
        .where(F.col("msg_timestamp") > ntz(recent_from(cfg)))
        .select("node_id", F.unhex("peer_id").alias("peer_id"), "msg_timestamp", "msg_data")
    )


def announcement_orders(confirmed: DataFrame) -> DataFrame:
    """Per hash: the first two sightings, the number of peers, and the three aligned arrays without repeated pairs.

    Repeats of a (node, peer) pair are cut to two before anything is collected: the first is the one the arrays keep,
    the second can only matter as the runner-up. So what is collected per hash is bounded by the pairs that exist,
    as the result itself is. Equal times are ordered by node, then peer.
    """
    pair = Window.partitionBy("tx_hash", "node_id", "peer_id").orderBy("msg_timestamp")
    twice = confirmed.withColumn("nth", F.row_number().over(pair)).where(F.col("nth") <= 2)
    sighting = F.struct(F.col("msg_timestamp").alias("ts"), F.col("node_id").alias("node"),
                        F.col("peer_id").alias("peer"), "nth", "copies")
    ordered = twice.groupBy("tx_hash").agg(F.array_sort(F.collect_list(sighting)).alias("seen"))
    first = F.get("seen", F.lit(0))
    second = F.when(first["copies"] > 1, first).otherwise(F.get("seen", F.lit(1)))
    once = F.filter("seen", lambda s: s["nth"] == 1)
    return ordered.select(
        "tx_hash",
        first["peer"].alias("first_peer"),
        first["ts"].alias("first_seen_at"),
        second["ts"].alias("second_seen_at"),
        first["node"].alias("first_node"),
        second["node"].alias("second_node"),
        F.size(F.array_distinct(once["peer"])).alias("seen_by_count"),
        once["ts"].alias("msg_timestamps"),
        once["node"].alias("msg_node_order"),
        once["peer"].alias("msg_peer_order"),
    )


def fact_hash(feed: DataFrame, transactions: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per confirmed hash and message of its first peer at its first time (to any node)."""
    messages = recent_messages(feed, cfg)
    announced = explode_hashes(messages, "node_id", "peer_id", "msg_timestamp").select(
        "tx_hash", "node_id", "peer_id", "msg_timestamp"
    )
    orders = announcement_orders(preconfirmation_join(announced, transactions, "inner", cfg, after=recent_from(cfg)))
    first_messages = messages.select(
        F.col("msg_timestamp").alias("first_seen_at"), F.col("peer_id").alias("first_peer"), "msg_data"
    )
    blocks = transactions.select("tx_hash", F.col("blk_timestamp").alias("confirmed_at"), "tx_from")
    margin = nanos_between(F.col("first_seen_at"), F.col("second_seen_at"))
    # The transactions join comes first: the orders are already partitioned by hash.
    return (
        orders.join(blocks, "tx_hash", "left")
        .join(first_messages, ["first_seen_at", "first_peer"], "inner")
        .select(
            "tx_hash",
            "first_peer",
            "confirmed_at",
            "first_seen_at",
            "second_seen_at",
            "first_node",
            "second_node",
            "seen_by_count",
            margin.alias("win_margin_nano"),
            (margin / F.lit(1_000_000_000)).alias("win_margin_sec"),
            F.size("msg_data").alias("first_msg_hash_count"),
            index_of(bytes_to_hex(F.col("tx_hash")), F.transform("msg_data", F.lower)).alias("first_msg_hash_index"),
            "msg_timestamps",
            "msg_node_order",
            "msg_peer_order",
            "tx_from",
        )
    )
