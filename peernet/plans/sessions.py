"""fact_peer_session: sessions with what the peer said in its handshake, where it is, and what crawlers know of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import GENESIS_HASH, HANDSHAKE, MAINNET, NODE_TRACKER, PEER_ADD, RunConfig, ntz
from peernet.functions.scalars import (
    address_host,
    address_port,
    bytes_to_hex,
    client_os,
    client_runtime,
    client_type,
    client_version,
    null_greatest,
    time_bucket,
    unquote,
)
from peernet.operators.geo import geoip_enrich
from peernet.operators.relational import first_per_minute
from peernet.operators.sessions import PAIR, late_durations, sessionize
from peernet.operators.skew import HotKeys, hot_key_sets, salted_join

LOOK_BACK = "interval 14 hours"


def _feed_since(feed: DataFrame, kind: str, since: str | None) -> DataFrame:
    return feed.where((F.col("msg_timestamp") > ntz(since) - F.expr(LOOK_BACK)) & (F.col("msg_type") == kind))


def hot_session_keys(feed: DataFrame, since: str | None, cfg: RunConfig) -> dict[str, HotKeys]:
    """Hot head blocks, addresses and peers of the messages that sessions are made of, in one pass over them."""
    kind, part = F.col("msg_type"), lambda i: F.get("msg_data", F.lit(i))
    messages = feed.where((F.col("msg_timestamp") > ntz(since) - F.expr(LOOK_BACK)) & kind.isin(HANDSHAKE, NODE_TRACKER, PEER_ADD))
    keys = {
        "head_block_hash": ([part(3)], kind == HANDSHAKE),
        "local_block_hash": ([part(4)], kind == HANDSHAKE),
        "peer_ip": ([address_host(part(4))], kind == NODE_TRACKER),
        "peer_id": ([F.col("peer_id")], (kind == PEER_ADD) & (F.col("msg_timestamp") > ntz(since))),
    }
    return hot_key_sets(messages, keys, cfg)


def handshakes(feed: DataFrame, since: str | None) -> DataFrame:
    """Main-net handshakes with the head the peer reports and the local one."""
    return (
        _feed_since(feed, HANDSHAKE, since)
        .select(
            *PAIR,
            "msg_timestamp",
            F.get("msg_data", F.lit(0)).cast("int").alias("network"),
            F.get("msg_data", F.lit(2)).alias("genesis_block"),
            F.get("msg_data", F.lit(3)).alias("head_block_hash"),
            F.get("msg_data", F.lit(4)).alias("local_block_hash"),
        )
        .where((F.col("network") == MAINNET) & (F.col("genesis_block") == GENESIS_HASH))
    )


def sync_gap(
    feed: DataFrame, block_header: DataFrame, since: str | None, cfg: RunConfig, hot: dict[str, HotKeys] | None = None
) -> DataFrame:
    """First handshake per node, peer and minute, with the blocks behind its two hashes.

    The first handshake is chosen before the lookups, so only those rows are joined. A hash that several headers share
    counts as the lowest of its blocks, which is what choosing afterwards with the smallest block first would give.
    """
    head, local = F.col("head_block_hash"), F.col("local_block_hash")
    shaken = handshakes(feed, since)
    if hot is None:
        hot = hot_key_sets(shaken, {c: ([c], F.lit(True)) for c in ("head_block_hash", "local_block_hash")}, cfg)
    blocks = (
        block_header.where(F.col("blk_hash").isNotNull())
        .groupBy(bytes_to_hex(F.col("blk_hash")).alias("hash"))
        .agg(F.min("blk_number").alias("number"))
    )

    def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
        named = blocks.select(F.col("hash").alias(column), F.col("number").alias(name))
        return salted_join(rows, named, [column], "left", hot[column], [*PAIR, "msg_timestamp"])

    first = first_per_minute(shaken, PAIR, "msg_timestamp")
    both = numbered(numbered(first, "head_block_hash", "head_block"), "local_block_hash", "local_block")
    return both.select(
        *PAIR,
        "msg_timestamp",
        ((head == local) & head.isNotNull()).alias("in_sync"),
        "head_block",
        "local_block",
        null_greatest(F.col("head_block") - F.col("local_block"), F.lit(0).cast("bigint")).alias("sync_block_gap"),
    )


def tracker_messages(feed: DataFrame, since: str | None) -> DataFrame:
    """First tracker message per node, peer and minute, with its client and address texts cut up."""
    part = [F.get("msg_data", F.lit(i)) for i in range(5)]
    texts = first_per_minute(
        _feed_since(feed, NODE_TRACKER, since).select(
            *PAIR, "msg_timestamp", *[p.alias(f"part{i}") for i, p in enumerate(part)]
        ),
        PAIR,
        "msg_timestamp",
    )
    client, address = F.col("part2"), F.col("part4")
    return texts.select(
        *PAIR,
        "msg_timestamp",
        unquote(F.col("part0")).alias("peer_public_key"),
        F.col("part1").cast("int").alias("peer_rlp_protocol_version"),
        client_type(client).alias("peer_client_type"),
        client_version(client).alias("peer_client_version"),
        client_os(client).alias("peer_os"),
        client_runtime(client).alias("peer_run_time_version"),
        unquote(F.col("part3")).alias("peer_capabilities"),
        address_host(address).alias("peer_ip"),
        address_port(address).alias("peer_port"),
    )


def tracker_addresses(feed: DataFrame, since: str | None) -> DataFrame:
    """Only the addresses of tracker messages, for the lookup's distinct and hot values."""
    return _feed_since(feed, NODE_TRACKER, since).select(address_host(F.get("msg_data", F.lit(4))).alias("peer_ip"))


def join_same_minute(sessions: DataFrame, messages: DataFrame) -> DataFrame:
    """Left join on node, peer and equal minute. Not a nearest match: a message one minute on is missed."""
    right = messages.select(
        *[F.col(c).alias(f"_m_{c}") for c in PAIR],
        time_bucket("minute", F.col("msg_timestamp")).alias("_m_minute"),
        *[c for c in messages.columns if c not in (*PAIR, "msg_timestamp")],
    )
    same = (
        (F.col("node_id") == F.col("_m_node_id"))
        & (F.col("peer_id") == F.col("_m_peer_id"))
        & (time_bucket("minute", F.col("start_time")) == F.col("_m_minute"))
    )
    return sessions.join(right, same, "left").drop("_m_node_id", "_m_peer_id", "_m_minute")


CRAWLER_COLUMNS = {
    "etherscan": ["first_seen", "last_seen", "ip", "port", "country", "client_type", "run_time_version", "os"],
    "ethernodes": ["first_seen", "last_seen", "ip", "isp", "country", "client_type", "client_version", "os", "in_sync"],
}


def join_crawlers(sessions: DataFrame, dim_peers: DataFrame, hot: HotKeys) -> DataFrame:
    """Both roles of the peer dimension, side by side; `hot` are the hot peers."""
    for source, columns in CRAWLER_COLUMNS.items():
        role = dim_peers.where(F.col("source") == source).select(
            F.col("node_id").alias("peer_id"), *[F.col(c).alias(f"{source}_{c}") for c in columns]
        )
        sessions = salted_join(sessions, role, ["peer_id"], "left", hot, ["node_id", "start_time"])
    return sessions


# What a peer told at the start of its session, and what follows from it.
TOLD_COLUMNS = [
    "peer_public_key", "peer_rlp_protocol_version", "peer_client_type", "peer_client_version", "peer_os",
    "peer_run_time_version", "peer_capabilities", "peer_ip", "peer_port", "in_sync", "head_block", "local_block",
    "sync_block_gap", "peer_region", "peer_country", "peer_city", "peer_subdivision",
]


def keep_told(sessions: DataFrame, open_sessions: DataFrame) -> DataFrame:
    """Sessions that were open before keep what is stored of them: its messages may lie before the look-back."""
    key = [*PAIR, "start_time"]
    stored = open_sessions.where(F.col("end_time").isNull()).select(
        *[F.col(c).alias(f"_s_{c}") for c in key], *[F.col(c).alias(f"_t_{c}") for c in TOLD_COLUMNS]
    )
    same = [F.col(c) == F.col(f"_s_{c}") for c in key]
    told = {c: F.coalesce(f"_t_{c}", c) for c in TOLD_COLUMNS}
    return sessions.join(stored, same, "left").withColumns(told).drop(*[f"_s_{c}" for c in key], *[f"_t_{c}" for c in TOLD_COLUMNS])


def fact_peer_session(
    feed: DataFrame,
    block_header: DataFrame,
    geo_blocks: DataFrame,
    country_code: DataFrame,
    dim_peers: DataFrame,
    cfg: RunConfig,
    since: str | None,
    open_sessions: DataFrame | None = None,
) -> DataFrame:
    """Sessions that started, or were still open, after `since`, and stored ones whose duration is reported only after it."""
    country = country_code.select(
        F.col("country_code").alias("peer_country_code"),
        F.col("region").alias("peer_region"),
        F.col("country_name").alias("peer_country"),
    )
    spans = sessionize(feed, cfg, since, open_sessions)
    told = join_same_minute(spans, tracker_messages(feed, since))
    hot = hot_session_keys(feed, since, cfg)
    told = join_same_minute(told, sync_gap(feed, block_header, since, cfg, hot))
    placed = geoip_enrich(
        told, "peer_ip", geo_blocks, cfg, tracker_addresses(feed, since), [*PAIR, "start_time"], hot=hot["peer_ip"]
    )
    placed = placed.join(country, "peer_country_code", "left")
    known = join_crawlers(placed, dim_peers, hot["peer_id"])
    if open_sessions is not None:
        known = keep_told(known, open_sessions)
    updates = known.select(
        "start_time", "end_time", "session_duration", "session_duration_calculated", "session_duration_hour",
        "end_time_imputed", "node_id", "peer_id", "peer_public_key", "peer_rlp_protocol_version", "peer_client_type",
        "peer_client_version", "peer_os", "peer_run_time_version", "peer_capabilities", "peer_ip", "peer_port",
        "in_sync", "head_block", "local_block", "sync_block_gap", "peer_region", "peer_country", "peer_city",
        "peer_subdivision",
        *[f"{source}_{c}" for source, columns in CRAWLER_COLUMNS.items() for c in columns],
        cfg.run_stamp.alias("updated_at"),
    )
    if open_sessions is None:
        return updates
    late = late_durations(feed, since, open_sessions).withColumn("updated_at", cfg.run_stamp)
    return updates.unionByName(late.select(*updates.columns))
