"""undersampled_peers: per region, the 100 peers that announced least."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.functions.scalars import enode
from peernet.operators.relational import bottom_k_per_group, latest_per_key


def latest_sessions(sessions: DataFrame) -> DataFrame:
    """(peer_id, peer_region, enode) of each peer's newest session."""
    address = enode(F.col("peer_public_key"), F.col("peer_ip"), F.col("peer_port")).alias("enode")
    rows = sessions.select("peer_id", "start_time", "node_id", "peer_region", address)
    return latest_per_key(rows, ["peer_id"], "start_time", ["node_id", "peer_region", "enode"]).select(
        "peer_id", "peer_region", "enode"
    )


def hash_counts(hourly: DataFrame, sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    """Hashes of the last 12 days by (region, enode). Hours are summed per peer first, so the join is one to one."""
    per_peer = (
        hourly.where(F.col("session_hour") >= ntz(cfg.as_of) - F.expr("interval 12 days"))
        .groupBy("peer_id")
        .agg(F.sum("total_hash_count").alias("hash_ct"))
    )
    return (
        per_peer.join(latest_sessions(sessions), "peer_id", "left")
        .groupBy(F.coalesce("peer_region", F.lit("unknown")).alias("peer_region"), "enode")
        .agg(F.sum("hash_ct").alias("hash_ct"))
        .where(F.col("hash_ct") > 0)
    )


def undersampled_peers(hourly: DataFrame, sessions: DataFrame, cfg: RunConfig, k: int = 100) -> DataFrame:
    lowest = bottom_k_per_group(hash_counts(hourly, sessions, cfg), "peer_region", "hash_ct", k, ["enode"])
    return lowest.withColumn("updated_at", cfg.run_stamp).orderBy("peer_region", "hash_ct")
