"""dim_peer_performance: how much of the public mempool each peer relays, how far it lags, and what it runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.functions.scalars import bytes_to_hex, null_least, time_bucket
from peernet.operators.relational import changes, latest_per_key

LATEST_COLUMNS = [
    "in_sync", "peer_public_key", "peer_rlp_protocol_version", "peer_client_type", "peer_client_version", "peer_os",
    "peer_run_time_version", "peer_capabilities", "peer_ip", "peer_port", "peer_region", "peer_country", "peer_city",
    "peer_subdivision",
]


def public_mempool_hourly(mempool: DataFrame, transactions: DataFrame) -> DataFrame:
    """Confirmed transactions by the hour they were first announced in. The byte form is turned to text once per
    transaction, so both sides hash on the same plain column."""
    confirmed = transactions.select(bytes_to_hex(F.col("tx_hash")).alias("tx_hash"))
    return (
        mempool.join(confirmed, "tx_hash", "inner")
        .groupBy(time_bucket("hour", F.col("first_seen_at")).alias("blk_hour"))
        .agg(F.count(F.lit(1)).alias("tx_ct"))
    )


def two_weeks(ts: Column, cfg: RunConfig) -> Column:
    return ts.cast("date") >= (ntz(cfg.as_of) - F.expr("interval 2 weeks")).cast("date")


def mempool_share(hourly: DataFrame, mempool_hours: DataFrame) -> DataFrame:
    """Share of the hour's confirmed transactions a peer relayed, for whole session hours; NULL in unknown hours."""
    # One row per hour of history: a century has under 900,000, so the broadcast side is bounded by the calendar.
    hours = F.broadcast(mempool_hours.withColumnRenamed("blk_hour", "session_hour"))
    share = F.col("confirmed_distinct_tx_count") / F.col("tx_ct")
    return (
        hourly.where(~F.col("is_edge_hour"))
        .join(hours, "session_hour", "left")
        .select(
            "peer_id",
            "session_hour",
            "confirmed_distinct_tx_per_minute",
            null_least(share, F.lit(1.0)).alias("pct_mempool"),
        )
    )


def peer_rates(shares: DataFrame, cfg: RunConfig) -> DataFrame:
    recent = F.when(two_weeks(F.col("session_hour"), cfg), F.col("pct_mempool"))
    return shares.groupBy("peer_id").agg(
        F.avg("confirmed_distinct_tx_per_minute").alias("avg_confirmed_distinct_tx_per_minute"),
        F.coalesce(F.avg(recent), F.lit(0.0)).alias("avg_propogation_rate_2w"),
        F.coalesce(F.max(recent), F.lit(0.0)).alias("max_propogation_rate_2w"),
        F.avg("pct_mempool").alias("avg_propogation_rate"),
        F.max("pct_mempool").alias("max_propogation_rate"),
    )


def latest_dimensions(sessions: DataFrame) -> DataFrame:
    """Newest session per peer that named its client."""
    columns = ["peer_id", "start_time", "node_id", "end_time", *LATEST_COLUMNS]
    named = sessions.where(F.col("peer_client_type").isNotNull()).select(*columns)
    return latest_per_key(named, ["peer_id"], "start_time", ["node_id", "end_time"])


def version_changes(sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    named = sessions.where(F.col("peer_client_type").isNotNull()).select(
        "peer_id", "start_time", "node_id", "peer_client_version"
    )
    ties = ["node_id", "peer_client_version"]
    return changes(named, "peer_id", "start_time", "peer_client_version", ties, cfg.chunk)


def last_upgrade(sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    return version_changes(sessions, cfg).groupBy("peer_id").agg(F.max("start_time").alias("upgraded_at"))


def sync_lag(sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    recent = F.when(two_weeks(F.col("start_time"), cfg), F.col("sync_block_gap"))
    return sessions.groupBy("peer_id").agg(
        F.avg("sync_block_gap").alias("avg_sync_lag"),
        F.coalesce(F.avg(recent), F.lit(0.0)).alias("avg_sync_lag_2w"),
    )


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero on the decimal value, not on its nearest double."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def peer_performance(
    hourly: DataFrame, sessions: DataFrame, mempool: DataFrame, transactions: DataFrame, cfg: RunConfig
) -> DataFrame:
    """One row per peer with at least one whole session hour; every input is aggregated to the peer before joining."""
    rates = peer_rates(mempool_share(hourly, public_mempool_hourly(mempool, transactions)), cfg)
    latest = latest_dimensions(sessions).withColumn("last_seen_at", F.coalesce("end_time", "start_time"))
    joined = (
        rates.join(latest.drop("start_time", "node_id", "end_time"), "peer_id", "left")
        .join(last_upgrade(sessions, cfg), "peer_id", "left")
        .join(sync_lag(sessions, cfg), "peer_id", "left")
    )
    percent = ["avg_propogation_rate_2w", "max_propogation_rate_2w", "avg_propogation_rate", "max_propogation_rate"]
    return joined.select(
        "peer_id",
        rounded(F.col("avg_confirmed_distinct_tx_per_minute"), 0).alias("avg_confirmed_distinct_tx_per_minute"),
        *[rounded(F.col(c) * 100, 2).alias(c) for c in percent],
        "upgraded_at",
        "avg_sync_lag",
        "avg_sync_lag_2w",
        F.coalesce("in_sync", F.lit(False)).alias("in_sync"),
        *LATEST_COLUMNS[1:],
        "last_seen_at",
    )
