"""Staged inputs and confirmed transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig
from peernet.functions.scalars import hex_to_bytes
from peernet.operators.ledger import in_block_ranges, run_block_range, table_block_range

TRANSACTION_TABLE = "FACT_TRANSACTION__TX_HASH"


def stage_transactions(raw: DataFrame, cfg: RunConfig, chain: str = "ethereum") -> DataFrame:
    return raw.select(
        "blk_number",
        "blk_timestamp",
        F.lit(chain).alias("blockchain"),
        hex_to_bytes(F.col("tx_hash")).alias("tx_hash"),
        "tx_index",
        "tx_status",
        "tx_from",
        "tx_to",
        "tx_gas_price",
        "tx_gas_used",
        "tx_value",
        cfg.run_stamp.alias("run_timestamp"),
    )


def stage_ethernodes(raw: DataFrame, cfg: RunConfig) -> DataFrame:
    return raw.select(
        F.col("node_id").alias("node_public_key"),
        F.col("host_address").alias("ip"),
        "isp",
        "country",
        "client_type",
        "client_version",
        "os",
        "in_sync",
        "last_seen",
        cfg.run_stamp.alias("run_timestamp"),
    )


def stage_etherscan(raw: DataFrame, cfg: RunConfig) -> DataFrame:
    return raw.select(
        F.col("node_id").alias("node_public_key"),
        F.col("host").alias("ip"),
        "port",
        "country",
        F.col("client").alias("client_type"),
        F.col("type").alias("run_time_version"),
        "os",
        "last_seen",
        cfg.run_stamp.alias("run_timestamp"),
    )


def fact_transaction(
    raw: DataFrame, cfg: RunConfig, ledger: DataFrame | None = None, table: str = TRANSACTION_TABLE
) -> DataFrame:
    """Confirmed transactions to append. With a ledger, only the blocks this run owns.

    The run's coarse range prunes the scan, the table's own range then decides.
    """
    staged = stage_transactions(raw, cfg)
    if ledger is None:
        return staged
    coarse = in_block_ranges(staged, run_block_range(ledger, cfg.run_started_at), cfg.chains)
    return in_block_ranges(coarse, table_block_range(ledger, cfg.run_started_at, table), cfg.chains)
