"""Announced hashes and the transactions that confirm them later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import HASH_TYPES, RunConfig, ntz
from peernet.functions.scalars import hex_to_bytes
from peernet.operators.skew import HotKeys, hot_keys, salted_join


def hash_messages(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("msg_type").isin(*HASH_TYPES))


def explode_hashes(messages: DataFrame, *columns: str) -> DataFrame:
    """One row per announced hash (as bytes); messages without hashes leave no row."""
    return messages.select(*columns, F.posexplode("msg_data").alias("msg_hash_index", "hash_text")).withColumn(
        "tx_hash", hex_to_bytes(F.col("hash_text"))
    )


def block_times(transactions: DataFrame) -> DataFrame:
    """(tx_hash, blk_timestamp, copies): repeated transaction rows become a weight before any join."""
    return transactions.groupBy("tx_hash", "blk_timestamp").agg(F.count(F.lit(1)).alias("copies"))


def preconfirmation_join(
    announced: DataFrame,
    transactions: DataFrame,
    how: str,
    cfg: RunConfig,
    after: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Announcements with the block times after them. `how='left'` keeps the others, with NULL copies.

    `after` is a time that no announcement lies before: earlier blocks confirm none, so they are not read.
    `hot` are the hot hashes, where the caller has looked for them already.
    """
    if after is not None:
        transactions = transactions.where(F.col("blk_timestamp") > ntz(after))
    return salted_join(
        announced,
        block_times(transactions),
        ["tx_hash"],
        how,
        hot_keys(announced, ["tx_hash"], cfg) if hot is None else hot,
        ["msg_timestamp"],
        residual=F.col("msg_timestamp") < F.col("blk_timestamp"),
    )
