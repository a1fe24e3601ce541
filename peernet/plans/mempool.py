"""fact_mempool_transaction: when each transaction hash was first announced."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.operators.confirmation import hash_messages
from peernet.operators.relational import keep_earliest
from peernet.schemas import SCHEMAS
from peernet.sources.loaders import arrived_after
from peernet.sources.tables import Tables, delete

MEMPOOL = "fact_mempool_transaction"


def first_seen(feed: DataFrame, since: str | None) -> DataFrame:
    """Earliest announcement per hash text after `since`; reduced to one row per hash and task before the shuffle."""
    return (
        hash_messages(feed)
        .where(F.col("msg_timestamp") > ntz(since))
        .select(F.explode("msg_data").alias("tx_hash"), "msg_timestamp")
        .groupBy("tx_hash")
        .agg(F.min("msg_timestamp").alias("first_seen_at"))
    )


def stored_watermark(tables: Tables, cfg: RunConfig) -> str | None:
    """`mempool_watermark` of the stored table, from its manifest alone."""
    _, newest = tables.bounds(MEMPOOL, "first_seen_at")
    if newest is None:
        return cfg.initial_bound
    return str(datetime.fromisoformat(newest) - timedelta(hours=cfg.late_hours))


def mempool_watermark(target: DataFrame | None, cfg: RunConfig) -> str | None:
    """The newest first sighting of the target, less the time that announcements may be late by. A target without rows
    yet is like none."""
    if target is None:
        return cfg.initial_bound
    newest = F.max("first_seen_at") - F.expr(f"interval {cfg.late_hours} hours")
    return target.agg(newest.cast("string")).first()[0] or cfg.initial_bound


def fact_mempool(feed: DataFrame, target: DataFrame, since: str | None, cfg: RunConfig) -> DataFrame:
    """Rows to upsert by tx_hash: hashes the target lacks, or has later."""
    return keep_earliest(first_seen(feed, since), target, "tx_hash", "first_seen_at").withColumn(
        "updated_at", cfg.run_stamp
    )


def arrivals(feed: DataFrame, since: str | None, arrived: str | None, cfg: RunConfig) -> DataFrame:
    """Announcements after `since`, and those up to it, however old, that reached the feed after `arrived`."""
    messages = hash_messages(feed).where(F.col("msg_timestamp") > ntz(cfg.initial_bound))
    recent = messages.where(F.col("msg_timestamp") > ntz(since))
    if arrived is None:
        return recent
    late = arrived_after(messages, arrived).where(F.col("msg_timestamp") <= ntz(since))
    return recent.unionByName(late)


def merge_first_seen(messages: DataFrame, tables: Tables, cfg: RunConfig, note: str | None = None) -> None:
    """Merge announcements into the stored first sightings.

    The sightings are staged; of the target, only the dates that may hold one of their hashes are read.
    """
    staging = tables.staging(MEMPOOL)
    try:
        first_seen(messages, cfg.initial_bound).write.parquet(staging)
        new = tables.spark.read.schema("tx_hash string, first_seen_at timestamp_ntz").parquet(staging)
        known = tables.read_holding(MEMPOOL, new, ["tx_hash"])
        if known is None:
            known = tables.spark.createDataFrame([], SCHEMAS["mempool_transaction"])
        updates = keep_earliest(new, known, "tx_hash", "first_seen_at").withColumn("updated_at", cfg.run_stamp)
        tables.upsert(updates, MEMPOOL, ["tx_hash"], "first_seen_at", cluster_by="tx_hash", note=note)
    finally:
        delete(tables.spark, staging)
