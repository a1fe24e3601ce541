"""CSV export as gzip files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.sources.tables import _hadoop_path, delete, exists, rename

# Fixed value: the columns of the export, in their order.
PERFORMANCE_COLUMNS = (
    "peer_id", "avg_confirmed_distinct_tx_per_minute", "avg_propogation_rate_2w", "max_propogation_rate_2w",
    "avg_propogation_rate", "max_propogation_rate", "upgraded_at", "avg_sync_lag", "avg_sync_lag_2w", "in_sync",
    "peer_public_key", "peer_rlp_protocol_version", "peer_client_type", "peer_client_version", "peer_os",
    "peer_run_time_version", "peer_capabilities", "peer_ip", "peer_port", "peer_region", "peer_country", "peer_city",
    "last_seen_at",
)


def should_export(cfg: RunConfig, stage: str) -> bool:
    """A full refresh exports only to a full-refresh stage; other than production exports nothing."""
    if cfg.full_refresh and "full_refresh" not in stage.lower():
        return False
    return cfg.environment.lower() == "production"


def undersampled_rows(table: DataFrame, cfg: RunConfig) -> DataFrame:
    """The rows this run appended."""
    return table.where(F.col("updated_at") == cfg.run_stamp).select("peer_region", "enode", "hash_ct")


def performance_rows(table: DataFrame, cfg: RunConfig) -> DataFrame:
    """Peers seen within a month of the run."""
    recent = F.col("last_seen_at") >= ntz(cfg.as_of) - F.expr("interval 1 month")
    return table.where(recent).select(*PERFORMANCE_COLUMNS)


def export_csv(rows: DataFrame, target: str, one_file: bool = False) -> str:
    """Write gzip CSV with a header (NULL as empty, '' as ""), replacing an older export.

    The target is a folder of part files that tasks write side by side. Only for a result of bounded size (such as k
    rows per region), `one_file` makes the target a single file. The new export is complete before the old one goes.
    """
    spark = rows.sparkSession
    staging = f"{target}.new-{uuid.uuid4().hex}"
    (
        (rows.coalesce(1) if one_file else rows)
        .write.option("header", True)
        .option("compression", "gzip")
        .option("nullValue", "")
        .option("emptyValue", '""')
        .csv(staging)
    )
    ready = staging
    if one_file:
        fs, p = _hadoop_path(spark, staging)
        ready = next(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    old = f"{target}.old-{uuid.uuid4().hex}"
    replaced = exists(spark, target)
    if replaced:
        rename(spark, target, old)
    rename(spark, ready, target)
    for left in [staging] * one_file + [old] * replaced:
        delete(spark, left)
    return target
