"""The three scheduled runs: each model is written once, in dependency order, to its table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.functions.scalars import time_bucket
from peernet.functions.hashing import Digest, keccak256_hex
from peernet.operators.ledger import assert_no_running, incremental_models, mark_completed, plan_run
from peernet.operators.sessions import session_watermark
from peernet.operators.intervals import hour_slices
from peernet.plans.hourly import (
    CELL,
    cells_of,
    earlier_counts,
    held_hours,
    hour_counts,
    hour_rows,
    hourly_window,
    unfolded,
)
from peernet.plans.mempool import MEMPOOL, arrivals, merge_first_seen, stored_watermark
from peernet.plans.peers import dim_peers, tracker_etherscan, tracker_ethernodes
from peernet.plans.performance import peer_performance
from peernet.plans.propagation import fact_hash
from peernet.plans.session_hashes import session_unique_hash
from peernet.plans.sessions import fact_peer_session
from peernet.plans.staging import TRANSACTION_TABLE, fact_transaction
from peernet.plans.undersampled import undersampled_peers
from peernet.schemas import SCHEMAS
from peernet.sources.export import export_csv, should_export, undersampled_rows
from peernet.sources.tables import Tables

LEDGER = "incremental_coordinator"
TRANSACTIONS = "fact_transaction__tx_hash"
PEERS = "dim_peers"
SESSIONS = "fact_peer_session"
HOURLY = "peer_session_performance_hourly"
HOUR_CELLS = "peer_hour_cells"
HOUR_COUNTS = "peer_hour_counts"  # of the last window alone
PERFORMANCE = "dim_peer_performance"
UNDERSAMPLED = "undersampled_peers"
HASHES = "fact_hash"
UNIQUE_HASHES = "peer_session_unique_hash"
HOUR_KEY = ["peer_id", "node_id", "start_time", "session_hour"]


@dataclass(frozen=True)
class Sources:
    feed: DataFrame
    transactions: DataFrame
    block_header: DataFrame
    ethernodes: DataFrame
    etherscan: DataFrame
    geo_blocks: DataFrame
    country_code: DataFrame


def run_transactions(sources: Sources, tables: Tables, cfg: RunConfig) -> None:
    """Plan the block range in the ledger, append the blocks, mark the run completed.

    A run that dies in between leaves its ledger row incomplete, so the next one stops instead of appending twice.
    """
    spark = tables.spark
    ledger = tables.read_replaced(LEDGER)
    if ledger is None:
        ledger = spark.createDataFrame([], SCHEMAS["run_ledger"])
    assert_no_running(ledger, [TRANSACTION_TABLE])
    models = incremental_models(spark, [TRANSACTION_TABLE], cfg.chains)
    planned = plan_run(ledger, models, {"ethereum": [sources.transactions]}, cfg)
    ledger = tables.replace(ledger.unionByName(planned), LEDGER)
    tables.append(fact_transaction(sources.transactions, cfg, ledger), TRANSACTIONS, cluster_by="tx_hash")
    tables.replace(mark_completed(ledger, TRANSACTION_TABLE, cfg), LEDGER)


def run_mempool(sources: Sources, tables: Tables, cfg: RunConfig) -> None:
    """Merge what was announced since the newest sighting, and what reached the feed since the last run, however late.

    A file written up to `late_hours` before the last run's start is looked at again: the clocks may differ, and a merge
    that sees a row twice changes nothing.
    """
    last_run = tables.note(MEMPOOL)
    arrived = last_run and str(datetime.fromisoformat(last_run) - timedelta(hours=cfg.late_hours))
    messages = arrivals(sources.feed, stored_watermark(tables, cfg), arrived, cfg)
    merge_first_seen(messages, tables, cfg, note=cfg.run_started_at)


def run_peer_sessions(
    sources: Sources, tables: Tables, cfg: RunConfig, digest: Digest = keccak256_hex, compat_key: bool = False
) -> None:
    """Peers, sessions, hourly metrics, peer performance. `compat_key` leaves the node out of the session key."""
    peers = tables.replace(
        dim_peers(
            tracker_ethernodes(sources.ethernodes, cfg, digest), tracker_etherscan(sources.etherscan, cfg, digest)
        ),
        PEERS,
        cluster_by="node_id",
    )
    target = tables.read(SESSIONS)
    ends = tables.bounds(SESSIONS, "start_time")[1], tables.bounds(SESSIONS, "end_time")[1]
    since = session_watermark(target, cfg, ends)
    updates = fact_peer_session(
        sources.feed, sources.block_header, sources.geo_blocks, sources.country_code, peers, cfg, since, target
    )
    key = ["peer_id", "start_time"] if compat_key else ["peer_id", "start_time", "node_id"]
    tables.upsert(updates, SESSIONS, key, "start_time", cluster_by="peer_id")

    sessions, transactions = tables.read(SESSIONS), tables.read(TRANSACTIONS)
    lo, hi = hourly_window(tables.read_newest(HOURLY), tables.read_newest(SESSIONS), transactions, cfg)
    update_hours(sources.feed, sessions, transactions, tables, lo, hi, cfg)
    performance = peer_performance(tables.read(HOURLY), sessions, tables.read(MEMPOOL), transactions, cfg)
    tables.replace(performance, PERFORMANCE, cluster_by="peer_id")


def update_hours(
    feed: DataFrame, sessions: DataFrame, transactions: DataFrame, tables: Tables, lo: str | None, hi: str | None, cfg: RunConfig
) -> None:
    """Add the hours of [lo, hi), and make those of sessions that cross `lo` again, with what is known of their end by now.

    Messages before `lo` are not read for that: their counts are stored, per session hour and per cell. An hour's counts
    are those of the run that first counted it, as for sessions that had ended by then.
    """
    cells, known = tables.read(HOUR_CELLS), tables.read(HOURLY)
    # Cells are of whole hours, so of those from the first full hour on.
    full = feed.sparkSession.range(1).select(time_bucket("hour", ntz(lo) + F.expr("interval 1 hour") - F.expr("interval 1 microsecond")).cast("string"))
    first_cell = full.first()[0]
    slices, reach, earlier = hour_slices(sessions, lo, hi, edges=True), lo, None
    if cells is not None and known is not None:
        since = tables.bounds(HOUR_CELLS, "cells_from")[0] or lo
        earlier, rest = earlier_counts(sessions, lo, hi, cells, known, since)
        oldest = rest.agg(F.min("session_hour").cast("string")).first()[0]
        if oldest is not None:
            slices, reach = slices.unionByName(rest), oldest
    counts = tables.replace(hour_counts(feed, slices, transactions, reach, hi, cfg, first_cell), HOUR_COUNTS)
    hours = held_hours(sessions, counts, lo, hi)
    hours = hours if earlier is None else hours.unionByName(earlier)

    def rows_of(held: DataFrame) -> DataFrame:
        return hour_rows(unfolded(held), lo, hi, cfg)

    tables.upsert(hours, HOURLY, HOUR_KEY, "session_hour", cluster_by="peer_id", unfold=rows_of)
    newest = transactions.agg(F.max("blk_timestamp").cast("string")).first()[0]
    tables.upsert(cells_of(counts, newest).withColumn("cells_from", ntz(first_cell)), HOUR_CELLS, CELL, "session_hour")


def run_analysis(sources: Sources, tables: Tables, cfg: RunConfig) -> None:
    """The two datasets over a fixed stretch of the feed, built anew from the stored transactions and sessions."""
    transactions, sessions = tables.read(TRANSACTIONS), tables.read(SESSIONS)
    tables.replace(fact_hash(sources.feed, transactions, cfg), HASHES, cluster_by="first_peer")
    unique = session_unique_hash(sources.feed, sessions, transactions, cfg)
    tables.replace(unique, UNIQUE_HASHES, cluster_by="peer_id")


def run_hourly(
    sources: Sources, tables: Tables, cfg: RunConfig, digest: Digest = keccak256_hex, compat_key: bool = False
) -> None:
    run_transactions(sources, tables, cfg)
    run_mempool(sources, tables, cfg)
    run_peer_sessions(sources, tables, cfg, digest, compat_key)


def run_undersampled(tables: Tables, cfg: RunConfig, export_dir: str, stage: str = "export") -> str | None:
    """Append this run's under-sampled peers and, where the guards allow, export them."""
    tables.append(undersampled_peers(tables.read(HOURLY), tables.read(SESSIONS), cfg), UNDERSAMPLED)
    if not should_export(cfg, stage):
        return None
    rows = undersampled_rows(tables.read(UNDERSAMPLED), cfg)
    # At most as many rows as regions times the rows kept of each.
    return export_csv(rows, f"{export_dir}/{stage}/undersampled_peers.csv.gz", one_file=True)
