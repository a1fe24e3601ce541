"""Whole runs: increments against one build, the ledger guard, and the stream."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.adapters import Inputs
from peernet.config import ntz
from peernet.functions.hashing import sha256_hex
from peernet.operators.ledger import IncompleteRunError
from peernet.plans import runs
from peernet.plans.hourly import earlier_counts, hourly_performance
from peernet.plans.mempool import first_seen
from peernet.plans.staging import stage_transactions
from peernet.schemas import SCHEMAS
from peernet.sources.loaders import arrived_after
from peernet.sources.tables import Tables
from peernet.streaming.first_seen import stream_first_seen
from tests.util import at, feed, rows


def sources(inputs: Inputs, until: str | None = None) -> runs.Sources:
    # Block numbers of the check data do not grow with time, so the ledger's stop block alone cuts the transactions.
    messages = inputs.feed
    if until is not None:
        messages = messages.where(F.col("msg_timestamp") <= ntz(until))
    return runs.Sources(
        messages, inputs.transactions, inputs.block_header, inputs.ethernodes, inputs.etherscan, inputs.geo_blocks,
        inputs.country_code,
    )


def test_two_runs_equal_one(spark, cfg, sf_dir, tmp_path):
    inputs = Inputs(spark, sf_dir)
    once, twice = Tables(spark, f"file:{tmp_path}/once"), Tables(spark, f"file:{tmp_path}/twice")
    runs.run_hourly(sources(inputs), once, cfg, sha256_hex)
    early = replace(cfg, run_started_at="2024-01-16 00:00:00", as_of="2024-01-16 00:00:00")
    runs.run_hourly(sources(inputs, early.run_started_at), twice, early, sha256_hex)
    runs.run_hourly(sources(inputs), twice, cfg, sha256_hex)

    def same(name: str, *columns: str) -> int:
        left, right = rows(once.read(name), *columns), rows(twice.read(name), *columns)
        assert left == right
        return len(left)

    assert same(runs.TRANSACTIONS, "tx_hash", "blk_number") > 0
    assert same(runs.MEMPOOL, "tx_hash", "first_seen_at") > 0
    columns = [c for c in once.read(runs.SESSIONS).columns if c != "updated_at"]
    assert same(runs.SESSIONS, *columns) > 0
    ledger = twice.read_replaced(runs.LEDGER)
    assert rows(ledger, "run_completed") == [(True,), (True,)]
    # The second run goes on where the first one stopped, and makes the hours of sessions that go on again.
    extent = ["session_hour_start", "session_hour_end", "end_time", "is_edge_hour", "session_hour_minutes"]
    assert same(runs.HOURLY, *runs.HOUR_KEY, *extent, "total_hash_count") > 0
    starts = rows(twice.read(runs.HOURLY).groupBy("update_start_time", "update_end_time").count())
    assert len(starts) == 2
    assert twice.read(runs.HOURLY).groupBy(*runs.HOUR_KEY).count().where("count > 1").count() == 0

    assert runs.run_undersampled(twice, replace(cfg, environment="dev"), f"file:{tmp_path}/out") is None
    target = runs.run_undersampled(twice, cfg, f"file:{tmp_path}/out")
    exported = spark.read.csv(target, header=True)
    assert exported.columns == ["peer_region", "enode", "hash_ct"] and exported.count() > 0


def test_an_increment_reads_the_messages_of_its_window_alone(spark, cfg, sf_dir, tmp_path):
    """A session that lasts all month is closed in the second run: its inner hours come from the stored cells, though no
    session held most of them when they were counted."""
    inputs = Inputs(spark, sf_dir)
    tx = stage_transactions(inputs.transactions, cfg)
    lo, cut, hi = "2024-01-01 00:00:00", "2024-01-16 00:00:00", "2024-01-30 00:00:00"
    pairs = inputs.feed.select("peer_id", "node_id").distinct()
    start, end = ntz("2024-01-01 00:20:00"), ntz("2024-01-28 05:07:00")
    spans = pairs.select("peer_id", "node_id", start.alias("start_time"), end.alias("end_time"))
    still_open = spans.withColumn("end_time", F.lit(None).cast("timestamp_ntz"))
    counts = ["total_hash_count", "confirmed_distinct_tx_count"]
    tables = Tables(spark, f"file:{tmp_path}/t")
    runs.update_hours(inputs.feed.where(F.col("msg_timestamp") <= ntz(cut)), still_open, tx, tables, lo, cut, cfg)
    runs.update_hours(inputs.feed.where(F.col("msg_timestamp") >= ntz(cut)), spans, tx, tables, cut, hi, cfg)
    whole = hourly_performance(inputs.feed, spans, tx, lo, hi, cfg)
    found = rows(tables.read(runs.HOURLY), *runs.HOUR_KEY, *counts)
    assert found == rows(whole, *runs.HOUR_KEY, *counts) and sum(r[-2] for r in found) > 100
    # Nothing is left to be counted from earlier messages.
    _, rest = earlier_counts(spans, cut, hi, tables.read(runs.HOUR_CELLS), tables.read(runs.HOURLY), lo)
    assert rest.count() == 0


def test_only_edges_of_sessions_are_staged(spark, cfg, sf_dir, tmp_path):
    """Hours that a session fills are made as they are written; what is staged before holds two hours of it at most."""
    inputs, tables = Inputs(spark, sf_dir), Tables(spark, f"file:{tmp_path}/t")
    start, end = ntz("2024-01-01 00:20:00"), ntz("2024-01-28 05:07:00")
    spans = inputs.feed.select("peer_id", "node_id", start.alias("start_time"), end.alias("end_time")).distinct()
    tx = stage_transactions(inputs.transactions, cfg)
    runs.update_hours(inputs.feed, spans, tx, tables, "2024-01-01 00:00:00", "2024-01-30 00:00:00", cfg)
    staged = tables.read_replaced(runs.HOUR_COUNTS).where(F.col("start_time").isNotNull())
    assert staged.count() == 2 * spans.count() and tables.read(runs.HOURLY).count() == (27 * 24 + 6) * spans.count()


def test_unfinished_run_blocks_the_next(spark, cfg, sf_dir, tmp_path):
    tables = Tables(spark, f"file:{tmp_path}/t")
    inputs = sources(Inputs(spark, sf_dir))
    runs.run_transactions(inputs, tables, cfg)
    ledger = tables.read_replaced(runs.LEDGER)
    tables.replace(ledger.withColumn("run_completed", F.lit(False)), runs.LEDGER)
    with pytest.raises(IncompleteRunError):
        runs.run_transactions(inputs, tables, replace(cfg, run_started_at="2024-02-01 00:00:00"))


def test_stream_equals_batch(spark, cfg, tmp_path):
    tables = Tables(spark, f"file:{tmp_path}/tables")
    path = f"file:{tmp_path}/feed"
    batches = [
        [("10:00", "n", "p", "new_hash", ["0x1", "0x2"]), ("10:01", "n", "p", "get_tx_66", ["0x9"])],
        [("09:00", "n", "p", "new_hash_66", ["0x2"]), ("11:00", "n", "p", "new_hash", ["0x1", "0x3"])],
    ]
    for batch in batches:
        feed(spark, batch).write.mode("append").parquet(path)
        stream_first_seen(spark, path, tables, f"file:{tmp_path}/checkpoint", cfg).awaitTermination()
    found = rows(tables.read(runs.MEMPOOL), "tx_hash", "first_seen_at")
    assert found == [("0x1", at("10:00")), ("0x2", at("09:00")), ("0x3", at("11:00"))]
    assert found == rows(first_seen(spark.read.parquet(path), cfg.initial_bound), "tx_hash", "first_seen_at")


def test_batch_takes_late_files_like_the_stream(spark, cfg, tmp_path):
    """An announcement weeks older than the newest sighting, in a file that came since the last run, moves a sighting back."""
    path = f"file:{tmp_path}/feed"
    cfg = replace(cfg, late_hours=1)
    batches = [
        [("10:00", "n", "p", "new_hash", ["0x1", "0x2"]), (9 * 86400, "n", "p", "new_hash", ["0x8"])],
        [(-5 * 86400, "n", "p", "new_hash_66", ["0x2"]), (10 * 86400, "n", "p", "new_hash", ["0x1", "0x3"])],
        [],
        [("08:00", "n", "p", "new_hash", ["0x1", "0x9"]), (-20 * 86400, "n", "p", "new_hash", ["0x7"])],
    ]
    batched, streamed = Tables(spark, f"file:{tmp_path}/batch"), Tables(spark, f"file:{tmp_path}/stream")
    for batch in batches:
        started = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
        feed(spark, batch).write.mode("append").parquet(path)
        found = spark.read.schema(SCHEMAS["network_feed"]).parquet(path)
        run = runs.Sources(found, *[None] * 6)
        runs.run_mempool(run, batched, replace(cfg, run_started_at=started))
        stream_first_seen(spark, path, streamed, f"file:{tmp_path}/checkpoint", cfg).awaitTermination()
        left = rows(batched.read(runs.MEMPOOL), "tx_hash", "first_seen_at")
        assert left == rows(streamed.read(runs.MEMPOOL), "tx_hash", "first_seen_at")
    assert left == rows(first_seen(found, cfg.initial_bound), "tx_hash", "first_seen_at")
    # The row before the initial bound stays out in both.
    assert [r[0] for r in left] == ["0x1", "0x2", "0x3", "0x8", "0x9"] and left[1][1] == at(-5 * 86400)


def test_files_that_came_before_are_not_opened(spark, cfg, tmp_path):
    path = f"{tmp_path}/feed"
    feed(spark, [("10:00", "n", "p", "new_hash", ["0x1"])]).coalesce(1).write.parquet(path)
    (old,) = Path(path).glob("*.parquet")
    feed(spark, [("09:00", "n", "p", "new_hash", ["0x2"])]).coalesce(1).write.mode("append").parquet(path)
    old.write_bytes(b"rubbish")
    old.with_name(f".{old.name}.crc").unlink()
    os.utime(old, (1.7e9, 1.7e9))
    found = spark.read.schema(SCHEMAS["network_feed"]).parquet(path)
    assert rows(arrived_after(found, "2024-06-01 00:00:00"), "msg_data") == [(["0x2"],)]
    # Rows that come from no file may all be new.
    made = feed(spark, [("10:00", "n", "p", "new_hash", ["0x1"])])
    assert arrived_after(made, "2024-06-01 00:00:00").count() == 1
