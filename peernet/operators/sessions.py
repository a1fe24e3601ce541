"""Sessions from add and close events: each add ends at the next close of the same node and peer."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peernet.config import PEER_ADD, PEER_REMOVE, RunConfig, ntz
from peernet.functions.scalars import nanos_between, null_greatest, time_bucket

PAIR = ["node_id", "peer_id"]


def peer_set_events(
    feed: DataFrame, cfg: RunConfig, since: str | None, open_sessions: DataFrame | None = None
) -> DataFrame:
    """Adds, removes and node starts after `since`; sessions still open re-enter as adds."""
    kind = F.col("msg_type")
    events = feed.where(
        (F.col("msg_timestamp") > ntz(since)) & kind.isin(PEER_ADD, PEER_REMOVE, cfg.node_start_type)
    ).select(
        "msg_timestamp",
        *PAIR,
        "msg_type",
        F.when(kind != PEER_ADD, F.col("msg_timestamp")).alias("closed_at"),
        F.when(kind == PEER_REMOVE, F.get("msg_data", F.lit(2))).alias("reported"),
    )
    if open_sessions is None:
        return events
    carried = open_sessions.where(F.col("end_time").isNull()).select(
        F.col("start_time").alias("msg_timestamp"),
        *PAIR,
        F.lit(PEER_ADD).alias("msg_type"),
        F.lit(None).cast("timestamp_ntz").alias("closed_at"),
        F.lit(None).cast("string").alias("reported"),
    )
    return events.unionByName(carried)


def close_sessions(events: DataFrame, chunk: str) -> DataFrame:
    """Every add with the next close time and the next reported duration after it (two independent look-aheads).

    Equal times are ordered by type, then duration. The look-ahead runs per (node, peer, chunk of time), so the
    history of one pair is never one task's work: what later chunks hold enters each chunk as one more row at its end,
    which comes from a summary with one row per chunk.
    """
    rows = events.withColumn("_chunk", time_bucket(chunk, F.col("msg_timestamp")))
    position = F.struct("msg_timestamp", "msg_type", "reported")
    summary = rows.groupBy(*PAIR, "_chunk").agg(
        F.min("closed_at").alias("first_close"),
        F.min(F.when(F.col("reported").isNotNull(), position)).alias("first_reported"),
    )
    later = Window.partitionBy(*PAIR).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *PAIR,
        "_chunk",
        F.last("first_close", ignorenulls=True).over(later).alias("closed_at"),
        F.last("first_reported.reported", ignorenulls=True).over(later).alias("reported"),
        F.lit(True).alias("_carried"),
    )
    backwards = (
        Window.partitionBy(*PAIR, "_chunk")
        .orderBy(
            F.desc("_carried"), F.desc("msg_timestamp"), F.desc("msg_type"), F.col("reported").desc_nulls_last()
        )
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .select(
            *PAIR,
            "msg_type",
            F.col("msg_timestamp").alias("start_time"),
            F.last("closed_at", ignorenulls=True).over(backwards).alias("end_time"),
            F.last("reported", ignorenulls=True).over(backwards).cast("bigint").alias("session_duration"),
        )
        .where(F.col("msg_type") == PEER_ADD)
        .drop("msg_type")
    )


def sessionize(
    feed: DataFrame, cfg: RunConfig, since: str | None, open_sessions: DataFrame | None = None
) -> DataFrame:
    """Sessions with reported and calculated duration; an open one is measured to the last event seen."""
    events = peer_set_events(feed, cfg, since, open_sessions)
    last_event = events.agg(F.max("msg_timestamp")).scalar()
    calculated = F.col("session_duration_calculated")
    return (
        close_sessions(events, cfg.chunk)
        .withColumn(
            "session_duration_calculated",
            nanos_between(F.col("start_time"), F.coalesce(F.col("end_time"), last_event)),
        )
        .withColumn("session_duration_hour", calculated / F.lit(1e9) / F.lit(3600.0))
        .withColumn("end_time_imputed", F.col("end_time").isNull())
    )


def late_durations(feed: DataFrame, since: str | None, stored: DataFrame) -> DataFrame:
    """The stored sessions that closed without a reported duration and get one from the messages after `since`.

    `stored` is complete up to `since`, so the first report of a pair after it is the first one after each such session's
    start: one row per pair that reports, whatever the number of messages. Sessions that still wait are not returned.
    """
    reports = feed.where((F.col("msg_timestamp") > ntz(since)) & (F.col("msg_type") == PEER_REMOVE)).select(
        *PAIR, "msg_timestamp", F.get("msg_data", F.lit(2)).alias("reported")
    )
    first = (
        reports.where(F.col("reported").isNotNull())
        .groupBy(*PAIR)
        .agg(F.min(F.struct("msg_timestamp", "reported")).alias("_first"))
    )
    waiting = stored.where(F.col("end_time").isNotNull() & F.col("session_duration").isNull())
    return waiting.join(first, PAIR).select(
        *[F.col("_first.reported").cast("bigint").alias(c) if c == "session_duration" else c for c in stored.columns]
    )


def high_water(sessions: DataFrame) -> DataFrame:
    """(high_water, closed): NULL while no session has closed yet."""
    return sessions.agg(
        null_greatest(F.max("start_time"), F.max("end_time")).alias("high_water"),
        F.count("end_time").alias("closed"),
    )


def session_watermark(
    target: DataFrame | None, cfg: RunConfig, newest: tuple[str | None, str | None] | None = None
) -> str | None:
    """Where the next increment starts. Without a closed session there is no bound, so the increment reads nothing.

    `newest` are the largest start and end, where they are known without reading the target.
    """
    if target is None:
        return cfg.initial_bound
    if newest is None:
        row = high_water(target).select(F.col("high_water").cast("string")).first()
        bound = row[0] if row else None
    else:
        bound = None if None in newest else max(newest)
    if bound is None:
        warnings.warn("no closed session yet: this increment reads no events", stacklevel=2)
    return bound
