"""peer_session_performance_hourly: announced and later confirmed hashes per session hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.functions.scalars import div0, minutes_crossed, null_greatest, null_least, time_bucket
from peernet.operators.confirmation import explode_hashes, hash_messages, preconfirmation_join
from peernet.operators.intervals import (
    fills_hour,
    filled_days,
    hour_slices,
    in_closed_hours,
    points_in_hour_slices,
    slices_from,
)
from peernet.operators.skew import hot_key_sets

# A slice is determined by these; its other columns are derived again after the aggregation, to shuffle less.
SLICE = ["peer_id", "node_id", "session_hour", "start_time", "end_time"]
CELL, COUNTS = SLICE[:3], ["total_hash_count", "confirmed_distinct_tx_count"]
# Hours of a session, folded: from session_hour to last_hour of one day, with the cells of that day.
HELD = [*SLICE, "last_hour", "copies", "cells"]


def hourly_bounds(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row: the hour up to which both sessions and transactions are complete."""
    by_sessions = sessions.agg(F.max("start_time")).scalar()
    by_blocks = transactions.agg(F.max("blk_timestamp").alias("newest_block"))
    return by_blocks.select(
        null_least(
            time_bucket("hour", by_sessions) - F.expr("interval 1 hour"), time_bucket("hour", F.col("newest_block"))
        ).alias("update_end_time")
    )


def hourly_window(
    target: DataFrame | None, sessions: DataFrame, transactions: DataFrame, cfg: RunConfig
) -> tuple[str | None, str | None]:
    """[start, end) of the next update: from the hour after the target's last one."""
    if target is None:
        start = cfg.initial_bound
    else:
        last = F.max("session_hour") + F.expr("interval 1 hour")
        # A target without rows yet is like none.
        start = target.agg(last.cast("string")).first()[0] or cfg.initial_bound
    end = hourly_bounds(sessions, transactions).select(F.col("update_end_time").cast("string")).first()[0]
    return start, end


def announcements(messages: DataFrame) -> DataFrame:
    return explode_hashes(messages, "peer_id", "node_id", "msg_timestamp").select(
        "peer_id", "node_id", "msg_timestamp", "tx_hash"
    )


def hour_counts(
    feed: DataFrame,
    slices: DataFrame,
    transactions: DataFrame,
    reach: str | None,
    hi: str | None,
    cfg: RunConfig,
    cells_from: str | None,
) -> DataFrame:
    """SLICE rows with announced and confirmed hashes, also for slices without any announcement, from the messages of
    [reach, hi]; and the cells of [cells_from, hi): one row per peer, node and whole hour with messages, whether or not a
    session holds it; their start_time is NULL.

    Announcements meet the block times (shuffle by hash) and then the slices (shuffle by node, peer and hour); both
    joins cut hot keys. Every slice joins the count as a row of no messages, so one aggregation makes slices and cells.
    A slice that fills its hour has the counts of the cell, so only the others need to come here.
    """
    messages = hash_messages(feed).where(F.col("msg_timestamp").between(ntz(reach), ntz(hi)))
    announced = announcements(messages)
    keys = {"hash": (["tx_hash"], F.lit(True)), "hour": (["peer_id", "node_id", "session_hour"], F.lit(True))}
    hot = hot_key_sets(messages, keys, cfg, lambda rows: in_closed_hours(announcements(rows)))
    marked = preconfirmation_join(announced, transactions, "left", cfg, after=reach, hot=hot["hash"]).select(
        "peer_id",
        "node_id",
        "msg_timestamp",
        F.when(F.col("copies").isNotNull(), F.col("tx_hash")).alias("confirmed_hash"),
        F.coalesce("copies", F.lit(1)).alias("messages"),
    )
    matched = points_in_hour_slices(marked, slices, hot["hour"]).select(*SLICE, "messages", "confirmed_hash")
    silent = slices.select(*SLICE, F.lit(0).cast("bigint").alias("messages"), F.lit(None).cast("binary").alias("confirmed_hash"))
    none = F.lit(None).cast("timestamp_ntz")
    cells = in_closed_hours(marked).where(F.col("session_hour").between(ntz(cells_from), ntz(hi) - F.expr("interval 1 microsecond")))
    cells = cells.withColumns({"start_time": none, "end_time": none}).select(*SLICE, "messages", "confirmed_hash")
    return matched.unionByName(silent).unionByName(cells).groupBy(*SLICE).agg(
        F.sum("messages").alias("total_hash_count"),
        F.count_distinct("confirmed_hash").alias("confirmed_distinct_tx_count"),
    )


def cells_of(counts: DataFrame, high_block: str | None) -> DataFrame:
    """The cells among `hour_counts`, with the newest block time their confirmations may come from."""
    return counts.where(F.col("start_time").isNull()).select(*CELL, *COUNTS, ntz(high_block).alias("high_block_time"))


def with_cells(days: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows of `filled_days`, each with the list of its day's cells. Hours without a cell had no messages."""
    day = F.to_date("session_hour").alias("_day")
    lists = cells.groupBy("peer_id", "node_id", day).agg(F.collect_list(F.struct("session_hour", *COUNTS)).alias("cells"))
    # The lists hold at most 24 cells. Days grow when they are unfolded, so they are merged.
    return days.select("*", day).hint("merge").join(lists, ["peer_id", "node_id", "_day"], "left").select(*HELD)


def one_hour(slices: DataFrame) -> DataFrame:
    """Counted slices in the form of `with_cells`."""
    return slices.select(
        *HELD[:5],
        F.col("session_hour").alias("last_hour"),
        F.lit(1).cast("bigint").alias("copies"),
        F.array(F.struct("session_hour", *COUNTS)).alias("cells"),
    )


def held_hours(sessions: DataFrame, counts: DataFrame, lo: str | None, hi: str | None, whole: bool = False) -> DataFrame:
    """All hours of `hour_slices`, folded: the edges and, a row per session and day, the filled hours with the cells of
    `hour_counts`. Copies of a session are one row, which counts every message as often, as at the edges."""
    days = filled_days(sessions, lo, hi, whole)
    days = days.groupBy(*days.columns).agg(F.count(F.lit(1)).alias("copies"))
    filled = with_cells(days, counts.where(F.col("start_time").isNull()))
    return filled.unionByName(one_hour(counts.where(F.col("start_time").isNotNull())))


def unfolded(held: DataFrame) -> DataFrame:
    """SLICE rows with counts, and any other column, of folded ones: no row moves for it."""
    others = [c for c in held.columns if c not in HELD]
    entries = F.transform("cells", lambda cell: F.struct(cell["session_hour"], cell))
    hours = F.sequence("session_hour", "last_hour", F.expr("interval 1 hour"))
    cell = F.try_element_at("_by_hour", F.col("session_hour"))
    return (
        held.withColumns({"_by_hour": F.map_from_entries(entries), "_hours": hours})
        .drop("session_hour")
        .withColumn("session_hour", F.explode("_hours"))
        .withColumn("_cell", cell)
        .select(
            *SLICE,
            F.coalesce(F.col("_cell.total_hash_count") * F.col("copies"), F.lit(0)).alias("total_hash_count"),
            F.coalesce("_cell.confirmed_distinct_tx_count", F.lit(0)).alias("confirmed_distinct_tx_count"),
            *others,
        )
    )


def earlier_counts(
    sessions: DataFrame, lo: str | None, hi: str | None, cells: DataFrame, known: DataFrame, since: str | None
) -> tuple[DataFrame, DataFrame]:
    """The hours before `lo` of sessions that cross it: (those counted already, folded; slices that are not).

    A slice that fills its hour is its cell, and an hour from `since` on without a cell had no messages. A partial one is a
    session's first hour, whose row `known` holds from the run that made it. Slices are left over only where neither knows
    them, such as hours before `since`.
    """
    covered = fills_hour() & (F.col("session_hour") >= ntz(since))
    before, hour = time_bucket("hour", ntz(lo) - F.expr("interval 1 microsecond")), F.expr("interval 1 hour")
    from_hour = time_bucket("hour", ntz(since) + hour - F.expr("interval 1 microsecond"))
    days = filled_days(sessions, lo, hi, whole=True).withColumns(
        {
            "session_hour": F.greatest("session_hour", from_hour),
            "last_hour": F.least("last_hour", before),
            "copies": F.lit(1).cast("bigint"),
        }
    )
    inner = with_cells(days.where(F.col("session_hour") <= F.col("last_hour")), cells.where(F.col("session_hour") < ntz(lo)))
    partial = hour_slices(sessions, lo, hi, whole=True).where((F.col("session_hour") < ntz(lo)) & ~covered)
    row_key = [*CELL, "start_time", "session_hour_start", "session_hour_end"]
    # The key tells whether a slice is covered: rows of covered ones have no partner.
    rows = known.where(~covered).select(*row_key, *COUNTS)
    stored = partial.join(rows, row_key).select(*SLICE, *COUNTS)
    rest = partial.join(rows, row_key, "left_anti")
    return inner.unionByName(one_hour(stored)), rest


def hourly_performance(
    feed: DataFrame,
    sessions: DataFrame,
    transactions: DataFrame,
    lo: str | None,
    hi: str | None,
    cfg: RunConfig,
    whole: bool = False,
) -> DataFrame:
    """One row per session and hour of [lo, hi), counted from messages. With `whole`, sessions that cross `lo` come with all
    their hours, to replace those of an earlier run; an increment with stored cells does not need these messages again
    (`runs.update_hours`). Sessions are unfolded into hours after the last shuffle."""
    reach = slices_from(sessions, lo, hi) if whole else lo
    counts = hour_counts(feed, hour_slices(sessions, lo, hi, whole, edges=True), transactions, reach, hi, cfg, reach)
    return hour_rows(unfolded(held_hours(sessions, counts, lo, hi, whole)), lo, hi, cfg)


def hour_rows(counted: DataFrame, lo: str | None, hi: str | None, cfg: RunConfig) -> DataFrame:
    """The dataset's rows of counted slices; further columns stay."""
    others = [c for c in counted.columns if c not in SLICE + COUNTS]
    lower, upper = ntz(lo), ntz(hi)
    hour, minutes = F.col("session_hour"), F.col("session_hour_minutes")
    whole = counted.withColumns(
        {
            "session_hour_start": null_greatest(hour, F.col("start_time")),
            "session_hour_end": null_least(F.col("end_time"), hour + F.expr("interval 1 hour")),
            "is_edge_hour": (hour == time_bucket("hour", F.col("start_time")))
            | (hour == time_bucket("hour", F.col("end_time"))),
        }
    ).withColumn("session_hour_minutes", minutes_crossed(F.col("session_hour_start"), F.col("session_hour_end")))
    return whole.select(
        "peer_id",
        "node_id",
        "session_hour",
        "session_hour_start",
        "session_hour_end",
        "start_time",
        "end_time",
        "is_edge_hour",
        "session_hour_minutes",
        "total_hash_count",
        div0(F.col("total_hash_count"), minutes).alias("hash_per_minute"),
        "confirmed_distinct_tx_count",
        div0(F.col("confirmed_distinct_tx_count"), minutes).alias("confirmed_distinct_tx_per_minute"),
        lower.alias("update_start_time"),
        upper.alias("update_end_time"),
        cfg.run_stamp.alias("updated_at"),
        *others,
    )
