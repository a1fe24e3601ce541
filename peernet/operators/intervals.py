"""Joins of points in time to closed intervals, and cutting of sessions into hours.

A session grows by a row per hour when cut, which Spark's size estimate does not see: so the cut side is always merged,
never broadcast. Hours that a session fills have the counts of the hour itself, so they need not be cut before a join
(`filled_days`); only its first and last hour do (`hour_slices` with `edges`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.config import ntz
from peernet.functions.scalars import minutes_crossed, null_greatest, null_least, time_bucket
from peernet.operators.skew import HotKeys, salted_join


def _spans(sessions: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    """Sessions that reach into [lo, hi); an open one ends 12 hours after its start, or at `hi` if that is earlier."""
    end = F.coalesce("end_time", null_least(ntz(hi), F.col("start_time") + F.expr("interval 12 hours")))
    return (
        sessions.select("peer_id", "node_id", "start_time", end.alias("end_time"))
        .where((F.col("start_time") < ntz(hi)) & (F.col("end_time") >= ntz(lo)))
        .withColumns(
            {
                "start_hour": time_bucket("hour", F.col("start_time")),
                "end_hour": time_bucket("hour", F.col("end_time")),
            }
        )
    )


def slices_from(sessions: DataFrame, lo: str | None, hi: str | None) -> str | None:
    """The first hour that `hour_slices(..., whole=True)` makes: where the earliest session that crosses `lo` starts."""
    first = _spans(sessions, lo, hi).agg(F.least(F.min("start_hour"), ntz(lo)).cast("string")).first()[0]
    return first or lo


def _hour_range(lo: str | None, hi: str | None, whole: bool) -> tuple[Column, Column]:
    """The first and the last hour of a span that `hour_slices` makes."""
    first_whole = time_bucket("hour", ntz(lo) + F.expr("interval 1 hour") - F.expr("interval 1 microsecond"))
    first = F.col("start_hour") if whole else F.greatest(F.col("start_hour"), first_whole)
    return first, F.least(F.col("end_hour"), time_bucket("hour", ntz(hi) - F.expr("interval 1 microsecond")))


def fills_hour() -> Column:
    """Whether a slice lasts its whole hour."""
    hour = F.col("session_hour")
    return (F.col("session_hour_start") == hour) & (F.col("session_hour_end") == hour + F.expr("interval 1 hour"))


def hour_slices(
    sessions: DataFrame, lo: str | None, hi: str | None, whole: bool = False, edges: bool = False
) -> DataFrame:
    """One row per session and hour of [lo, hi), clipped to the session.

    Hours outside [lo, hi) are not generated; slices without extent are dropped. With `whole`, sessions that cross `lo`
    get their earlier hours too: those were made when the session's end was not known yet, and are to be replaced. With
    `edges`, only slices that do not fill their hour, at most two per session, are made; `filled_days` has the others.
    """
    spans = _spans(sessions, lo, hi)
    first, last = _hour_range(lo, hi, whole)
    if edges:
        ends = F.array_distinct(F.array("start_hour", "end_hour"))
        hours = F.filter(ends, lambda hour: hour.between(first, last))
    else:
        hours = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 hour")))
    session_hour = F.col("session_hour")
    slices = (
        spans.withColumn("session_hour", F.explode(hours))
        .withColumns(
            {
                "is_edge_hour": (session_hour == F.col("start_hour")) | (session_hour == F.col("end_hour")),
                "session_hour_start": null_greatest(session_hour, F.col("start_time")),
                "session_hour_end": null_least(F.col("end_time"), session_hour + F.expr("interval 1 hour")),
            }
        )
        .withColumn(
            "session_hour_minutes", minutes_crossed(F.col("session_hour_start"), F.col("session_hour_end"))
        )
        .where(F.col("session_hour_start") != F.col("session_hour_end"))
        .drop("start_hour", "end_hour")
    )
    return slices.where(~fills_hour()) if edges else slices


def filled_days(sessions: DataFrame, lo: str | None, hi: str | None, whole: bool = False) -> DataFrame:
    """The slices of `hour_slices` that fill their hour, as one row per session and day: those from `session_hour` to
    `last_hour`."""
    first, last = _hour_range(lo, hi, whole)
    start = F.col("start_hour")
    opening = F.when(F.col("start_time") == start, start).otherwise(start + F.expr("interval 1 hour"))
    days = F.sequence(time_bucket("day", F.col("_first")), time_bucket("day", F.col("_last")), F.expr("interval 1 day"))
    return (
        _spans(sessions, lo, hi)
        .withColumns(
            {"_first": F.greatest(first, opening), "_last": F.least(last, F.col("end_hour") - F.expr("interval 1 hour"))}
        )
        .where(F.col("_first") <= F.col("_last"))
        .withColumn("_day", F.explode(days))
        .select(
            "peer_id",
            "node_id",
            "start_time",
            "end_time",
            F.greatest("_first", "_day").alias("session_hour"),
            F.least(F.col("_last"), F.col("_day") + F.expr("interval 23 hours")).alias("last_hour"),
        )
    )


def in_closed_hours(points: DataFrame) -> DataFrame:
    """Points with every `session_hour` whose closed hour holds them: one exactly on the hour is also in the hour before."""
    hour = time_bucket("hour", F.col("msg_timestamp"))
    hours = F.when(
        F.col("msg_timestamp") == hour, F.array(hour, hour - F.expr("interval 1 hour"))
    ).otherwise(F.array(hour))
    return points.withColumn("session_hour", F.explode(hours))


def points_in_hour_slices(points: DataFrame, slices: DataFrame, hot: HotKeys) -> DataFrame:
    """Points of (peer_id, node_id, msg_timestamp) matched to hour slices, both slice ends included.

    A slice lies inside one hour, so the hour joins as an equal key.
    """
    return salted_join(
        in_closed_hours(points),
        slices.hint("merge"),
        ["peer_id", "node_id", "session_hour"],
        "inner",
        hot,
        ["msg_timestamp"],
        F.col("msg_timestamp").between(F.col("session_hour_start"), F.col("session_hour_end")),
    )


def points_in_intervals(
    points: DataFrame, intervals: DataFrame, keys: list[str], start: str, end: str, cell: str, hot: HotKeys
) -> DataFrame:
    """Points matched to intervals [start, end] of any length: intervals are listed under every time cell they touch."""
    first, last = time_bucket(cell, F.col(start)), time_bucket(cell, F.col(end))
    cells = F.when(F.col(start) <= F.col(end), F.sequence(first, last, F.expr(f"interval 1 {cell}")))
    return salted_join(
        points.withColumn("_cell", time_bucket(cell, F.col("msg_timestamp"))),
        intervals.withColumn("_cell", F.explode(cells)).hint("merge"),
        [*keys, "_cell"],
        "inner",
        hot,
        ["msg_timestamp"],
        F.col("msg_timestamp").between(F.col(start), F.col(end)),
    ).drop("_cell")


def hourly_keys(messages: DataFrame) -> DataFrame:
    """The join key of a message, for finding hot (peer, node, hour) groups without touching the payload."""
    return messages.select("peer_id", "node_id", time_bucket("hour", F.col("msg_timestamp")).alias("session_hour"))
