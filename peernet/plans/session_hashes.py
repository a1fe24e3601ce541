"""peer_session_unique_hash: what a peer announced and requested over each session of a fixed window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.config import GET_TYPE, HASH_TYPES, RunConfig, ntz
from peernet.functions.scalars import div0, minute_bin, time_bucket
from peernet.operators.confirmation import explode_hashes, hash_messages, preconfirmation_join
from peernet.operators.intervals import hourly_keys, points_in_intervals
from peernet.operators.sketches import accumulate, combine, estimate
from peernet.operators.skew import hot_keys

SESSION = ["peer_id", "node_id", "start_time", "session_duration_calculated"]


def minute_range(messages: DataFrame) -> tuple[int | None, int | None]:
    """First and last minute bin that hold an announcement."""
    row = messages.agg(minute_bin(F.min("msg_timestamp")), minute_bin(F.max("msg_timestamp"))).first()
    return row[0], row[1]


def request_messages(feed: DataFrame, cfg: RunConfig) -> DataFrame:
    """Requests with a sketch of the asked hashes; equal-sized requests at one instant merge, empty ones drop."""
    return (
        feed.where(
            F.col("msg_timestamp").between(ntz(cfg.window_start), ntz(cfg.window_end))
            & (F.col("msg_type") == GET_TYPE)
        )
        .select("node_id", "peer_id", "msg_timestamp", F.size("msg_data").cast("bigint").alias("asked"),
                F.explode("msg_data").alias("hash_text"))
        .groupBy("node_id", "peer_id", "msg_timestamp", "asked")
        .agg(accumulate(F.col("hash_text")).alias("sketch"))
    )


def session_unique_hash(feed: DataFrame, sessions: DataFrame, transactions: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per session of the window. Metrics are NULL for sessions that are open or lie outside the minutes in
    which anything was announced; requests outside those minutes do not count.

    Announcements and requests meet the sessions by hour cells and are counted apart, so that no sketch is carried
    through the count of distinct hashes; sessions without a match come back in when only counts are left.
    """
    window = F.col("msg_timestamp").between(ntz(cfg.window_start), ntz(cfg.window_end))
    messages = hash_messages(feed).where(window)
    lo, hi = minute_range(messages)
    in_minutes = minute_bin(F.col("msg_timestamp")).between(F.lit(lo), F.lit(hi))

    announced = explode_hashes(messages, "peer_id", "node_id", "msg_timestamp").select(
        "peer_id", "node_id", "msg_timestamp", "tx_hash"
    )
    broadcasts = preconfirmation_join(announced, transactions, "left", cfg, after=cfg.window_start).select(
        "peer_id", "node_id", "msg_timestamp",
        F.when(F.col("copies").isNotNull(), F.col("tx_hash")).alias("confirmed_hash"),
        F.coalesce("copies", F.lit(1)).alias("announced"),
    )
    requests = request_messages(feed, cfg).where(in_minutes)

    chosen = sessions.where(F.col("start_time").between(ntz(cfg.window_start), ntz(cfg.window_end)))
    spans = (
        chosen.where((minute_bin(F.col("start_time")) <= F.lit(hi)) & (minute_bin(F.col("end_time")) >= F.lit(lo)))
        .where(minute_bin(F.col("start_time")) <= minute_bin(F.col("end_time")))
        .select(
            *SESSION,
            time_bucket("second", F.col("start_time")).alias("from_second"),
            time_bucket("second", F.col("end_time")).alias("to_second"),
        )
    )
    # No message lies outside [lo, hi], so cells beyond it are not generated.
    first_cell, last_cell = F.timestamp_seconds(F.lit(lo) * 60), F.timestamp_seconds(F.lit(hi) * 60 + 59)
    clipped = spans.withColumns(
        {
            "from_second": F.greatest("from_second", first_cell.cast("timestamp_ntz")),
            "to_second": F.least("to_second", last_cell.cast("timestamp_ntz") + F.expr("interval 1 second")),
        }
    )
    used = feed.where(window & F.col("msg_type").isin(*HASH_TYPES, GET_TYPE))
    hot = hot_keys(hourly_keys(used).withColumnRenamed("session_hour", "_cell"), ["peer_id", "node_id", "_cell"], cfg)

    def during_sessions(points: DataFrame) -> DataFrame:
        return points_in_intervals(points, clipped, ["peer_id", "node_id"], "from_second", "to_second", "hour", hot)

    heard = during_sessions(broadcasts).groupBy(*SESSION).agg(
        F.sum("announced").alias("total_hash_count"),
        F.count_distinct("confirmed_hash").alias("confirmed_distinct_tx_count"),
    )
    asked = during_sessions(requests).groupBy(*SESSION).agg(
        F.sum("asked").alias("total_get_hash_count"),
        estimate(combine(F.col("sketch"))).alias("distinct_get_hash_count"),
    )
    known = spans.select(*SESSION).distinct().join(heard, SESSION, "left").join(asked, SESSION, "left")
    zero = F.lit(0).cast("bigint")
    metrics = ("total_hash_count", "confirmed_distinct_tx_count", "distinct_get_hash_count")
    counted = known.withColumns({c: F.coalesce(c, zero) for c in metrics})
    minutes = F.col("session_duration_calculated") / F.lit(1e9) / F.lit(60)
    rates = counted.select(
        "peer_id", "node_id", "start_time",
        "total_hash_count", div0(F.col("total_hash_count"), minutes).alias("hash_per_minute"),
        "confirmed_distinct_tx_count",
        div0(F.col("confirmed_distinct_tx_count"), minutes).alias("confirmed_distinct_tx_per_minute"),
        "total_get_hash_count", div0(F.col("total_get_hash_count"), minutes).alias("get_hash_per_minute"),
        "distinct_get_hash_count",
        div0(F.col("distinct_get_hash_count"), minutes).alias("distinct_get_hash_per_minute"),
    )

    def passed_on(name: str, kind: str):
        return F.col(name) if name in sessions.columns else F.lit(None).cast(kind).alias(name)

    head = chosen.select(
        "peer_id", "node_id", "start_time", "end_time", "session_duration_calculated", "session_duration_hour",
        passed_on("msg_ct", "bigint"), passed_on("msg_per_minute", "double"),
    )
    return head.join(rates, ["peer_id", "node_id", "start_time"], "left")
