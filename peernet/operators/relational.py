"""Keyed selections, change detection, padded unions and first-seen merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peernet.functions.scalars import time_bucket


def _ranked(df: DataFrame, keys: list[str | Column], order: list[Column], limit: int) -> DataFrame:
    # rank <= constant becomes WindowGroupLimit: each task keeps at most `limit` rows per key before the shuffle.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, ties: list[str] | None = None) -> DataFrame:
    """Newest row per key. NULL counts as newest; ties go to the smallest remaining columns."""
    rest = ties if ties is not None else [c for c in df.columns if c not in (*keys, ts)]
    return _ranked(df, keys, [F.col(ts).desc_nulls_first(), *[F.col(c).asc_nulls_first() for c in rest]], 1)


def first_per_minute(df: DataFrame, keys: list[str], ts: str, ties: list[str] | None = None) -> DataFrame:
    """Earliest row of each key within each minute."""
    rest = ties if ties is not None else [c for c in df.columns if c not in (*keys, ts)]
    buckets: list[str | Column] = [*keys, time_bucket("minute", F.col(ts))]
    return _ranked(df, buckets, [F.col(ts).asc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest]], 1)


def bottom_k_per_group(df: DataFrame, group: str, measure: str, k: int, ties: list[str]) -> DataFrame:
    """The k rows of each group with the lowest measure."""
    order = [F.col(measure).asc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]]
    return _ranked(df, [group], order, k)


def union_pad(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one side lacks is a typed NULL."""
    return left.unionByName(right, allowMissingColumns=True)


def keep_earliest(new: DataFrame, target: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of `new` whose key the target lacks, or has with a later (or NULL) timestamp."""
    known = target.select(F.col(key).alias("_known_key"), F.col(ts).alias("_known_ts"))
    return (
        new.join(known, F.col(key) == F.col("_known_key"), "left")
        .where(F.col("_known_ts").isNull() | (F.col(ts) < F.col("_known_ts")))
        .drop("_known_key", "_known_ts")
    )


def lag_chunked(df: DataFrame, key: str, ts: str, value: str, ties: list[str], chunk: str) -> DataFrame:
    """Add `previous`: the value of the row before, per key in time order.

    One window over a whole key would put a busy key into one task. So the window runs per (key, chunk of time), and
    the last value of the chunk before enters each chunk as one more row at its start, from a small summary.
    """
    order = [F.col(ts).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties]]
    rows = df.withColumns({"_chunk": time_bucket(chunk, F.col(ts)), "_carried": F.lit(False)})
    position = F.struct(ts, *ties)
    last_of_chunk = rows.groupBy(key, "_chunk").agg(F.max(F.struct(position.alias("p"), F.col(value))).alias("_last"))
    across = Window.partitionBy(key).orderBy(F.col("_chunk").asc_nulls_first())
    carried = last_of_chunk.select(
        key, "_chunk", F.lag(F.col("_last")[value]).over(across).alias(value), F.lit(True).alias("_carried")
    )
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(F.desc("_carried"), *order)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn("previous", F.lag(value).over(in_chunk))
        .where(~F.col("_carried"))
        .drop("_chunk", "_carried")
    )


def changes(df: DataFrame, key: str, ts: str, value: str, ties: list[str], chunk: str) -> DataFrame:
    """Rows whose value differs from the row before, or that have no value before them.

    A row whose own value is NULL after a known one is not a change: the comparison is unknown.
    """
    compared = lag_chunked(df, key, ts, value, ties, chunk)
    return compared.where((F.col(value) != F.col("previous")) | F.col("previous").isNull())
