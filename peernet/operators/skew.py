"""Joins whose big side may have a key holding a large share of all rows.

`hot_keys` finds such keys with a mergeable frequent-items sketch over a sample: one small state per task, no shuffle
of the data. By counting, at most `hot_limit` keys can each hold more than 1/hot_limit of the rows, so the answer is
small whatever the input size. It is read once, before the join is planned: both sides then cut a key into the same
number of pieces, and a join without hot keys stays a plain one. A missed or surplus key only changes speed:
`salted_join` keeps every row for any set of hot keys, and adaptive skew-join splitting takes what was missed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig

HotKeys = dict[int, int]
NULL_PIECES = 1024


def hot_keys(rows: DataFrame, keys: list[str], cfg: RunConfig) -> HotKeys:
    """Fingerprints of the hot keys, each with the number of pieces of about `hot_min_rows` rows to cut it into."""
    return hot_key_sets(rows, {"": (keys, F.lit(True))}, cfg)[""]


def hot_key_sets(
    rows: DataFrame,
    keys: dict[str, tuple[list, Column]],
    cfg: RunConfig,
    unfold: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, HotKeys]:
    """The hot keys of several joins, in one pass: per name its key columns, and which rows have such a key.

    `unfold` makes the rows that are joined out of the sampled ones, where each holds several.
    """
    if cfg.hot_sample < 1:
        rows = rows.sample(cfg.hot_sample, seed=1)
    if unfold is not None:
        rows = unfold(rows)
    prints = [F.when(wanted, F.xxhash64(*columns)).alias(f"_p{i}") for i, (columns, wanted) in enumerate(keys.values())]
    sketch = "approx_top_k(_p{i}, {k}, {size}) FILTER (WHERE _p{i} IS NOT NULL)"
    tops = [F.expr(sketch.format(i=i, k=cfg.hot_limit, size=10 * cfg.hot_limit)).alias(f"_t{i}") for i in range(len(keys))]
    seen = rows.select(*prints).agg(*tops)
    piece = F.lit(max(cfg.hot_min_rows * cfg.hot_sample, 1.0))

    def large(i: int) -> Column:
        pieces = F.transform(
            f"_t{i}",
            lambda x: F.struct(
                F.lit(i).alias("i"),
                x["item"].alias("key_print"),
                F.when(x["count"] > piece, F.ceil(x["count"] / piece).cast("int")).alias("pieces"),
            ),
        )
        return F.filter(pieces, lambda x: x["pieces"].isNotNull())

    found: dict[str, HotKeys] = {name: {} for name in keys}
    names = list(keys)
    hot = seen.select(F.inline(F.concat(*[large(i) for i in range(len(names))])))
    for i, key_print, pieces in hot.take(cfg.hot_limit * len(names)):
        found[names[i]][key_print] = pieces
    return found


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str,
    hot: HotKeys,
    spread: list[str],
    residual: Column | None = None,
) -> DataFrame:
    """Join on `keys`, with hot keys of `big` cut into pieces and the matching rows of `small` repeated per piece.

    `how` is inner, or left with `big` preserved. The piece is a function of the `spread` columns and of the input
    partition, both of which a recomputed task reproduces, so losing an executor cannot move a row between pieces; and
    copies of one row spread too, since they lie in different partitions. Rows of `big` with a NULL key match nothing;
    in a left join they are spread over NULL_PIECES pieces. `residual` may name columns of both sides.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left keep every row once")
    left, right = big, small
    condition = F.lit(True) if residual is None else residual
    if hot:
        pieces = F.broadcast(big.sparkSession.createDataFrame(list(hot.items()), "_key_print bigint, _salts int"))
        key_print = F.xxhash64(*keys)
        piece = F.pmod(F.xxhash64(F.spark_partition_id(), *spread), F.col("_salts")).cast("int")
        left = (
            big.join(pieces, key_print == F.col("_key_print"), "left")
            .withColumn("_salt", F.coalesce(piece, F.lit(0)))
            .drop("_key_print", "_salts")
        )
        right = (
            small.join(pieces, key_print == F.col("_key_print"), "left")
            .withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
            .drop("_key_print", "_salts")
        )
        condition = condition & (F.col("_salt") == F.col("_r_salt"))
    if how == "left":
        # NULL keys have no partner, but all the same they would meet in one task.
        unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        salt = F.col("_salt") if hot else F.lit(0)
        spread_nulls = F.pmod(F.xxhash64(F.spark_partition_id(), *spread), F.lit(NULL_PIECES)).cast("int")
        left = left.withColumn("_salt", F.when(unknown, spread_nulls).otherwise(salt))
        if not hot:
            right = right.withColumn("_r_salt", F.lit(0))
            condition = condition & (F.col("_salt") == F.col("_r_salt"))
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(right, condition, how).drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])
