"""The run ledger: which block range each incremental table processes in each run."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz


class IncompleteRunError(RuntimeError):
    """A table's last run never finished."""


def incremental_models(spark: SparkSession, tables: list[str], chains: tuple[str, ...]) -> DataFrame:
    """Every table with every chain, as rows; both lists are configuration."""
    pairs = [(t.upper(), c) for t, c in product(tables, chains)]
    return spark.createDataFrame(pairs, "incremental_table string, blockchain string")


def safe_block(sources: dict[str, list[DataFrame]], cfg: RunConfig) -> DataFrame:
    """Per chain, the newest block that all its source tables held when the run started."""
    newest = [
        table.where(F.col("inserted_at") < cfg.run_stamp).agg(
            F.lit(chain).alias("blockchain"), F.max("blk_number").alias("newest")
        )
        for chain, tables in sources.items()
        for table in tables
    ]
    return (
        reduce(DataFrame.unionByName, newest)
        .groupBy("blockchain")
        .agg(F.min("newest").alias("run_stop_blk_number"))
    )


def plan_run(ledger: DataFrame, models: DataFrame, sources: dict[str, list[DataFrame]], cfg: RunConfig) -> DataFrame:
    """New ledger rows: from the block after the last completed stop to the safe block.

    A full refresh instead goes from block 1 to the last completed stop.
    """
    done = ledger.where(F.col("run_completed")).select("incremental_table", "blockchain", "run_stop_blk_number")
    previous = (
        models.join(done, ["incremental_table", "blockchain"], "left")
        .groupBy("incremental_table", "blockchain")
        .agg(F.max(F.coalesce("run_stop_blk_number", F.lit(0))).alias("previous_stop"))
    )
    if cfg.full_refresh:
        bounded = previous.withColumns(
            {"run_start_blk_number": F.lit(1).cast("bigint"), "run_stop_blk_number": F.col("previous_stop")}
        )
    else:
        bounded = previous.withColumn("run_start_blk_number", F.col("previous_stop") + 1).join(
            safe_block(sources, cfg), "blockchain", "inner"
        )
    return bounded.select(
        cfg.run_stamp.alias("run_timestamp"),
        "blockchain",
        "incremental_table",
        F.lit(False).alias("run_completed"),
        "run_start_blk_number",
        "run_stop_blk_number",
    )


def incomplete_runs(ledger: DataFrame, tables: list[str]) -> DataFrame:
    """(blockchain, incremental_table, runs) of the tables whose newest run is not completed."""
    return (
        ledger.where(F.col("incremental_table").isin([t.upper() for t in tables]))
        .groupBy("blockchain", "incremental_table")
        .agg(F.max_by("run_completed", "run_timestamp").alias("last"), F.count(F.lit(1)).alias("runs"))
        .where(~F.col("last"))
        .drop("last")
    )


def assert_no_running(ledger: DataFrame, tables: list[str]) -> None:
    running = incomplete_runs(ledger, tables).agg(F.sum("runs")).first()[0]
    if running:
        raise IncompleteRunError("incomplete run(s) found; aborting until they finish")


def mark_completed(ledger: DataFrame, table: str, cfg: RunConfig) -> DataFrame:
    this_run = (F.col("run_timestamp") == cfg.run_stamp) & (F.col("incremental_table") == table.upper())
    return ledger.withColumn("run_completed", F.when(this_run, F.lit(True)).otherwise(F.col("run_completed")))


def run_block_range(ledger: DataFrame, run_timestamp: str) -> DataFrame:
    """Per chain, the range that covers all tables of one run: coarse, for pruning the source scan."""
    return (
        ledger.where(F.col("run_timestamp") == ntz(run_timestamp))
        .groupBy("blockchain")
        .agg(F.min("run_start_blk_number").alias("lo"), F.max("run_stop_blk_number").alias("hi"))
    )


def table_block_range(ledger: DataFrame, run_timestamp: str, table: str) -> DataFrame:
    """Per chain, the range of one table in one run."""
    return run_block_range(ledger.where(F.col("incremental_table") == table.upper()), run_timestamp)


def in_block_ranges(rows: DataFrame, ranges: DataFrame, chains: tuple[str, ...]) -> DataFrame:
    """Rows inside their chain's range; chains without a range are dropped.

    The ranges (one row per configured chain) are read first, so the bounds reach the scan as literals.
    """
    bounds = ranges.where(F.col("blockchain").isin(*chains)).take(len(chains))
    inside = F.lit(False)
    for chain, lo, hi in bounds:
        inside = inside | ((F.col("blockchain") == chain) & F.col("blk_number").between(F.lit(lo), F.lit(hi)))
    return rows.where(inside)
