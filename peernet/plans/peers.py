"""Known nodes: one row per public key and crawler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig
from peernet.functions.hashing import Digest, keccak256_hex
from peernet.functions.scalars import epoch_us
from peernet.operators.relational import union_pad
from peernet.plans.staging import stage_ethernodes, stage_etherscan

KEY = "node_public_key"


def _roll_up(staged: DataFrame, dimensions: list[str], digest: Digest) -> DataFrame:
    """First and last sighting with the newest dimensions: one aggregation, one row per key and task shuffled.

    A NULL sighting time counts as newest; ties go to the smallest dimensions. The digest runs once per key, after.
    """
    newest_first: Column = F.struct(
        F.col("last_seen").isNotNull(), -epoch_us(F.col("last_seen")), *[F.col(d) for d in dimensions]
    )
    return (
        staged.groupBy(KEY)
        .agg(
            F.min("last_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.min_by(F.struct(*dimensions), newest_first).alias("d"),
        )
        .select(digest(F.col(KEY)).alias("node_id"), KEY, "first_seen", "last_seen", "d.*")
    )


def tracker_ethernodes(raw: DataFrame, cfg: RunConfig, digest: Digest = keccak256_hex) -> DataFrame:
    columns = ["ip", "isp", "country", "client_type", "client_version", "os", "in_sync"]
    return _roll_up(stage_ethernodes(raw, cfg), columns, digest)


def tracker_etherscan(raw: DataFrame, cfg: RunConfig, digest: Digest = keccak256_hex) -> DataFrame:
    columns = ["ip", "port", "country", "client_type", "run_time_version", "os"]
    return _roll_up(stage_etherscan(raw, cfg), columns, digest)


def dim_peers(ethernodes: DataFrame, etherscan: DataFrame) -> DataFrame:
    both = union_pad(
        ethernodes.withColumn("source", F.lit("ethernodes")), etherscan.withColumn("source", F.lit("etherscan"))
    )
    return both.select(
        "node_id", KEY, "first_seen", "last_seen", "ip", "port", "isp", "country", "client_type", "client_version",
        "run_time_version", "os", "in_sync", "source",
    )
