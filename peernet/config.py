"""Settings of one run. Every job takes a RunConfig, so a run never depends on the wall clock."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Message types of the feed and the main-net identity.
PEER_ADD = "peer_set_add"
PEER_REMOVE = "peer_set_remove"
HANDSHAKE = "handshake_eth"
NODE_TRACKER = "node_tracker"
HASH_TYPES = ("new_hash", "new_hash_66", "new_hash_68")
GET_TYPE = "get_tx_66"
MAINNET = 1
GENESIS_HASH = "0xd4e56740f876aef8c010b86a40d5f56745a118d0906a34e69aec8c0db1cb8fa3"


@dataclass(frozen=True)
class RunConfig:
    run_started_at: str
    as_of: str
    initial_bound: str = "2024-02-01 00:00:00"
    window_start: str = "2024-01-22 00:00:00"
    window_end: str = "2024-01-29 00:00:00"
    chains: tuple[str, ...] = ("ethereum",)
    # The text a local node writes into the feed when it starts; it closes every session that node had open.
    node_start_type: str = "node_start"
    # Announcements that reach the feed up to so many hours late still count; the merge only moves sightings back.
    late_hours: int = 14
    environment: str = "production"
    full_refresh: bool = False
    # Windows over one peer's history run per time chunk, so a busy peer is spread over many tasks.
    chunk: str = "hour"
    # A join key is hot above hot_min_rows, and is cut into pieces of that size; the hot_limit most frequent keys can be.
    # They are looked for in a sample of the rows.
    hot_limit: int = 1000
    hot_min_rows: int = 1_000_000
    hot_sample: float = 0.01

    @property
    def run_stamp(self) -> Column:
        return ntz(self.run_started_at)


def ntz(text: str | None) -> Column:
    """Timestamp literal without zone (NULL for None)."""
    return F.lit(text).cast("timestamp_ntz")


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on; nothing here needs a new session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Sessions grow when cut into hours, so small partitions of them are worth a task of their own.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    return spark


def named_shared_dir(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for staged tables: the one named in spark.checkpoint.dir.

    Where that is unset, as in tests, the application's own folder under the warehouse; `clear_shared_dir` deletes it. The
    session's settings stay as they are.
    """
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged/{spark.sparkContext.applicationId}"
    return (named_shared_dir(spark) or own).rstrip("/")


def clear_shared_dir(spark: SparkSession) -> None:
    """Delete the application's own staging folder at its end; a named folder is left to its owner."""
    if named_shared_dir(spark) is None:
        path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
