"""The input tables of the engine, derived by Spark from the driver's tables (see FIXTURES.md).

The engine expects its inputs as stored tables. So each derived table is landed once per session as Parquet in the
shared folder, the feed partitioned by message type, and every query reads it from there, with pruning. A driver table
that changes is landed again.
"""

from __future__ import annotations

import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peernet.config import GENESIS_HASH, HASH_TYPES, RunConfig, shared_dir
from peernet.schemas import SCHEMAS
from peernet.sources.loaders import load
from peernet.sources.tables import modified

CFG = RunConfig(
    run_started_at="2024-01-31 00:00:00", as_of="2024-01-31 00:00:00", initial_bound="2024-01-01 00:00:00"
)

# Fixed values of the check data: 25 country codes for the address blocks, and two more without a block.
COUNTRIES = [
    ("NA", "Namibia", "Africa"), ("AQ", "Antarctica", None), ("US", "United States", "Americas"),
    ("DE", "Germany", "Europe"), ("FR", "France", "Europe"), ("GB", "United Kingdom", "Europe"),
    ("NL", "Netherlands", "Europe"), ("CA", "Canada", "Americas"), ("JP", "Japan", "Asia"),
    ("KR", "Korea", "Asia"), ("CN", "China", "Asia"), ("SG", "Singapore", "Asia"),
    ("AU", "Australia", "Oceania"), ("BR", "Brazil", "Americas"), ("IN", "India", "Asia"),
    ("FI", "Finland", "Europe"), ("SE", "Sweden", "Europe"), ("PL", "Poland", "Europe"),
    ("IT", "Italy", "Europe"), ("ES", "Spain", "Europe"), ("CH", "Switzerland", "Europe"),
    ("IE", "Ireland", "Europe"), ("ZA", "South Africa", "Africa"), ("MX", "Mexico", "Americas"),
    ("AR", "Argentina", "Americas"), ("XK", "Kosovo", None), ("BQ", "Bonaire, Sint Eustatius and Saba", "Americas"),
]
BLOCK_CODES = [code for code, _, _ in COUNTRIES[:25]]


def _hash(x: Column) -> Column:
    return F.sha2(x.cast("string"), 256)


def _public_key(user: Column) -> Column:
    return F.concat(_hash(F.concat(F.lit("a"), user)), _hash(F.concat(F.lit("b"), user)))


def _plus_ms(ts: Column, ms: int) -> Column:
    return ts + F.expr(f"interval {ms} milliseconds")


class Derived:
    """The input tables as lazy frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet").withColumn("k", k)

    @cached_property
    def client(self) -> Column:
        k = F.col("k")
        nethermind = F.concat(F.lit("Nethermind/v1.2."), k % 3, F.lit("/linux-x64/dotnet8"))
        geth = F.concat(F.lit("Geth/v1.13."), k % 5, F.lit("-stable/linux-amd64/go1.21"))
        return F.when(k % 4 == 0, nethermind).otherwise(geth)

    @cached_property
    def host(self) -> Column:
        return F.concat(F.lit("10."), F.col("user_id") % 30, F.lit(".0."), F.col("k"))

    @cached_property
    def network_feed(self) -> DataFrame:
        k, event_id, ts = F.col("k"), F.col("event_id"), F.col("ts")
        block = event_id % 100
        text = F.lit

        def messages(event_type: str, kind: Column, data: Column, delay_ms: int = 0, only: Column | None = None):
            rows = self.events.where(F.col("event_type") == event_type)
            rows = rows if only is None else rows.where(only)
            return rows.select(
                _plus_ms(ts, delay_ms).alias("msg_timestamp"),
                F.concat(text("n"), event_id % 2).alias("node_id"),
                F.sha2(F.unhex(_public_key(F.col("user_id").cast("string"))), 256).alias("peer_id"),
                kind.alias("msg_type"),
                data.alias("msg_data"),
            )

        def hashes(factor: int) -> Column:
            return F.transform(
                F.sequence(text(0), k % 4), lambda i: F.concat(text("0x"), _hash((event_id * factor + i * 7) % 500))
            )

        nothing = F.array().cast("array<string>")
        parts = [
            messages("signup", text("peer_set_add"), nothing),
            messages(
                "error",
                text("peer_set_remove"),
                F.array(text("r"), text("x"), (k.cast("bigint") * 1_000_000_000).cast("string")),
            ),
            messages("purchase", text(CFG.node_start_type), nothing, only=event_id % 7 == 0),
            messages(
                "signup",
                text("node_tracker"),
                F.array(
                    _public_key(F.col("user_id").cast("string")),
                    text("5"),
                    self.client,
                    text('["eth/67","eth/68"]'),
                    F.when(event_id % 11 != 0, F.concat(self.host, text(":30303"))),
                ),
                10,
            ),
            messages(
                "signup",
                text("handshake_eth"),
                F.array(
                    F.when(k % 10 == 9, text("5")).otherwise(text("1")),
                    text("x"),
                    text(GENESIS_HASH),
                    F.concat(text("0x"), _hash(F.concat(text("blk"), block))),
                    F.concat(text("0x"), _hash(F.concat(text("blk"), block - event_id % 3))),
                ),
                20,
            ),
            *[
                messages("view", text(kind), hashes(31), only=event_id % 3 == i) for i, kind in enumerate(HASH_TYPES)
            ],
            messages("click", text("get_tx_66"), hashes(17)),
        ]
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def eth_transaction(self) -> DataFrame:
        key = F.col("o_orderkey")
        minutes = (key % 500) * 80
        orders = self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")
        mined = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))
        return orders.select(
            (F.floor(key / 10) + 1).alias("blk_number"),
            mined.alias("blk_timestamp"),
            F.concat(F.lit("0x"), _hash(key)).alias("tx_hash"),
            (key % 10).cast("int").alias("tx_index"),
            F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("tx_status"),
            F.concat(F.lit("0x"), _hash(F.col("o_custkey"))).alias("tx_from"),
            F.concat(F.lit("0x"), _hash(F.concat(F.lit("to"), F.col("o_custkey")))).alias("tx_to"),
            F.lit(1.0).alias("tx_gas_price"),
            F.lit(21000.0).alias("tx_gas_used"),
            F.col("o_totalprice").alias("tx_value"),
            (mined + F.expr("interval 1 minute")).alias("inserted_at"),
        )

    @cached_property
    def block_header(self) -> DataFrame:
        n = self.events.select((F.col("event_id") % 100).alias("n")).distinct()
        return n.select(
            (F.col("n") + 1000).alias("blk_number"), F.unhex(_hash(F.concat(F.lit("blk"), F.col("n")))).alias("blk_hash")
        )

    def _sightings(self, remainder: int) -> DataFrame:
        return self.events.where((F.col("event_type") == "purchase") & (F.col("event_id") % 2 == remainder))

    @cached_property
    def ethernodes_tracker(self) -> DataFrame:
        c = self.client
        return self._sightings(0).select(
            _public_key(F.col("user_id").cast("string")).alias("node_id"),
            self.host.alias("host_address"),
            F.concat(F.lit("isp"), F.col("k") % 5).alias("isp"),
            F.element_at(F.array(*[F.lit(x) for x in BLOCK_CODES]), (F.col("user_id") % 25 + 1).cast("int")).alias(
                "country"
            ),
            F.split_part(c, F.lit("/"), F.lit(1)).alias("client_type"),
            F.split_part(c, F.lit("/"), F.lit(2)).alias("client_version"),
            F.split_part(c, F.lit("/"), F.lit(3)).alias("os"),
            (F.col("k") % 2 == 0).alias("in_sync"),
            F.col("ts").alias("last_seen"),
        )

    @cached_property
    def node_tracker(self) -> DataFrame:
        c = self.client
        return self._sightings(1).select(
            _public_key(F.col("user_id").cast("string")).alias("node_id"),
            self.host.alias("host"),
            (F.lit(30303) + F.col("k") % 3).cast("int").alias("port"),
            F.element_at(F.array(*[F.lit(x) for x in BLOCK_CODES]), (F.col("user_id") % 25 + 1).cast("int")).alias(
                "country"
            ),
            F.split_part(c, F.lit("/"), F.lit(1)).alias("client"),
            F.split_part(c, F.lit("/"), F.lit(4)).alias("type"),
            F.split_part(c, F.lit("/"), F.lit(3)).alias("os"),
            F.col("ts").alias("last_seen"),
        )

    @cached_property
    def geo_blocks(self) -> DataFrame:
        """Per network 10.i/16: the whole of it, a nested /26 (even i), and a range that is no network (i % 5 = 0)."""
        i = F.col("i")
        nets = self.events.select((F.col("user_id") % 30).alias("i")).distinct().where(i < len(BLOCK_CODES))
        base = F.lit(10 * 16777216) + i * 65536
        code = F.element_at(F.array(*[F.lit(x) for x in BLOCK_CODES]), (i + 1).cast("int"))

        def blocks(lo: int, hi: int, city: str, only: Column, subdivision: Column) -> DataFrame:
            return nets.where(only).select(
                (base + lo).alias("start_ip"),
                (base + hi).alias("end_ip"),
                code.alias("country_code"),
                F.concat(F.lit(city), i).alias("city"),
                subdivision.alias("subdivision"),
            )

        none = F.lit(None).cast("string")
        return (
            blocks(0, 65535, "city", F.lit(True), F.concat(F.lit("sub"), i))
            .unionByName(blocks(0, 63, "inner", i % 2 == 0, none))
            .unionByName(blocks(70, 90, "odd", i % 5 == 0, none))
        )

    @cached_property
    def run_ledger(self) -> DataFrame:
        """A past run per 100 blocks; of every seven, the last did not complete. The last run is never complete."""
        run = F.floor(F.col("blk_number") / 100)
        last = self.eth_transaction.agg(F.max(run)).scalar()
        return (
            self.eth_transaction.groupBy(run.alias("r"))
            .agg(F.min("blk_number").alias("lo"), F.max("blk_number").alias("hi"))
            .select(
                (
                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("r").cast("int"))
                ).alias("run_timestamp"),
                F.lit("ethereum").alias("blockchain"),
                F.lit("FACT_TRANSACTION__TX_HASH").alias("incremental_table"),
                ((F.col("r") % 7 != 0) & (F.col("r") != last)).alias("run_completed"),
                F.col("lo").alias("run_start_blk_number"),
                F.col("hi").alias("run_stop_blk_number"),
            )
        )


# What each landed table is derived from.
_ORIGIN = {"eth_transaction": "orders", "run_ledger": "orders"}
_LANDED: dict[tuple[str, str, str, str], str] = {}


class Inputs:
    """The landed input tables of one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.derived = Derived(spark, sf_dir)

    def landed(self, name: str, partition_by: list[str] | None = None) -> DataFrame:
        origin = f"{self.sf_dir}/{_ORIGIN.get(name, 'events')}.parquet"
        key = (self.spark.sparkContext.applicationId, name, origin, modified(self.spark, origin))
        if key not in _LANDED:
            root = f"{shared_dir(self.spark)}/inputs-{uuid.uuid4().hex}"
            getattr(self.derived, name).write.partitionBy(*(partition_by or [])).parquet(f"{root}/{name}")
            _LANDED[key] = root
        return load(self.spark, _LANDED[key], name)

    @cached_property
    def feed(self) -> DataFrame:
        return self.landed("network_feed", ["msg_type"])

    @cached_property
    def transactions(self) -> DataFrame:
        return self.landed("eth_transaction")

    @cached_property
    def block_header(self) -> DataFrame:
        return self.landed("block_header")

    @cached_property
    def ethernodes(self) -> DataFrame:
        return self.landed("ethernodes_tracker")

    @cached_property
    def etherscan(self) -> DataFrame:
        return self.landed("node_tracker")

    @cached_property
    def geo_blocks(self) -> DataFrame:
        return self.landed("geo_blocks")

    @cached_property
    def ledger(self) -> DataFrame:
        return self.landed("run_ledger")

    @cached_property
    def country_code(self) -> DataFrame:
        return self.spark.createDataFrame(COUNTRIES, SCHEMAS["country_code"])
