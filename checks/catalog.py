"""One query per operator and dataset, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, TimestampNTZType

from checks.adapters import CFG, Inputs
from peernet.config import GET_TYPE, HANDSHAKE, HASH_TYPES, PEER_ADD, PEER_REMOVE, configure, ntz
from peernet.config import shared_dir
from peernet.functions.arrays import duplicate_indices, index_of, remove_indices
from peernet.functions.hashing import keccak256_hex, sha256_hex
from peernet.functions.scalars import (
    bytes_to_hex,
    div0,
    enode,
    epoch_us,
    hex_to_bytes,
    minute_bin,
    minutes_crossed,
    null_greatest,
    null_least,
    time_bucket,
)
from peernet.operators import ledger as runs
from peernet.operators.confirmation import explode_hashes, hash_messages, preconfirmation_join
from peernet.operators.geo import geoip_enrich
from peernet.operators.intervals import hour_slices, hourly_keys, points_in_hour_slices, points_in_intervals
from peernet.operators.relational import bottom_k_per_group, first_per_minute, latest_per_key, union_pad
from peernet.operators.sessions import high_water, late_durations, sessionize
from peernet.operators.skew import hot_keys
from peernet.operators.sketches import accumulate, combine, estimate
from peernet.plans.hourly import hourly_bounds, hourly_performance, hourly_window
from peernet.plans.mempool import MEMPOOL, fact_mempool, first_seen, merge_first_seen
from peernet.plans.peers import dim_peers, tracker_etherscan, tracker_ethernodes
from peernet.plans.performance import peer_performance, public_mempool_hourly, sync_lag, version_changes
from peernet.plans.propagation import announcement_orders, fact_hash, recent_messages
from peernet.plans.runs import (
    HASHES,
    HOURLY,
    PERFORMANCE,
    SESSIONS,
    TRANSACTIONS,
    Sources,
    run_analysis,
    run_hourly,
    update_hours,
)
from peernet.plans.session_hashes import minute_range, session_unique_hash
from peernet.plans.sessions import (
    fact_peer_session,
    handshakes,
    join_crawlers,
    join_same_minute,
    sync_gap,
    tracker_addresses,
    tracker_messages,
)
from peernet.plans.staging import TRANSACTION_TABLE, fact_transaction, stage_ethernodes, stage_etherscan
from peernet.plans.staging import stage_transactions
from peernet.plans.undersampled import hash_counts, undersampled_peers
from peernet.schemas import SCHEMAS
from peernet.sources.export import export_csv, performance_rows, undersampled_rows
from peernet.sources.loaders import freshness, load_country_codes, scan_feed
from peernet.sources.tables import Tables

SINCE = CFG.initial_bound
CUT = "2024-01-16 00:00:00"
FIRST_RUN = "2024-01-01 00:30:00"
ONE_RUN = "2024-01-01 01:00:00"


class Models(Inputs):
    """Inputs plus the lazy models over them."""

    @cached_property
    def staged(self) -> DataFrame:
        return stage_transactions(self.transactions, CFG)

    @cached_property
    def sessions(self) -> DataFrame:
        return sessionize(self.feed, CFG, SINCE)

    @cached_property
    def peers(self) -> DataFrame:
        return dim_peers(
            tracker_ethernodes(self.ethernodes, CFG, sha256_hex), tracker_etherscan(self.etherscan, CFG, sha256_hex)
        )

    @cached_property
    def fact_sessions(self) -> DataFrame:
        return fact_peer_session(
            self.feed, self.block_header, self.geo_blocks, self.country_code, self.peers, CFG, SINCE
        )

    @cached_property
    def built_sessions(self) -> DataFrame:
        """The session fact as the stored table that the models after it read."""
        return self.tables().replace(self.fact_sessions, "fact_peer_session")

    @cached_property
    def built_spans(self) -> DataFrame:
        """Sessions without enrichment, stored, for the jobs that need no more of the fact."""
        return self.tables().replace(self.sessions, "spans")

    @cached_property
    def built_hourly(self) -> DataFrame:
        window = hourly_window(None, self.built_sessions, self.staged, CFG)
        return hourly_performance(self.feed, self.built_sessions, self.staged, *window, CFG)

    @cached_property
    def bounds(self) -> tuple[str | None, str | None]:
        return hourly_window(None, self.built_spans, self.staged, CFG)

    @cached_property
    def hourly(self) -> DataFrame:
        return hourly_performance(self.feed, self.built_spans, self.staged, *self.bounds, CFG)

    @cached_property
    def mempool(self) -> DataFrame:
        return first_seen(self.feed, SINCE)

    @cached_property
    def announced(self) -> DataFrame:
        return explode_hashes(hash_messages(self.feed), "peer_id", "node_id", "msg_timestamp").select(
            "peer_id", "node_id", "msg_timestamp", "tx_hash"
        )

    @cached_property
    def undersampled(self) -> DataFrame:
        return undersampled_peers(self.built_hourly, self.built_sessions, CFG)

    @cached_property
    def performance(self) -> DataFrame:
        return peer_performance(self.built_hourly, self.built_sessions, self.mempool, self.staged, CFG)

    def tables(self) -> Tables:
        return Tables(self.spark, f"{shared_dir(self.spark)}/peernet-{uuid.uuid4().hex}")


def flat(df: DataFrame) -> DataFrame:
    """Bytes as hex text and arrays as joined text, so that results compare the same in every engine."""

    def text(field) -> F.Column:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, BinaryType):
            return F.lower(F.hex(c))
        if isinstance(kind, ArrayType):
            if isinstance(kind.elementType, TimestampNTZType):
                c = F.transform(c, epoch_us)
            elif isinstance(kind.elementType, BinaryType):
                c = F.transform(c, lambda x: F.lower(F.hex(x)))
            return F.array_join(c.cast("array<string>"), ",")
        return c

    return df.select(*[text(f).alias(f.name) for f in df.schema.fields])


def _scan_feed(m: Models) -> DataFrame:
    rows = scan_feed(m.feed, (PEER_ADD, HANDSHAKE), "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return rows.select("msg_timestamp", "node_id", "peer_id", "msg_type")


def _seed_country(m: Models) -> DataFrame:
    folder = f"{shared_dir(m.spark)}/peernet-{uuid.uuid4().hex}/country_code"
    m.country_code.write.csv(folder, header=True)
    seen = tracker_addresses(m.feed, SINCE)
    sightings = geoip_enrich(seen, "peer_ip", m.geo_blocks, CFG, seen, []).groupBy("peer_country_code").count()
    return (
        load_country_codes(m.spark, folder)
        .join(sightings, F.col("country_code") == F.col("peer_country_code"), "left")
        .select("country_code", "country_name", "region", F.coalesce("count", F.lit(0)).alias("sightings"))
    )


def _replace_table(m: Models) -> DataFrame:
    tables = m.tables()
    first = tables.replace(m.peers, "dim_peers", cluster_by="node_id")
    return tables.replace(first.where(F.col("source") == "etherscan"), "dim_peers", cluster_by="node_id").select(
        "node_id", "first_seen", "last_seen", "source"
    )


def _append_increment(m: Models) -> DataFrame:
    """Two ledger runs, the second continuing where the first one stopped."""
    tables, ledger = m.tables(), m.spark.createDataFrame([], SCHEMAS["run_ledger"])
    models = runs.incremental_models(m.spark, [TRANSACTION_TABLE], CFG.chains)
    for started in (FIRST_RUN, CFG.run_started_at):
        cfg = replace(CFG, run_started_at=started)
        planned = runs.plan_run(ledger, models, {"ethereum": [m.transactions]}, cfg)
        ledger = tables.replace(ledger.unionByName(planned), "ledger")
        tables.append(fact_transaction(m.transactions, cfg, ledger), "fact_transaction", cluster_by="tx_hash")
        ledger = tables.replace(runs.mark_completed(ledger, TRANSACTION_TABLE, cfg), "ledger")
    return flat(tables.read("fact_transaction").select("run_timestamp", "blk_number", "tx_hash", "tx_value"))


def _upsert_by_key(m: Models) -> DataFrame:
    """Sessions up to a cut, then the rest: sessions left open are closed in place."""
    tables = m.tables()
    columns = ["peer_id", "node_id", "start_time", "end_time"]
    keys = ["peer_id", "start_time", "node_id"]
    early = sessionize(m.feed.where(F.col("msg_timestamp") <= ntz(CUT)), CFG, SINCE)
    tables.upsert(early.select(*columns), "sessions", keys, "start_time")
    late = sessionize(m.feed, CFG, CUT, tables.read("sessions"))
    tables.upsert(late.select(*columns), "sessions", keys, "start_time")
    return tables.read("sessions").select(*columns)


def _cluster_write(m: Models) -> DataFrame:
    tables = m.tables()
    rows = m.sessions.select("peer_id", "node_id", "start_time", "end_time")
    return tables.replace(rows, "sessions", cluster_by="peer_id")


def _export_csv_roundtrip(m: Models) -> DataFrame:
    target = f"{shared_dir(m.spark)}/peernet-{uuid.uuid4().hex}/undersampled_peers.csv.gz"
    export_csv(m.undersampled.select("peer_region", "enode", "hash_ct"), target)
    return m.spark.read.csv(target, schema="peer_region string, enode string, hash_ct bigint", header=True)


def _filter_predicates(m: Models) -> DataFrame:
    ts, kind = F.col("msg_timestamp"), F.col("msg_type")
    chosen = (kind.isin(*HASH_TYPES) & ts.between(ntz("2024-01-05 00:00:00"), ntz("2024-01-07 00:00:00"))) | (
        (kind == PEER_REMOVE) & (ts >= ntz("2024-01-29 00:00:00"))
    )
    return m.feed.where(chosen & F.col("peer_id").isNotNull()).select("msg_timestamp", "node_id", "peer_id", "msg_type")


def _block_range_filter(m: Models) -> DataFrame:
    ranges = runs.table_block_range(m.ledger, ONE_RUN, TRANSACTION_TABLE)
    return flat(runs.in_block_ranges(m.staged, ranges, CFG.chains).select("blk_number", "tx_index", "tx_hash"))


def _confirmed_text(m: Models) -> DataFrame:
    return m.staged.select(bytes_to_hex(F.col("tx_hash")).alias("tx_hash"), "blk_number", "blk_timestamp")


def _preconfirmation_join(m: Models) -> DataFrame:
    joined = preconfirmation_join(m.announced, m.staged, "left", CFG)
    return flat(
        joined.select(
            "peer_id", "node_id", "msg_timestamp", "tx_hash", "blk_timestamp",
            F.col("copies").isNotNull().alias("is_sent_pre_confirmation"),
        )
    )


def _interval_join_hourly(m: Models) -> DataFrame:
    messages = hash_messages(m.feed)
    hot = hot_keys(hourly_keys(messages), ["peer_id", "node_id", "session_hour"], CFG)
    slices = hour_slices(m.built_spans, *m.bounds)
    return flat(
        points_in_hour_slices(m.announced, slices, hot).select(
            "peer_id", "node_id", "session_hour", "start_time", "end_time", "msg_timestamp", "tx_hash"
        )
    )


def _interval_join_binned(m: Models) -> DataFrame:
    spans = m.sessions.where(F.col("end_time").isNotNull()).select("peer_id", "node_id", "start_time", "end_time")
    spans = spans.withColumns(
        {"a": time_bucket("second", F.col("start_time")), "b": time_bucket("second", F.col("end_time"))}
    )
    points = m.feed.where(F.col("msg_type") == GET_TYPE).select("peer_id", "node_id", "msg_timestamp", "msg_type")
    hot = hot_keys(
        hourly_keys(points).withColumnRenamed("session_hour", "_cell"), ["peer_id", "node_id", "_cell"], CFG
    )
    return points_in_intervals(points, spans, ["peer_id", "node_id"], "a", "b", "hour", hot).select(
        "peer_id", "node_id", "start_time", "end_time", "msg_timestamp"
    )


def _models_to_run(m: Models) -> DataFrame:
    return runs.incremental_models(m.spark, [TRANSACTION_TABLE, "FACT_NEW"], CFG.chains)


def _ledger_plan(m: Models) -> DataFrame:
    return runs.plan_run(m.ledger, _models_to_run(m), {"ethereum": [m.transactions]}, CFG)


def _ledger_full_refresh(m: Models) -> DataFrame:
    return runs.plan_run(m.ledger, _models_to_run(m), {}, replace(CFG, full_refresh=True))


def _fact_transaction(m: Models) -> DataFrame:
    planned = _ledger_plan(m).where(F.col("incremental_table") == TRANSACTION_TABLE)
    return flat(fact_transaction(m.transactions, CFG, m.ledger.unionByName(planned)))


def _hex_key_join(m: Models) -> DataFrame:
    blocks = m.block_header.select(bytes_to_hex(F.col("blk_hash")).alias("local_block_hash"), "blk_number")
    return (
        handshakes(m.feed, SINCE)
        .join(blocks, "local_block_hash", "inner")
        .select("peer_id", "msg_timestamp", "local_block_hash", "blk_number")
    )


def _role_playing_join(m: Models) -> DataFrame:
    spans = m.sessions.select("peer_id", "node_id", "start_time")
    adds = m.feed.where(F.col("msg_type") == PEER_ADD).select("peer_id")
    return join_crawlers(spans, m.peers, hot_keys(adds, ["peer_id"], CFG))


def _first_seen_upsert(m: Models) -> DataFrame:
    """The target knows only the sightings after the cut, so most hashes come back earlier, and some are new."""
    known = first_seen(m.feed, CUT)
    return fact_mempool(m.feed, known, SINCE, CFG)


def _first_seen_increments(m: Models) -> DataFrame:
    """The stored merge over three batches, newest first, so that sightings move back over dates."""
    tables = m.tables()
    parts = F.pmod(F.xxhash64("msg_timestamp"), F.lit(4))
    late, early = F.col("msg_timestamp") > ntz(CUT), F.col("msg_timestamp") <= ntz(CUT)
    for batch in (late & (parts > 0), early, parts == 0):
        merge_first_seen(hash_messages(m.feed.where(batch)), tables, CFG)
    return tables.read(MEMPOOL).drop("_date")


def _geoip_enrich(m: Models) -> DataFrame:
    seen = tracker_addresses(m.feed, SINCE)
    rows = tracker_messages(m.feed, SINCE).select("node_id", "peer_id", "msg_timestamp", "peer_ip")
    return geoip_enrich(rows, "peer_ip", m.geo_blocks, CFG, seen, ["peer_id", "msg_timestamp"])


def _explode_hashes(m: Models) -> DataFrame:
    return flat(explode_hashes(hash_messages(m.feed), "node_id", "peer_id", "msg_timestamp", "msg_type"))


def _number_range(m: Models) -> DataFrame:
    messages = hash_messages(m.feed)
    lo, hi = minute_range(messages)
    per_minute = messages.groupBy(minute_bin(F.col("msg_timestamp")).alias("bin_num")).agg(
        F.count(F.lit(1)).alias("messages")
    )
    return (
        m.spark.range(lo, hi + 1)
        .withColumnRenamed("id", "bin_num")
        .join(per_minute, "bin_num", "left")
        .select("bin_num", F.coalesce("messages", F.lit(0)).alias("messages"))
    )


def _seen_range(m: Models) -> DataFrame:
    return (
        stage_ethernodes(m.ethernodes, CFG)
        .groupBy("node_public_key")
        .agg(F.min("last_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    )


def _feed_bounds(m: Models) -> DataFrame:
    return (
        hash_messages(m.feed)
        .agg(F.min("msg_timestamp").alias("start_time"), F.max("msg_timestamp").alias("end_time"))
        .withColumns(
            {"bin_num_start": minute_bin(F.col("start_time")), "bin_num_end": minute_bin(F.col("end_time"))}
        )
    )


def _conditional_agg(m: Models) -> DataFrame:
    gaps = sync_gap(m.feed, m.block_header, SINCE, CFG).withColumnRenamed("msg_timestamp", "start_time")
    return sync_lag(gaps, CFG)


def _ordered_arrays(m: Models) -> DataFrame:
    recent = recent_messages(m.feed, CFG)
    announced = explode_hashes(recent, "node_id", "peer_id", "msg_timestamp").drop("msg_hash_index", "hash_text")
    orders = announcement_orders(preconfirmation_join(announced, m.staged, "inner", CFG))
    return flat(orders.select("tx_hash", "msg_timestamps", "msg_node_order", "msg_peer_order"))


def _hll_distinct(m: Models) -> DataFrame:
    """Sketches per type and day, combined per type, against the exact count."""
    rows = m.feed.select("msg_type", "msg_timestamp", F.explode("msg_data").alias("hash_text"))
    daily = rows.groupBy("msg_type", F.to_date("msg_timestamp").alias("day")).agg(
        accumulate(F.col("hash_text")).alias("sketch")
    )
    guess = daily.groupBy("msg_type").agg(estimate(combine(F.col("sketch"))).alias("approx_ct"))
    exact = rows.groupBy("msg_type").agg(F.count_distinct("hash_text").alias("exact_ct"))
    close = F.abs(F.col("approx_ct") - F.col("exact_ct")) <= 0.05 * F.col("exact_ct")
    return exact.join(guess, "msg_type").select("msg_type", "exact_ct", close.alias("within_five_percent"))


def _bottom_k(m: Models) -> DataFrame:
    counts = hash_messages(m.feed).groupBy("node_id", "peer_id").agg(F.count(F.lit(1)).alias("message_ct"))
    return bottom_k_per_group(counts, "node_id", "message_ct", 10, ["peer_id"])


def _first_per_minute(m: Models) -> DataFrame:
    rows = m.feed.select("node_id", "msg_timestamp", "peer_id", "msg_type")
    return first_per_minute(rows, ["node_id"], "msg_timestamp")


def _latest_per_key(m: Models) -> DataFrame:
    rows = stage_etherscan(m.etherscan, CFG).drop("run_timestamp")
    return latest_per_key(rows, ["node_public_key"], "last_seen")


def _version_changes(m: Models) -> DataFrame:
    told = tracker_messages(m.feed, SINCE).withColumnRenamed("msg_timestamp", "start_time")
    return version_changes(told, CFG).select("peer_id", "node_id", "start_time", "peer_client_version", "previous")


def _union_pad(m: Models) -> DataFrame:
    return union_pad(stage_ethernodes(m.ethernodes, CFG), stage_etherscan(m.etherscan, CFG))


def _hex_codec(m: Models) -> DataFrame:
    raw = hex_to_bytes(F.col("tx_hash"))
    return m.transactions.select(
        "blk_number",
        "tx_index",
        F.length(raw).alias("bytes"),
        bytes_to_hex(raw).alias("again"),
        hex_to_bytes(F.concat(F.lit("0xzz"), F.col("tx_hash"))).isNull().alias("bad_is_null"),
    )


def _enode(m: Models) -> DataFrame:
    rows = tracker_messages(m.feed, SINCE)
    return rows.select(
        "peer_id", "msg_timestamp",
        enode(F.col("peer_public_key"), F.col("peer_ip"), F.col("peer_port")).alias("enode"),
        enode(F.col("peer_public_key"), F.lit(None).cast("string"), F.col("peer_port")).alias("no_ip"),
    )


def _blocks_of_handshakes(m: Models) -> DataFrame:
    return sync_gap(m.feed, m.block_header, SINCE, CFG)


def _null_least_greatest(m: Models) -> DataFrame:
    head, local = F.col("head_block"), F.col("local_block")
    return _blocks_of_handshakes(m).select(
        "peer_id", "msg_timestamp", null_least(head, local).alias("lo"), null_greatest(head, local).alias("hi")
    )


def _div0(m: Models) -> DataFrame:
    return _blocks_of_handshakes(m).select(
        "peer_id",
        "msg_timestamp",
        div0(F.col("head_block"), F.col("sync_block_gap")).alias("ratio"),
        div0(F.lit(None).cast("bigint"), F.lit(0)).alias("unknown"),
    )


def _minute_bin(m: Models) -> DataFrame:
    return m.feed.groupBy(minute_bin(F.col("msg_timestamp")).alias("bin_num")).agg(F.count(F.lit(1)).alias("messages"))


def _time_bucket(m: Models) -> DataFrame:
    ts = F.col("msg_timestamp")
    units = ("hour", "minute", "second")
    return m.feed.groupBy(*[time_bucket(u, ts).alias(f"by_{u}") for u in units]).agg(
        F.count(F.lit(1)).alias("messages")
    )


def _datediff_boundary(m: Models) -> DataFrame:
    closed = m.sessions.where(F.col("end_time").isNotNull())
    return closed.select(
        "peer_id", "node_id", "start_time", minutes_crossed(F.col("start_time"), F.col("end_time")).alias("minutes")
    )


def _array_ops(m: Models) -> DataFrame:
    data = F.col("msg_data")
    twice = F.concat(data, data)
    return hash_messages(m.feed).select(
        "node_id",
        "peer_id",
        "msg_timestamp",
        F.size(twice).alias("all_ct"),
        F.size(F.array_distinct(twice)).alias("distinct_ct"),
        F.get(data, F.lit(1)).alias("second"),
        index_of(F.get(data, F.lit(1)), twice).alias("second_at"),
        index_of(F.lit("0x"), twice).alias("absent_at"),
    )


def _hourly_window(m: Models) -> DataFrame:
    return hourly_bounds(m.sessions, m.staged).select(ntz(SINCE).alias("update_start_time"), "update_end_time")


def _sessionize_incremental(m: Models) -> DataFrame:
    early = sessionize(m.feed.where(F.col("msg_timestamp") <= ntz(CUT)), CFG, SINCE)
    return sessionize(m.feed, CFG, CUT, early)


def _late_durations(m: Models) -> DataFrame:
    early = sessionize(m.feed.where(F.col("msg_timestamp") <= ntz(CUT)), CFG, SINCE)
    return late_durations(m.feed, CUT, early.select("peer_id", "node_id", "start_time", "end_time", "session_duration"))


def _duplicate_indices(m: Models) -> DataFrame:
    peers = F.concat("msg_data", F.reverse("msg_data"))
    nodes = F.transform(peers, lambda _: F.col("node_id"))
    indices = duplicate_indices(nodes, peers)
    return flat(hash_messages(m.feed).select("node_id", "peer_id", "msg_timestamp", indices.alias("indices")))


def _remove_indices(m: Models) -> DataFrame:
    peers = F.concat("msg_data", F.reverse("msg_data"))
    nodes = F.transform(peers, lambda _: F.col("node_id"))
    kept = remove_indices(peers, duplicate_indices(nodes, peers))
    return flat(hash_messages(m.feed).select("node_id", "peer_id", "msg_timestamp", kept.alias("kept")))


def _hourly_two_windows(m: Models) -> DataFrame:
    """Hours up to a cut, from the sessions as they were then, and the rest from all sessions: as one build makes them."""
    tables, (lo, hi) = m.tables(), m.bounds
    early = sessionize(m.feed.where(F.col("msg_timestamp") <= ntz(CUT)), CFG, SINCE)
    update_hours(m.feed, early, m.staged, tables, lo, CUT, CFG)
    # The second window sees no message before the cut: the hours before it come from what is stored.
    late = m.feed.where(F.col("msg_timestamp") >= ntz(CUT))
    update_hours(late, m.built_spans, m.staged, tables, CUT, hi, CFG)
    return tables.read(HOURLY).select(
        "peer_id", "node_id", "session_hour", "session_hour_start", "session_hour_end", "start_time", "end_time",
        "is_edge_hour", "session_hour_minutes", "total_hash_count", "confirmed_distinct_tx_count",
    )


def _stored_hash_facts(m: Models) -> DataFrame:
    """The analysis run's tables, written and read again."""
    tables = m.tables()
    tables.append(m.staged, TRANSACTIONS, cluster_by="tx_hash")
    tables.upsert(m.built_spans, SESSIONS, ["peer_id", "start_time", "node_id"], "start_time")
    sources = Sources(m.feed, m.transactions, m.block_header, m.ethernodes, m.etherscan, m.geo_blocks, m.country_code)
    run_analysis(sources, tables, CFG)
    return flat(tables.read_replaced(HASHES))


def _geoip_hot_keys(m: Models) -> DataFrame:
    """Every address a hot key, and about half of the rows without one."""
    cfg = replace(CFG, hot_min_rows=1, hot_sample=1.0)
    seen = tracker_addresses(m.feed, SINCE)
    rows = tracker_messages(m.feed, SINCE).select(
        "node_id", "peer_id", "msg_timestamp", F.when(F.col("peer_id") < "8", F.col("peer_ip")).alias("peer_ip")
    )
    return geoip_enrich(rows, "peer_ip", m.geo_blocks, cfg, seen, ["peer_id", "msg_timestamp"])


def _geoip_strict(m: Models) -> DataFrame:
    """Every address is checked; about half of the rows name none."""
    seen = tracker_addresses(m.feed, SINCE)
    rows = tracker_messages(m.feed, SINCE).select(
        "node_id", "peer_id", "msg_timestamp", F.when(F.col("peer_id") < "8", F.col("peer_ip")).otherwise("").alias("peer_ip")
    )
    return geoip_enrich(rows, "peer_ip", m.geo_blocks, CFG, seen, ["peer_id", "msg_timestamp"], strict=True)


def _node_id(m: Models) -> DataFrame:
    """What can be told of the digests without computing them: 64 hex digits, one digest per key, a known value."""
    ids = tracker_ethernodes(m.ethernodes, CFG).select("node_public_key", "node_id", keccak256_hex(F.lit("")).alias("of_nothing"))
    return ids.groupBy("node_public_key").agg(
        F.max(F.length("node_id")).alias("digits"),
        F.bool_and(F.col("node_id").rlike("^[0-9a-f]{64}$")).alias("is_hex"),
        F.count_distinct("node_id").alias("ids"),
        F.max("of_nothing").alias("of_nothing"),
    )


def _hourly_run(m: Models) -> DataFrame:
    tables = m.tables()
    sources = Sources(
        m.feed, m.transactions, m.block_header, m.ethernodes, m.etherscan, m.geo_blocks, m.country_code
    )
    run_hourly(sources, tables, CFG, sha256_hex)
    return tables.read_replaced(PERFORMANCE)


CATALOG: dict[str, Callable[[Models], DataFrame]] = {
    # datasets
    "fact_transaction": _fact_transaction,
    "tracker_ethernodes": lambda m: tracker_ethernodes(m.ethernodes, CFG, sha256_hex),
    "tracker_etherscan": lambda m: tracker_etherscan(m.etherscan, CFG, sha256_hex),
    "dim_peers": lambda m: m.peers,
    "fact_peer_session": lambda m: m.fact_sessions,
    "fact_mempool": lambda m: fact_mempool(
        m.feed, m.spark.createDataFrame([], SCHEMAS["mempool_transaction"]), SINCE, CFG
    ),
    "hourly_performance": lambda m: m.hourly,
    "peer_performance": lambda m: m.performance,
    "fact_hash": lambda m: flat(fact_hash(m.feed, m.staged, CFG)),
    "session_unique_hash": lambda m: session_unique_hash(m.feed, m.built_spans, m.staged, CFG),
    "undersampled": lambda m: m.undersampled,
    "hourly_run": _hourly_run,
    "hourly_two_windows": _hourly_two_windows,
    "stored_hash_facts": _stored_hash_facts,
    # scans, sources, sinks
    "scan_feed": _scan_feed,
    "stg_transaction": lambda m: flat(m.staged),
    "stg_ethernodes": lambda m: stage_ethernodes(m.ethernodes, CFG),
    "stg_etherscan": lambda m: stage_etherscan(m.etherscan, CFG),
    "seed_country": _seed_country,
    "replace_table": _replace_table,
    "append_increment": _append_increment,
    "upsert_by_key": _upsert_by_key,
    "cluster_write": _cluster_write,
    "export_csv_roundtrip": _export_csv_roundtrip,
    "export_undersampled": lambda m: undersampled_rows(m.undersampled, CFG),
    "export_performance": lambda m: performance_rows(m.performance, CFG),
    "freshness_check": lambda m: freshness(m.transactions, "eth_transaction", "blk_timestamp", CFG),
    # filters and joins
    "filter_predicates": _filter_predicates,
    "block_range_filter": _block_range_filter,
    "join_inner": lambda m: m.mempool.join(_confirmed_text(m), "tx_hash", "inner"),
    "join_left": lambda m: m.mempool.join(_confirmed_text(m), "tx_hash", "left"),
    "preconfirmation_join": _preconfirmation_join,
    "interval_join_hourly": _interval_join_hourly,
    "interval_join_binned": _interval_join_binned,
    "hour_slices": lambda m: hour_slices(m.built_spans, *m.bounds),
    "minute_bucket_join": lambda m: join_same_minute(
        m.sessions.select("peer_id", "node_id", "start_time"), tracker_messages(m.feed, SINCE)
    ),
    "hex_key_join": _hex_key_join,
    "role_playing_join": _role_playing_join,
    "first_seen_upsert": _first_seen_upsert,
    "first_seen_increments": _first_seen_increments,
    "geoip_enrich": _geoip_enrich,
    "geoip_hot_keys": _geoip_hot_keys,
    "geoip_strict": _geoip_strict,
    "sync_gap": _blocks_of_handshakes,
    "explode_hashes": _explode_hashes,
    "number_range": _number_range,
    # aggregations and windows
    "seen_range": _seen_range,
    "feed_bounds": _feed_bounds,
    "public_mempool_hourly": lambda m: public_mempool_hourly(m.mempool, m.staged),
    "conditional_agg": _conditional_agg,
    "ordered_arrays": _ordered_arrays,
    "hll_distinct": _hll_distinct,
    "impute_end": lambda m: m.sessions.select(
        "peer_id", "node_id", "start_time", "session_duration_calculated", "session_duration_hour", "end_time_imputed"
    ),
    "latest_per_key": _latest_per_key,
    "first_per_minute": _first_per_minute,
    "bottom_k_per_group": _bottom_k,
    "version_changes": _version_changes,
    "sessionize": lambda m: m.sessions,
    "sessionize_incremental": _sessionize_incremental,
    "late_durations": _late_durations,
    "union_pad": _union_pad,
    "undersampled_few": lambda m: undersampled_peers(m.built_hourly, m.built_sessions, CFG, k=3).drop("updated_at"),
    "undersampled_counts": lambda m: hash_counts(m.built_hourly, m.built_sessions, CFG),
    # functions
    "hex_codec": _hex_codec,
    "enode_concat": _enode,
    "parse_client": lambda m: tracker_messages(m.feed, SINCE),
    "null_least_greatest": _null_least_greatest,
    "div0": _div0,
    "minute_bin": _minute_bin,
    "time_bucket": _time_bucket,
    "datediff_boundary": _datediff_boundary,
    "array_ops": _array_ops,
    "duplicate_indices": _duplicate_indices,
    "remove_indices": _remove_indices,
    "node_id": _node_id,
    # increments and the ledger
    "session_watermark": lambda m: high_water(m.sessions),
    "hourly_window": _hourly_window,
    "ledger_plan": _ledger_plan,
    "ledger_full_refresh": _ledger_full_refresh,
    "ledger_incomplete": lambda m: runs.incomplete_runs(m.ledger, [TRANSACTION_TABLE]),
    "ledger_complete": lambda m: runs.mark_completed(
        m.ledger, TRANSACTION_TABLE, replace(CFG, run_started_at="2024-01-01 00:00:00")
    ),
    "run_block_range": lambda m: runs.run_block_range(m.ledger, ONE_RUN),
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return CATALOG[name](Models(configure(spark), sf_dir))


