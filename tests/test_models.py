"""Hand-written cases of the datasets, where the driver's data has none."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from peernet.functions.hashing import sha256_hex
from peernet.operators.relational import changes, first_per_minute, keep_earliest, latest_per_key
from peernet.plans.hourly import hourly_performance, hourly_window
from peernet.plans.mempool import fact_mempool, first_seen, mempool_watermark
from peernet.plans.peers import dim_peers, tracker_etherscan, tracker_ethernodes
from peernet.plans.performance import mempool_share, peer_rates, rounded
from peernet.plans.propagation import fact_hash
from peernet.plans.session_hashes import session_unique_hash
from peernet.plans.sessions import handshakes, sync_gap, tracker_messages
from peernet.plans.undersampled import undersampled_peers
from peernet.config import GENESIS_HASH
from peernet.schemas import SCHEMAS
from tests.util import at, feed, rows

H1, H2 = "0x" + "11" * 32, "0x" + "22" * 32
P, Q = "aa" * 32, "bb" * 32


def txs(spark, *data):
    df = spark.createDataFrame([(h, at(t), f) for h, t, f in data], "h string, blk_timestamp timestamp_ntz, tx_from string")
    return df.select(F.unhex(F.substring("h", 3, 99)).alias("tx_hash"), "blk_timestamp", "tx_from")


def sessions(spark, *data):
    made = [(p, n, at(a), None if b is None else at(b)) for p, n, a, b in data]
    return spark.createDataFrame(made, SCHEMAS["peer_session_keys"])


@pytest.fixture(params=[1_000_000, 0])
def any_cfg(request, cfg):
    """Without and with every key treated as hot."""
    return replace(cfg, hot_min_rows=request.param, hot_sample=1.0)


def test_hourly_weights_repeated_transactions(spark, any_cfg):
    messages = feed(
        spark,
        [
            ("10:10", "n", P, "new_hash", [H1, H2]),  # both before their blocks
            ("10:20", "n", P, "new_hash_68", [H1]),
            ("10:50", "n", P, "new_hash", [H1]),  # after the block
            ("10:30", "m", P, "new_hash", [H1]),  # another node
            ("10:40", "n", P, "new_hash", []),
            ("10:41", "n", P, "new_hash", None),
        ],
    )
    blocks = txs(spark, (H1, "10:45", "f"), (H1, "10:45", "f"), (H2, "23:00", "g"))
    spans = sessions(spark, (P, "n", "10:05", "12:30"))
    found = hourly_performance(messages, spans, blocks, "2024-01-10 00:00:00", "2024-01-11 00:00:00", any_cfg)
    assert rows(found, "session_hour", "total_hash_count", "confirmed_distinct_tx_count", "session_hour_minutes") == [
        (at("10:00"), 2 + 1 + 2 + 1, 2, 55),  # each early H1 meets two transaction rows
        (at("11:00"), 0, 0, 60),
        (at("12:00"), 0, 0, 30),
    ]


def test_hourly_merges_equal_sessions(spark, any_cfg):
    spans = sessions(spark, (P, "n", "10:05", "10:30"), (P, "n", "10:05", "10:30"))
    messages = feed(spark, [("10:10", "n", P, "new_hash", [H1])])
    found = hourly_performance(
        messages, spans, txs(spark, (H1, "09:00", "f")), "2024-01-10 00:00:00", "2024-01-11 00:00:00", any_cfg
    )
    assert rows(found, "total_hash_count", "confirmed_distinct_tx_count") == [(2, 0)]


def test_hourly_window(spark, cfg):
    spans = sessions(spark, (P, "n", "10:05", None), (P, "n", "14:20", None))
    blocks = txs(spark, (H1, "13:59", "f"))
    assert hourly_window(None, spans, blocks, cfg) == (cfg.initial_bound, "2024-01-10 13:00:00")
    built = spark.createDataFrame([(at("11:00"),)], "session_hour timestamp_ntz")
    assert hourly_window(built, spans, blocks, cfg) == ("2024-01-10 12:00:00", "2024-01-10 13:00:00")
    assert hourly_window(None, spans, blocks.where("false"), cfg)[1] is None


def test_hash_order(spark, any_cfg):
    cfg = replace(any_cfg, as_of="2024-01-11 00:00:00")
    messages = feed(
        spark,
        [
            ("10:00", "n", P, "new_hash", [H2, H1]),
            ("10:00", "m", P, "new_hash", [H2]),  # same peer and time at another node: one more row per hash
            ("10:01", "n", P, "new_hash", [H1]),  # repeats a pair: second sighting, but not in the arrays
            ("10:02", "n", Q, "new_hash", [H1]),
            ("10:03", "n", P, "new_hash", [H1]),
            ("12:00", "n", Q, "new_hash", [H1]),  # after the block
        ],
    )
    found = fact_hash(messages, txs(spark, (H1, "11:00", "f")), cfg).where(F.hex("tx_hash") == H1[2:])
    assert rows(
        found, "first_seen_at", "second_seen_at", "first_node", "second_node", "seen_by_count", "win_margin_sec",
        "msg_timestamps", "first_msg_hash_count", "first_msg_hash_index", "tx_from",
    ) == [
        (at("10:00"), at("10:01"), "n", "n", 2, 60.0, [at("10:00"), at("10:02")], 1, None, "f"),
        (at("10:00"), at("10:01"), "n", "n", 2, 60.0, [at("10:00"), at("10:02")], 2, 1, "f"),
    ]


def test_hash_order_with_repeated_transactions(spark, any_cfg):
    cfg = replace(any_cfg, as_of="2024-01-11 00:00:00")
    messages = feed(spark, [("10:00", "n", P, "new_hash", [H1]), ("10:05", "m", Q, "new_hash", [H1])])
    found = fact_hash(messages, txs(spark, (H1, "11:00", "f"), (H1, "11:00", "f")), cfg)
    # The repeated row doubles every sighting, so the first one is its own runner-up.
    assert rows(found, "second_seen_at", "second_node", "win_margin_nano", "msg_node_order") == [
        (at("10:00"), "n", 0, ["n", "m"])
    ] * 2
    assert fact_hash(messages.limit(0), txs(spark, (H1, "11:00", "f")), cfg).count() == 0


def test_single_sighting_has_no_margin(spark, any_cfg):
    cfg = replace(any_cfg, as_of="2024-01-11 00:00:00")
    messages = feed(spark, [("10:00", "n", P, "new_hash", [H1])])
    found = fact_hash(messages, txs(spark, (H1, "11:00", "f")), cfg)
    assert rows(found, "second_seen_at", "second_node", "win_margin_nano") == [(None, None, None)]


def test_session_hashes(spark, any_cfg):
    cfg = replace(any_cfg, window_start="2024-01-10 00:00:00", window_end="2024-01-11 00:00:00")
    messages = feed(
        spark,
        [
            ("10:00:05", "n", P, "new_hash", [H1, H2]),
            ("10:30", "n", P, "new_hash", [H1]),
            ("10:10", "n", P, "get_tx_66", [H1, H2]),
            ("10:10", "n", P, "get_tx_66", [H2, H2]),  # same size, same instant: counts once
            ("10:11", "n", P, "get_tx_66", []),
            ("10:40", "n", P, "get_tx_66", [H1]),  # after the last announcement's minute
        ],
    )
    spans = sessions(spark, (P, "n", "10:00:05.4", "11:00"), (P, "n", "11:30", "11:40"), (P, "n", "10:20", None))
    spans = spans.withColumn("session_duration_calculated", F.lit(60_000_000_000 * 10)).withColumn(
        "session_duration_hour", F.lit(0.5)
    )
    found = session_unique_hash(messages, spans, txs(spark, (H1, "10:15", "f")), cfg)
    assert rows(
        found, "start_time", "total_hash_count", "hash_per_minute", "confirmed_distinct_tx_count",
        "total_get_hash_count", "distinct_get_hash_count", "msg_ct",
    ) == [
        (at("10:00:05.4"), 3, 0.3, 1, 2, 2, None),
        (at("10:20"), None, None, None, None, None, None),
        (at("11:30"), None, None, None, None, None, None),
    ]


def test_late_announcements_count_for_a_while(spark, cfg):
    early = feed(spark, [("10:00", "n", P, "new_hash", [H1]), ("10:05", "n", P, "new_hash", [H1, H2])])
    empty = spark.createDataFrame([], SCHEMAS["mempool_transaction"])
    target = fact_mempool(early, empty, cfg.initial_bound, cfg)
    assert rows(target, "tx_hash", "first_seen_at") == [(H1, at("10:00")), (H2, at("10:05"))]
    late = early.unionByName(
        feed(spark, [("09:00", "n", P, "new_hash", ["0x33"]), ("09:30", "n", P, "new_hash", [H2]), ("11:00", "n", P, "new_hash", ["0x44"])])
    )
    since = mempool_watermark(target, cfg)
    assert since == "2024-01-09 20:05:00"
    assert rows(fact_mempool(late, target, since, cfg), "tx_hash") == sorted([("0x33",), ("0x44",), (H2,)], key=repr)
    strict = mempool_watermark(target, replace(cfg, late_hours=0))
    assert strict == "2024-01-10 10:05:00"
    assert rows(fact_mempool(late, target, strict, cfg), "tx_hash") == [("0x44",)]
    assert mempool_watermark(empty, cfg) == cfg.initial_bound
    assert first_seen(late, None).count() == 0


def test_keep_earliest(spark):
    text = "k string, t timestamp_ntz"
    new = spark.createDataFrame([("a", at(5)), ("b", at(5)), ("c", at(5)), ("d", at(5))], text)
    target = spark.createDataFrame([("a", at(4)), ("b", at(6)), ("c", None)], text)
    assert rows(keep_earliest(new, target, "k", "t"), "k") == [("b",), ("c",), ("d",)]


def test_handshake_lookups(spark, any_cfg):
    def shake(t, net, head, local, peer=P):
        return (t, "n", peer, "handshake_eth", [net, "x", GENESIS_HASH, head, local])

    data = feed(
        spark,
        [
            shake("10:00:20", "1", H1, H2), shake("10:00:10", "1", H1, H1),  # one minute: the earlier counts
            shake("10:01", "1", None, H1), shake("10:02", "1", H1, None), shake("10:03", "5", H1, H1),
            shake("10:04", "1", "0x" + "AA" * 32, H1), shake("10:05", "1", H2, H1),
        ],
    )
    header = spark.sql(
        f"select n blk_number, unhex(h) blk_hash from values (9L, '{H1[2:]}'), (7L, '{H1[2:]}'), (4L, '{H2[2:]}'), "
        f"(1L, '{'aa' * 32}'), (2L, null) v(n, h)"
    )
    found = sync_gap(data, header, any_cfg.initial_bound, any_cfg)
    assert rows(found, "msg_timestamp", "in_sync", "head_block", "local_block", "sync_block_gap") == [
        (at("10:00:10"), True, 7, 7, 0),
        (at("10:01"), False, None, 7, None),
        (at("10:02"), None, 7, None, None),
        (at("10:04"), False, None, 7, None),  # upper case never matches
        (at("10:05"), False, 4, 7, 0),
    ]
    assert handshakes(data, any_cfg.initial_bound).count() == 6


def test_tracker_takes_first_of_the_minute(spark, cfg):
    body = ['"k"', "5", "Geth", '["eth/67"]', '"1.2.3.4:30303"']
    data = feed(spark, [("10:00:30", "n", P, "node_tracker", ["late", *body[1:]]), ("10:00:01", "n", P, "node_tracker", body)])
    assert rows(tracker_messages(data, cfg.initial_bound), "peer_public_key", "peer_capabilities", "peer_ip") == [
        ("k", "[eth/67]", "1.2.3.4")
    ]


def test_version_changes(spark):
    versions = [None, "a", "a", None, "b", None, "b"]
    data = [(P, at(i * 86400), "n", v) for i, v in enumerate(versions)]
    df = spark.createDataFrame(data, "peer_id string, t timestamp_ntz, node_id string, v string")
    for chunk in ("day", "month"):
        found = changes(df, "peer_id", "t", "v", ["node_id"], chunk)
        # No previous value keeps a row; an unknown version after a known one is no change.
        assert rows(found, "t") == [(at(i * 86400),) for i in (0, 1, 4, 6)]


def test_latest_counts_null_as_newest(spark):
    df = spark.createDataFrame([("k", at(1), 1), ("k", None, 3), ("k", None, 2)], "k string, t timestamp_ntz, v int")
    assert rows(latest_per_key(df, ["k"], "t")) == [("k", None, 2)]
    assert rows(first_per_minute(df.where("t is not null"), ["k"], "t"), "v") == [(1,)]


def test_trackers_and_peers(spark, cfg):
    nodes = spark.createDataFrame(
        [("00ff", "1.1.1.1", "i", "DE", "Geth", "v1", "linux", True, at(1)),
         ("00ff", "2.2.2.2", "i", "DE", "Geth", "v2", "linux", None, at(9))],
        SCHEMAS["ethernodes_tracker"],
    )
    scan = spark.createDataFrame(
        [("00ff", "3.3.3.3", 5, "DE", "Geth", "go", "linux", None), ("00ff", "4.4.4.4", 6, "FR", "Geth", "go", "linux", at(2))],
        SCHEMAS["node_tracker"],
    )
    one, two = tracker_ethernodes(nodes, cfg), tracker_etherscan(scan, cfg, sha256_hex)
    assert rows(one, "first_seen", "last_seen", "ip", "client_version", "in_sync") == [
        (at(1), at(9), "2.2.2.2", "v2", None)
    ]
    assert rows(two, "first_seen", "last_seen", "ip", "port") == [(at(2), at(2), "3.3.3.3", 5)]
    assert rows(dim_peers(one, two), "source", "port", "isp", "run_time_version") == [
        ("ethernodes", None, "i", None), ("etherscan", 5, None, "go"),
    ]


def test_unknown_hour_share_is_null(spark, cfg):
    hourly = spark.createDataFrame(
        [(P, at("10:00"), 4.0, 8, False), (P, at("11:00"), 2.0, 8, False), (P, at("12:00"), 2.0, 8, True)],
        "peer_id string, session_hour timestamp_ntz, confirmed_distinct_tx_per_minute double, "
        "confirmed_distinct_tx_count bigint, is_edge_hour boolean",
    )
    hours = spark.createDataFrame([(at("10:00"), 4), (at("12:00"), 4)], "blk_hour timestamp_ntz, tx_ct bigint")
    shares = mempool_share(hourly, hours)
    assert rows(shares, "session_hour", "pct_mempool") == [(at("10:00"), 1.0), (at("11:00"), None)]
    assert rows(peer_rates(shares, cfg)) == [(P, 3.0, 0.0, 0.0, 1.0, 1.0)]
    assert [r[0] for r in spark.sql("select 0.125 x union all select 1.005").select(rounded(F.col("x"), 2)).collect()] == [0.13, 1.01]


def test_undersampled_keeps_unknown_regions(spark, cfg):
    late = replace(cfg, as_of="2024-01-12 00:00:00")
    hourly = spark.createDataFrame(
        [(P, at("10:00"), 3), (P, at("11:00"), 2), (Q, at("10:00"), 0), ("cc", at("10:00"), 1), ("dd", at("10:00"), 9)],
        "peer_id string, session_hour timestamp_ntz, total_hash_count bigint",
    )
    facts = spark.createDataFrame(
        [(P, at(1), "n", "Europe", "old", "1.1.1.1", 1), (P, at(2), "n", "Asia", "k", "1.1.1.1", 1),
         ("dd", at(1), "n", "Asia", "z", "1.1.1.2", None)],
        "peer_id string, start_time timestamp_ntz, node_id string, peer_region string, peer_public_key string, "
        "peer_ip string, peer_port int",
    )
    found = undersampled_peers(hourly, facts, late)
    assert [tuple(r)[:3] for r in found.collect()] == [
        ("Asia", "k@1.1.1.1:1", 5), ("Asia", None, 9), ("unknown", None, 1),
    ]
    assert rows(undersampled_peers(hourly, facts, late, k=1), "hash_ct") == [(1,), (5,)]


def shuffled_rows(df):
    """Rows of the result, and rows that its exchanges have written."""
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.toDF(*df.columns)._jdf.queryExecution().executedPlan()
        result = plan.executeCollect()
        todo, total = [plan], 0
        while todo:
            node = todo.pop()
            written = node.metrics().get("shuffleRecordsWritten")
            total += written.get().value() if written.isDefined() else 0
            todo += [node.children().apply(i) for i in range(node.children().length())]
        return len(result), total
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_session_hours_are_not_shuffled(spark, cfg):
    """A session of forty days moves as a row a day; its hours are made after the last exchange, with counts at both edges,
    inside, and doubled for a session that is stored twice."""
    month = (at("00:20"), at("00:20") + timedelta(days=40))
    spans = spark.createDataFrame(
        [("p", "n", *month), ("q", "n", *month), ("q", "n", *month), (None, "n", *month)],
        "peer_id string, node_id string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    messages = feed(spark, [
        ("00:30", "n", "p", "new_hash", ["0x01"]), ("05:00", "n", "p", "new_hash", ["0x01", "0x02"]),
        ("05:10", "n", "q", "new_hash", ["0x01"]), ("05:10", "n", None, "new_hash", ["0x01"]),
    ])
    blocks = spark.createDataFrame([(bytes([1]), at("06:00"))], "tx_hash binary, blk_timestamp timestamp_ntz")
    found = hourly_performance(messages, spans, blocks, "2024-01-01 00:00:00", "2024-03-01 00:00:00", cfg)
    counts = ["total_hash_count", "confirmed_distinct_tx_count"]
    assert rows(found.where("total_hash_count > 0"), "peer_id", "session_hour", *counts) == [
        ("p", at("00:00"), 1, 1), ("p", at("04:00"), 2, 1), ("p", at("05:00"), 2, 1), ("q", at("05:00"), 2, 1),
    ]
    hours, moved = shuffled_rows(found)
    assert hours == 3 * (40 * 24 + 1) and moved < hours / 5
