"""Interval, skew and address joins against brute force."""

from __future__ import annotations

import ipaddress
import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from peernet.operators.geo import block_pieces, geoip_enrich, locate
from peernet.operators.intervals import (
    filled_days,
    hour_slices,
    hourly_keys,
    points_in_hour_slices,
    points_in_intervals,
    slices_from,
)
from peernet.operators.skew import hot_key_sets, hot_keys, salted_join
from tests.util import at, plan_of, rows

SPAN = "peer_id string, node_id string, start_time timestamp_ntz, end_time timestamp_ntz"
POINT = "peer_id string, node_id string, msg_timestamp timestamp_ntz, id int"


def random_world(seed):
    rng = random.Random(seed)
    spans = []
    for _ in range(25):
        a = rng.randrange(0, 20 * 4) * 900
        end = None if rng.random() < 0.2 else at(a + rng.choice([0, 1, 900, 3600, 20000]))
        spans.append((rng.choice("pq"), "n", at(a), end))
    points = [(rng.choice("pq"), "n", at(rng.randrange(0, 100) * 900 + rng.choice([0, 0, 1])), i) for i in range(200)]
    return spans, points


def test_hour_slices_and_points(spark, cfg):
    spans, points = random_world(1)
    sessions = spark.createDataFrame(spans, SPAN)
    slices = hour_slices(sessions, "2024-01-10 02:00:00", "2024-01-10 22:00:00")
    kept = slices.collect()
    assert {r.session_hour.hour for r in kept} <= set(range(2, 22))
    assert all(r.session_hour_start < r.session_hour_end for r in kept)
    messages = spark.createDataFrame(points, POINT)
    expected = sorted(
        (p[3], s.session_hour, s.start_time, s.end_time)
        for p in points
        for s in kept
        if p[0] == s.peer_id and s.session_hour_start <= p[2] <= s.session_hour_end
    )
    hours = hourly_keys(messages)
    for hot in ({}, hot_keys(hours, ["peer_id", "node_id", "session_hour"], replace(cfg, hot_min_rows=2, hot_sample=1.0))):
        found = points_in_hour_slices(messages, slices, hot).select("id", "session_hour", "start_time", "end_time")
        assert sorted(tuple(r) for r in found.collect()) == expected
    assert any(p[2].minute == 0 and p[2].second == 0 for p in points)


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("lo, hi", [("2024-01-10 02:00:00", "2024-01-11 22:00:00"), ("2024-01-10 02:30:00", "2024-01-11 01:30:00")])
def test_edges_and_filled_days_are_all_slices(spark, lo, hi, whole):
    """Filled hours come as one row per session and day, the others as at most two rows per session."""
    spans, _ = random_world(2)
    long = [("r", "n", at("05:00"), at("05:00") + timedelta(hours=30)), (None, "n", at("00:10"), at("23:10"))]
    sessions = spark.createDataFrame(spans + long + long[:1], SPAN)
    key = ["peer_id", "start_time", "end_time", "session_hour"]
    edges = hour_slices(sessions, lo, hi, whole, edges=True)
    days = filled_days(sessions, lo, hi, whole)
    assert edges.count() <= 2 * sessions.count()
    assert all(r.session_hour.date() == r.last_hour.date() for r in days.collect())
    hours = F.explode(F.sequence("session_hour", "last_hour", F.expr("interval 1 hour")))
    filled = days.withColumn("_hour", hours).drop("session_hour").withColumnRenamed("_hour", "session_hour")
    assert filled.count() > 3 * days.count()
    assert rows(edges.select(*key).unionByName(filled.select(*key))) == rows(hour_slices(sessions, lo, hi, whole), *key)


def test_hour_boundary_counts_twice(spark):
    sessions = spark.createDataFrame([("p", "n", at("01:30"), at("03:30"))], SPAN)
    slices = hour_slices(sessions, "2024-01-10 00:00:00", "2024-01-11 00:00:00")
    assert rows(slices, "session_hour", "is_edge_hour", "session_hour_minutes") == [
        (at("01:00"), True, 30), (at("02:00"), False, 60), (at("03:00"), True, 30),
    ]
    message = spark.createDataFrame([("p", "n", at("02:00"), 1)], POINT)
    assert rows(points_in_hour_slices(message, slices, {}), "session_hour") == [(at("01:00"),), (at("02:00"),)]


def test_open_session_is_cut_after_twelve_hours(spark):
    sessions = spark.createDataFrame([("p", "n", at("01:30"), None)], SPAN)
    slices = hour_slices(sessions, "2024-01-10 00:00:00", "2024-01-11 00:00:00").collect()
    assert max(s.session_hour_end for s in slices) == at("13:30")
    assert hour_slices(sessions, None, "2024-01-11 00:00:00").count() == 0


def test_long_sessions_keep_every_hour(spark):
    sessions = spark.createDataFrame([("p", "n", at("00:30"), at("00:30") + timedelta(hours=1440))], SPAN)
    assert hour_slices(sessions, "2024-01-01 00:00:00", "2024-06-01 00:00:00").count() == 1441
    assert hour_slices(sessions, "2024-02-01 00:00:00", "2024-02-02 00:00:00").count() == 24


def test_sessions_across_a_cut_are_made_whole(spark):
    cut = "2024-01-11 00:00:00"
    closed = [("p", "n", at("12:30"), at("12:30") + timedelta(hours=47)), ("q", "n", at("01:00"), at("02:00"))]
    early = spark.createDataFrame([(*closed[0][:3], None), closed[1]], SPAN)
    final = spark.createDataFrame(closed, SPAN)
    assert slices_from(final, cut, "2024-01-14 00:00:00") == "2024-01-10 12:00:00"
    before = hour_slices(early, "2024-01-10 00:00:00", cut)
    after = hour_slices(final, cut, "2024-01-14 00:00:00", whole=True)
    key = ["peer_id", "session_hour"]
    both = before.join(after, key, "left_anti").unionByName(after)
    assert rows(both) == rows(hour_slices(final, "2024-01-10 00:00:00", "2024-01-14 00:00:00").select(*both.columns))
    assert after.count() == 48


def test_null_keys_are_spread(spark):
    big = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), "id")
    small = spark.range(4000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    joined = salted_join(big.repartition(4), small.hint("merge"), ["k"], "left", {}, ["id"])
    assert joined.count() == 4000 and joined.where("v = 2 * k").count() == 2000
    unknown = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(unknown) > 1


def test_zero_minute_slice_stays(spark):
    sessions = spark.createDataFrame([("p", "n", at("01:30:10"), at("01:30:40"))], SPAN)
    assert rows(hour_slices(sessions, "2024-01-10 00:00:00", "2024-01-11 00:00:00"), "session_hour_minutes") == [(0,)]


def test_points_in_intervals(spark, cfg):
    spans, points = random_world(2)
    spans = [s for s in spans if s[3]]
    messages, intervals = spark.createDataFrame(points, POINT), spark.createDataFrame(spans, SPAN)
    expected = sorted((p[3], s[2], s[3]) for p in points for s in spans if p[0] == s[0] and s[2] <= p[2] <= s[3])
    hot = hot_keys(
        messages.withColumn("_cell", F.date_trunc("hour", "msg_timestamp").cast("timestamp_ntz")),
        ["peer_id", "node_id", "_cell"], replace(cfg, hot_min_rows=2, hot_sample=1.0),
    )
    for chosen, cell in (({}, "minute"), ({}, "hour"), (hot, "hour")):
        found = points_in_intervals(
            messages, intervals, ["peer_id", "node_id"], "start_time", "end_time", cell, chosen
        ).select("id", "start_time", "end_time")
        assert sorted(tuple(r) for r in found.collect()) == expected
        assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_salted_join_is_exact(spark, cfg):
    """A third of the rows are copies of one row; NULL keys stay."""
    small_cfg = replace(cfg, hot_min_rows=5, hot_sample=1.0)
    big_rows = [("hot", i % 3) for i in range(300)] + [("hot", 7)] * 300 + [(f"k{i}", i) for i in range(200)]
    big_rows += [(None, 1)] * 100
    big = spark.createDataFrame(big_rows, "k string, v int").repartition(6)
    small = spark.createDataFrame([("hot", "h"), ("k1", "a"), ("k1", "b"), (None, "x")], "k string, w string")
    hot = hot_keys(big, ["k"], small_cfg)
    assert sorted(hot.values()) == [20, 120]
    for how in ("left", "inner"):
        plain = rows(big.join(small, "k", how), "k", "v", "w")
        assert rows(salted_join(big, small, ["k"], how, hot, ["v"]), "k", "v", "w") == plain
    residual = F.col("w") != "a"
    left = salted_join(big, small, ["k"], "left", hot, ["v"], residual)
    assert left.count() == 900 and left.where("w = 'a'").count() == 0


def test_hot_keys_stay_few(spark, cfg):
    few = replace(cfg, hot_limit=10, hot_min_rows=100, hot_sample=1.0)
    spread = spark.range(1000).select((F.col("id") % 500).alias("k"))
    assert hot_keys(spread, ["k"], few) == {}
    skewed = spread.unionByName(spark.range(900).select(F.lit(-1).cast("bigint").alias("k")))
    assert list(hot_keys(skewed, ["k"], few).values()) == [10]  # pieces of about 100 rows, however many rows there are
    assert len(hot_keys(skewed, ["k"], replace(few, hot_sample=0.3))) == 1


def test_block_pieces_cover_exactly(spark):
    rng = random.Random(5)
    blocks = []
    for _ in range(40):
        a = rng.randrange(0, 1 << 20)
        blocks.append((a, a + rng.choice([0, 1, 5, 255, 300, 70000, 200000])))
    df = spark.createDataFrame(blocks, "start_ip bigint, end_ip bigint")
    for (a, b), pieces in (
        ((r[0], r[1]), r[2])
        for r in block_pieces(df).groupBy("start_ip", "end_ip").agg(F.collect_list(F.struct("level", "prefix"))).collect()
    ):
        ranges = sorted((p.prefix << p.level, ((p.prefix + 1) << p.level) - 1) for p in pieces)
        assert ranges[0][0] == a and ranges[-1][1] == b
        assert all(x[1] + 1 == y[0] for x, y in zip(ranges, ranges[1:], strict=False))


def test_locate_most_specific(spark, cfg):
    rng = random.Random(9)
    base = int(ipaddress.ip_address("10.0.0.0"))
    blocks = [(0, (1 << 32) - 1, "ZZ", "world", None), (base, base + (1 << 24) - 1, "AA", "ten", "s")]
    for i in range(60):
        a = base + rng.randrange(0, 1 << 17)
        blocks.append((a, a + rng.choice([0, 3, 255, 1000, 70000]), f"C{i}", f"c{i}", None))
    ips = [str(ipaddress.ip_address(base + rng.randrange(0, 1 << 17))) for _ in range(150)] + ["8.8.8.8", "bad", ""]
    frame = spark.createDataFrame(blocks, "start_ip bigint, end_ip bigint, country_code string, city string, subdivision string")
    seen = spark.createDataFrame([(ip,) for ip in ips], "ip string")
    found = {r.ip: r.city for r in locate(seen, "ip", frame).collect()}
    for ip in ips[:-2]:
        n = int(ipaddress.ip_address(ip))
        inside = sorted((b[1] - b[0], b[0], b[2], b[3]) for b in blocks if b[0] <= n <= b[1])
        assert found[ip] == inside[0][3]
    assert "bad" not in found and "" not in found
    enriched = geoip_enrich(seen, "ip", frame, replace(cfg, hot_min_rows=1, hot_sample=1.0), seen, [])
    assert enriched.count() == len(ips)
    good = seen.where("ip <> 'bad'").unionByName(spark.createDataFrame([(None,), ("2001:db8::1",)], "ip string"))
    strict = geoip_enrich(good, "ip", frame, cfg, good, [], strict=True)
    assert sorted(map(repr, strict.where("ip <> ''").collect())) == sorted(
        map(repr, geoip_enrich(good, "ip", frame, cfg, good, []).where("ip <> ''").collect())
    )
    assert strict.where("ip is null or ip = ''").where("peer_city is null").count() == 2
    with pytest.raises(Exception, match="not an address: bad"):
        geoip_enrich(seen, "ip", frame, cfg, seen, [], strict=True).collect()


def test_hot_keys_of_several_joins_come_from_one_pass(spark, cfg):
    every = replace(cfg, hot_limit=50, hot_min_rows=10, hot_sample=1.0)
    data = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("id") % 4).alias("b"),
        (F.col("id") % 3).alias("c"),
    )
    wanted = F.col("c") == 0
    keys = {"a": (["a"], F.lit(True)), "ab": (["a", "b"], F.lit(True)), "none": (["a"], F.lit(False)), "c": (["b"], wanted)}
    found = hot_key_sets(data, keys, every)
    assert found["a"] == hot_keys(data, ["a"], every) and len(found["a"]) == 1
    assert found["ab"] == hot_keys(data, ["a", "b"], every) and len(found["ab"]) > 1
    assert found["c"] == hot_keys(data.where(wanted), ["b"], every) and len(found["c"]) == 5  # NULL is a key like others
    assert found["none"] == {}
    assert hot_key_sets(data.where("false"), keys, every) == dict.fromkeys(keys, {})


def test_each_model_looks_for_hot_keys_once(spark, cfg, sf_dir, monkeypatch):
    from checks.catalog import CFG, Models
    from peernet.operators import skew
    from peernet.plans import hourly, sessions

    passes = []

    def counted(rows, keys, *rest):
        passes.append(sorted(keys))
        return hot_key_sets(rows, keys, *rest)

    for module in (skew, hourly, sessions):
        monkeypatch.setattr(module, "hot_key_sets", counted)
    m = Models(spark, sf_dir)
    every = replace(CFG, hot_min_rows=5, hot_sample=1.0)
    assert all(sessions.hot_session_keys(m.feed, CFG.initial_bound, every).values())
    passes.clear()
    found = sessions.fact_peer_session(
        m.feed, m.block_header, m.geo_blocks, m.country_code, m.peers, every, CFG.initial_bound
    )
    assert passes == [["head_block_hash", "local_block_hash", "peer_id", "peer_ip"]]
    assert rows(found) == rows(m.fact_sessions)
    passes.clear()
    found = hourly.hourly_performance(m.feed, m.built_spans, m.staged, *m.bounds, every)
    assert passes == [["hash", "hour"]]
    assert rows(found) == rows(m.hourly)
