from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from peernet.operators.sessions import close_sessions, high_water, peer_set_events, session_watermark, sessionize
from tests.util import at, feed, rows

ADD, REMOVE, START = "peer_set_add", "peer_set_remove", "node_start"


def closed(duration):
    return ["r", "x", str(duration)]


def test_two_adds_share_one_close(spark, cfg):
    data = feed(spark, [(1, "n", "p", ADD, []), (2, "n", "p", ADD, None), (5, "n", "p", REMOVE, closed(7))])
    found = rows(sessionize(data, cfg, cfg.initial_bound), "start_time", "end_time", "session_duration")
    assert found == [(at(1), at(5), 7), (at(2), at(5), 7)]


def test_duration_may_come_from_a_later_remove(spark, cfg):
    data = feed(spark, [(1, "n", "p", ADD, []), (2, "n", "p", START, []), (9, "n", "p", REMOVE, closed(4))])
    assert rows(sessionize(data, cfg, cfg.initial_bound), "end_time", "session_duration") == [(at(2), 4)]


def test_only_the_same_pair_closes(spark, cfg):
    data = feed(spark, [(1, "n", "p", ADD, []), (2, "m", "p", REMOVE, closed(1)), (3, "n", "q", START, [])])
    found = sessionize(data, cfg, cfg.initial_bound)
    assert rows(found, "end_time", "session_duration_calculated", "end_time_imputed") == [(None, 2_000_000_000, True)]


def test_close_in_a_later_chunk(spark, cfg):
    late = 5 * 86400
    data = feed(spark, [(1, "n", "p", ADD, []), (86400, "n", "p", ADD, []), (late, "n", "p", REMOVE, closed(3))])
    found = rows(sessionize(data, cfg, cfg.initial_bound), "end_time", "session_duration")
    assert found == [(at(late), 3), (at(late), 3)]


@pytest.mark.parametrize("chunk", ["minute", "hour", "day"])
def test_chunks_do_not_change_the_result(spark, cfg, chunk):
    rng = random.Random(7)
    data = []
    for _ in range(300):
        kind = rng.choice([ADD, ADD, REMOVE, START])
        body = rng.choice([closed(rng.randrange(9)), []]) if kind == REMOVE else []
        data.append((rng.randrange(40) * 900, rng.choice("nm"), rng.choice("pq"), kind, body))
    events = peer_set_events(feed(spark, data), cfg, cfg.initial_bound)
    found = rows(close_sessions(events, chunk), "node_id", "peer_id", "start_time", "end_time", "session_duration")

    order = {ADD: 1, REMOVE: 2, START: 0}
    told = [
        (t, order[k], (int(d[2]) if k == REMOVE and d else -1), n, p) for t, n, p, k, d in data
    ]
    expected = []
    for t, o, _, n, p in told:
        if o != 1:
            continue
        after = sorted(e for e in told if e[3:] == (n, p) and (e[0], e[1]) > (t, 1) and e[1] != 1)
        ends = [e[0] for e in after]
        reported = [e[2] for e in after if e[2] >= 0]
        expected.append((n, p, at(t), at(ends[0]) if ends else None, reported[0] if reported else None))
    assert found == sorted(expected, key=repr)


def test_watermark(spark, cfg):
    assert session_watermark(None, cfg) == cfg.initial_bound
    still_open = sessionize(feed(spark, [(1, "n", "p", ADD, [])]), cfg, cfg.initial_bound)
    with pytest.warns(UserWarning, match="no closed session"):
        assert session_watermark(still_open, cfg) is None
    assert rows(high_water(still_open)) == [(None, 0)]
    assert rows(sessionize(feed(spark, [(1, "n", "p", ADD, [])]), cfg, None)) == []


def test_increments_equal_one_batch(spark, cfg):
    rng = random.Random(3)
    data = [
        (i * 600 + rng.randrange(500), "n", rng.choice("pqr"), rng.choice([ADD, ADD, REMOVE, START]), [])
        for i in range(120)
    ]
    whole = sessionize(feed(spark, data), cfg, cfg.initial_bound)
    columns = ["peer_id", "start_time", "end_time"]
    target = None
    for upto in (30, 60, 120):
        since = session_watermark(target, cfg)
        new = sessionize(feed(spark, data[:upto]), cfg, since, target).select("node_id", *columns)
        if target is not None:
            kept = target.join(new.select("peer_id", "start_time"), ["peer_id", "start_time"], "left_anti")
            new = kept.select("node_id", *columns).unionByName(new)
        target = spark.createDataFrame(new.collect(), new.schema)
    assert rows(target, *columns) == rows(whole, *columns)
    assert whole.where(F.col("end_time").isNotNull()).count() > 20
