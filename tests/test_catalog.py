"""Every query against its twin, and the shape of the plans that matter at scale."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.catalog import CATALOG
from checks.compare import connect, differences
from tests.util import plan_of

TWINS = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, con, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    if name in TWINS:
        assert differences(result, con, TWINS[name]) == []
        assert con.execute(f"SELECT count(*) FROM ({TWINS[name]})").fetchone()[0] > 0  # equal, and not for want of rows
    else:
        assert result.count() > 0


def test_twins_are_known():
    assert set(TWINS) <= set(queries())
    assert set(CATALOG) <= set(TWINS)


def test_entry(spark):
    assert "total_hash_count" in entry(spark).columns


@pytest.mark.parametrize(
    "name",
    ["fact_peer_session", "hourly_performance", "session_unique_hash", "fact_hash", "peer_performance", "undersampled",
     "interval_join_hourly", "interval_join_binned", "geoip_enrich"],
)
def test_no_pairwise_joins(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["latest_per_key", "first_per_minute", "bottom_k_per_group", "undersampled", "fact_hash"])
def test_top_rows_are_cut_before_the_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in plan_of(queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["sessionize", "fact_mempool", "hourly_performance"])
def test_feed_is_pruned(spark, sf_dir, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(queries()[name](spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "/network_feed]" in line]
    assert scans and all("msg_type" in line.split("PartitionFilters: ")[1].split("]")[0] for line in scans)
    assert all("msg_timestamp" in line.split("PushedFilters: ")[1] for line in scans)


@pytest.mark.parametrize("name", ["hourly_performance", "fact_hash", "session_unique_hash"])
def test_only_later_blocks_are_read(spark, sf_dir, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(queries()[name](spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "/eth_transaction]" in line]
    assert any("GreaterThan(blk_timestamp" in line.split("PushedFilters: ")[1] for line in scans)


def test_sketches_are_counted_apart(spark, sf_dir):
    plan = plan_of(queries()["session_unique_hash"](spark, sf_dir))
    with_sketch = [line for line in plan.splitlines() if "hll_union_agg" in line]
    assert with_sketch and not any("confirmed_hash" in line for line in with_sketch)
