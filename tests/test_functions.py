from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
import numpy as np
from pyspark.sql import functions as F

from peernet.functions import scalars as s
from peernet.functions.arrays import duplicate_indices, index_of, remove_indices
from peernet.functions.hashing import keccak256_batch, keccak256_hex
from tests.util import at


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("a", "b", "least", "greatest", "ratio"),
    [(1, 2, 1, 2, 0.5), (None, 2, None, None, None), (3, None, None, None, None), (5, 0, 0, 5, 0.0)],
)
def test_null_least_greatest_div0(spark, a, b, least, greatest, ratio):
    x, y = F.lit(a).cast("int"), F.lit(b).cast("int")
    assert value(spark, s.null_least(x, y)) == least
    assert value(spark, s.null_greatest(x, y)) == greatest
    assert value(spark, s.div0(x, y)) == ratio


def test_minutes_are_boundaries(spark):
    a, b = F.lit("2024-01-10 00:00:59").cast("timestamp_ntz"), F.lit("2024-01-10 00:01:01").cast("timestamp_ntz")
    assert value(spark, s.minutes_crossed(a, b)) == 1
    assert value(spark, s.minutes_crossed(b, a)) == -1
    assert value(spark, s.nanos_between(a, b)) == 2_000_000_000
    assert value(spark, s.minute_bin(F.lit("1969-12-31 23:59:59").cast("timestamp_ntz"))) == -1


def test_time_bucket_keeps_type(spark):
    df = spark.createDataFrame([(at("10:30:15"),)], "t timestamp_ntz").select(s.time_bucket("hour", F.col("t")).alias("h"))
    assert df.dtypes == [("h", "timestamp_ntz")]
    assert df.first()[0] == at("10:00")


def test_hex(spark):
    assert value(spark, s.bytes_to_hex(s.hex_to_bytes(F.lit("0xAB01")))) == "0xab01"
    assert value(spark, s.hex_to_bytes(F.lit("0xzz"))) is None
    with pytest.raises(PySparkException, match="not hex"):
        value(spark, s.hex_to_bytes(F.lit("0xzz"), strict=True))


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("Geth/v1.13.1-stable/linux-amd64/go1.21", ("Geth", "v1.13.1-stable", "linux-amd64", "go1.21")),
        ("Geth", ("Geth", None, None, "Geth")),
        ("", (None, None, None, None)),
        ("/v1/x/", (None, "v1", None, None)),
        ("erigon/linux/go", ("erigon", None, "linux", "go")),
    ],
)
def test_client_parts(spark, text, parts):
    c = F.lit(text)
    found = spark.range(1).select(s.client_type(c), s.client_version(c), s.client_os(c), s.client_runtime(c)).first()
    assert tuple(found) == parts


def test_address(spark):
    assert value(spark, s.address_host(F.lit('"10.0.0.1:30303'))) == "10.0.0.1"
    assert value(spark, s.address_port(F.lit("10.0.0.1:30303"))) == 30303
    with pytest.raises(PySparkException):
        value(spark, s.address_port(F.lit("10.0.0.1")))
    assert value(spark, s.enode(F.lit("k"), F.lit("1.2.3.4"), F.lit(5))) == "k@1.2.3.4:5"
    assert value(spark, s.enode(F.lit("k"), F.lit("1.2.3.4"), F.lit(None).cast("int"))) is None


@pytest.mark.parametrize(
    ("ip", "number"),
    [("10.0.0.1", 167772161), ("255.255.255.255", 4294967295), ("1.2.3.256", None), ("[2001", None), ("", None)],
)
def test_ipv4(spark, ip, number):
    assert value(spark, s.ipv4_number(F.lit(ip))) == number


def test_arrays(spark):
    nodes = F.array(*[F.lit(x) for x in ["n", "n", "m", "n"]])
    peers = F.array(*[F.lit(x) for x in ["a", "a", "a", "b"]])
    assert value(spark, duplicate_indices(nodes, peers)) == [1]
    assert value(spark, remove_indices(peers, duplicate_indices(nodes, peers))) == ["a", "a", "b"]
    none = F.array().cast("array<string>")
    assert value(spark, duplicate_indices(none, none)) == []
    assert value(spark, remove_indices(none, F.array(F.lit(0)))) == []
    assert value(spark, remove_indices(F.lit(None).cast("array<string>"), F.array(F.lit(0)))) is None
    assert value(spark, remove_indices(peers, F.array().cast("array<int>"))) == ["a", "a", "a", "b"]
    gaps = F.array(F.lit(None), F.lit("a"), F.lit(None), F.lit("a")).cast("array<string>")
    assert value(spark, duplicate_indices(gaps, gaps)) == [2, 3]
    assert value(spark, index_of(F.lit("b"), peers)) == 3
    assert value(spark, index_of(F.lit("z"), peers)) is None


def test_long_arrays(spark):
    """Quadratic work would take minutes here."""
    df = spark.range(8).select(F.transform(F.sequence(F.lit(0), F.lit(99_999)), lambda i: (i * 7 % 60_000).cast("string")).alias("p"))
    again = duplicate_indices(F.col("p"), F.col("p"))
    found = df.select(again.alias("d"), remove_indices(F.col("p"), again).alias("k")).select(
        F.size("d"), F.element_at("d", 1), F.size("k"), F.size(F.array_distinct("k"))
    )
    assert {tuple(r) for r in found.collect()} == {(40_000, 60_000, 60_000, 60_000)}


def test_keccak(spark):
    # Published vectors of the original Keccak-256.
    data = np.frombuffer(b"abc" + bytes(64), np.uint8)
    assert [d.tobytes().hex() for d in keccak256_batch(data, np.array([0, 0, 3, 67]))] == [
        "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470",
        "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45",
        "ad3228b676f7d3cd4284a5443f17f1962b36e491b30a40b2405849e597ba5fb5",
    ]
    df = spark.createDataFrame([("00" * 64,), (None,), ("",), ("xy",)], "k string").select(keccak256_hex(F.col("k")))
    found = [r[0] for r in df.collect()]
    assert found[0].startswith("ad3228b6") and found[1] is None and found[2].startswith("c5d24601")
    assert found[3] is None and len(found[0]) == 64
