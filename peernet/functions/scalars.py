"""Column expressions with the warehouse dialect's semantics, all JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from peernet.config import ntz


def _any_null(cols: tuple[Column, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def null_least(*cols: Column) -> Column:
    """LEAST that is NULL as soon as one argument is NULL."""
    return F.when(~_any_null(cols), F.least(*cols))


def null_greatest(*cols: Column) -> Column:
    """GREATEST that is NULL as soon as one argument is NULL."""
    return F.when(~_any_null(cols), F.greatest(*cols))


def div0(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0, NULL where either is NULL."""
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, F.lit(0.0)).otherwise(a / b)


def time_bucket(unit: str, ts: Column) -> Column:
    """date_trunc that stays a timestamp without zone."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def epoch_us(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", ntz("1970-01-01 00:00:00"), ts)


def nanos_between(a: Column, b: Column) -> Column:
    """Nanoseconds from a to b, at the microsecond resolution Spark timestamps have."""
    return F.timestamp_diff("MICROSECOND", a, b) * F.lit(1000)


def minute_bin(ts: Column) -> Column:
    return F.floor(epoch_us(ts) / F.lit(60_000_000)).cast("bigint")


def minutes_crossed(a: Column, b: Column) -> Column:
    """Number of minute boundaries between a and b (not the number of full minutes)."""
    return minute_bin(b) - minute_bin(a)


def hex_to_bytes(text: Column, strict: bool = False) -> Column:
    """Bytes of an 0x-prefixed hex text; invalid hex is NULL, or an error when strict."""
    raw = F.unhex(F.substring(text, 3, 2_147_483_647))
    if not strict:
        return raw
    return F.when(text.isNotNull() & raw.isNull(), F.raise_error(F.concat(F.lit("not hex: "), text))).otherwise(raw)


def bytes_to_hex(raw: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(raw)))


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def unquote(text: Column) -> Column:
    return F.replace(text, F.lit('"'), F.lit(""))


# The patterns that cut a client text `type/version/os/runtime`.
VERSION_PATTERN = r"v[^/]+"
OS_PATTERN = r"/([^/]+)/[^/]+$"
RUNTIME_PATTERN = r"([^/]+)$"


def client_type(client: Column) -> Column:
    return non_empty(F.split_part(client, F.lit("/"), F.lit(1)))


def client_version(client: Column) -> Column:
    return non_empty(F.regexp_extract(client, VERSION_PATTERN, 0))


def client_os(client: Column) -> Column:
    return non_empty(F.regexp_extract(client, OS_PATTERN, 1))


def client_runtime(client: Column) -> Column:
    return non_empty(F.regexp_extract(client, RUNTIME_PATTERN, 1))


def address_host(address: Column) -> Column:
    return unquote(F.split_part(address, F.lit(":"), F.lit(1)))


def address_port(address: Column) -> Column:
    """Port of ip:port; an address without a port fails the cast, as in the original."""
    return F.split_part(address, F.lit(":"), F.lit(2)).cast("int")


def enode(public_key: Column, ip: Column, port: Column) -> Column:
    """key@ip:port, NULL if any part is."""
    return F.concat(public_key, F.lit("@"), ip, F.lit(":"), port.cast("string"))


def ipv4_number(ip: Column) -> Column:
    """IPv4 text as a number; NULL for anything else."""
    parts = [F.split_part(ip, F.lit("."), F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    value = parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3]
    well_formed = ip.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$")
    return F.when(well_formed & (F.greatest(*parts) <= 255), value)
