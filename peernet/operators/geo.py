"""Address lookup in a table of network blocks, as an equal-key join.

Blocks are cut into aligned power-of-two pieces (at most 62 per block, one for a CIDR block), and wide pieces into
/16 parts, so every piece has a key (level, prefix). A distinct address has one key per level 0..16 of its own. No
key is wide: a /16 holds at most 65536 addresses, however many rows repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.config import RunConfig
from peernet.functions.scalars import ipv4_number
from peernet.operators.skew import HotKeys, hot_keys, salted_join

_WIDEST = 16  # log2 of the widest piece, a /16 network


def block_pieces(blocks: DataFrame) -> DataFrame:
    """Aligned pieces (level = log2 of the size, prefix = start / size) of the blocks, with the block's own columns."""
    size = F.expr("shiftleft(1L, level)")
    at_level = blocks.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(32)))).withColumns(
        {
            "lo": F.floor((F.col("start_ip") + size - 1) / size).cast("bigint"),
            "hi": F.floor((F.col("end_ip") + 1) / size).cast("bigint"),
        }
    )
    odd_lo = F.col("lo") % 2
    left = F.when((F.col("lo") < F.col("hi")) & (odd_lo == 1), F.col("lo"))
    right = F.when((F.col("lo") + odd_lo < F.col("hi")) & (F.col("hi") % 2 == 1), F.col("hi") - 1)
    pieces = at_level.withColumn("prefix", F.explode(F.array_compact(F.array(left, right)))).drop("lo", "hi")
    inside = F.expr(f"shiftleft(1L, level - {_WIDEST})")
    parts = F.when(
        F.col("level") > _WIDEST, F.sequence(F.col("prefix") * inside, (F.col("prefix") + 1) * inside - 1)
    ).otherwise(F.array("prefix"))
    return pieces.withColumn("prefix", F.explode(parts)).withColumn("level", F.least(F.col("level"), F.lit(_WIDEST)))


def locate(addresses: DataFrame, ip: str, blocks: DataFrame) -> DataFrame:
    """(ip, country_code, city, subdivision) of each distinct address that a block covers; the smallest block wins."""
    distinct = addresses.select(ip).distinct().withColumn("_n", ipv4_number(F.col(ip))).where("_n is not null")
    keyed = distinct.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(_WIDEST)))).withColumn(
        "prefix", F.expr("shiftright(_n, level)")
    )
    # Pieces can be many more than blocks, which the size estimate does not see: merge, do not broadcast.
    found = keyed.join(block_pieces(blocks).hint("merge"), ["level", "prefix"], "inner")
    narrowest = F.struct((F.col("end_ip") - F.col("start_ip")).alias("size"), "start_ip", "country_code")
    place = F.struct("country_code", "city", "subdivision")
    return found.groupBy(ip).agg(F.min_by(place, narrowest).alias("place")).select(ip, "place.*")


def checked_address(ip: Column) -> Column:
    """The address itself; a text that is no address fails the query. NULL and '' name no host, and IPv6 has no blocks."""
    no_address = (ip != "") & ~ip.contains(":") & ipv4_number(ip).isNull()
    return F.when(no_address, F.raise_error(F.concat(F.lit("not an address: "), ip))).otherwise(ip)


def geoip_enrich(
    rows: DataFrame,
    ip: str,
    blocks: DataFrame,
    cfg: RunConfig,
    seen: DataFrame,
    spread: list[str],
    strict: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add peer_country_code, peer_city and peer_subdivision, NULL where no block covers the address.

    `seen` is a cheap frame holding the `ip` column (the feed's own), used to find the distinct and the hot addresses
    without computing `rows` twice. With `strict`, NULL only means that no block was found: a text that is no address is
    an error. `hot` are the hot addresses, where the caller has looked for them already.
    """
    if strict:
        rows = rows.withColumn(ip, checked_address(F.col(ip)))
    places = locate(seen, ip, blocks).select(
        ip,
        F.col("country_code").alias("peer_country_code"),
        F.col("city").alias("peer_city"),
        F.col("subdivision").alias("peer_subdivision"),
    )
    return salted_join(rows, places, [ip], "left", hot_keys(seen, [ip], cfg) if hot is None else hot, spread)
