"""Reading the input tables, and the freshness check on them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peernet.config import RunConfig, ntz
from peernet.functions.scalars import epoch_us
from peernet.schemas import SCHEMAS


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Parquet table by name; declared tables get their schema without a look at the files."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{root}/{name}")


def load_country_codes(spark: SparkSession, path: str) -> DataFrame:
    """Country seed CSV; `NA` stays text and an empty region is NULL."""
    return spark.read.csv(path, schema=SCHEMAS["country_code"], header=True, encoding="UTF-8")


def scan_feed(feed: DataFrame, types: tuple[str, ...], after: str | None, until: str | None = None) -> DataFrame:
    """Feed rows of some types after a bound, the bounds as literals so that they reach the scan."""
    rows = feed.where(F.col("msg_type").isin(*types) & (F.col("msg_timestamp") > ntz(after)))
    return rows if until is None else rows.where(F.col("msg_timestamp") <= ntz(until))


def arrived_after(table: DataFrame, stamp: str) -> DataFrame:
    """Rows of the files written after `stamp` (UTC); Spark leaves the other files out by their listing alone.

    Rows that do not come straight from files carry no such time, so all of them may be new.
    """
    try:
        return table.where(F.col("_metadata.file_modification_time") > F.lit(stamp).cast("timestamp"))
    except AnalysisException:
        return table


def freshness(table: DataFrame, name: str, loaded_at: str, cfg: RunConfig, max_age_minutes: int = 60) -> DataFrame:
    """(table_name, newest, age_minutes, status): error if the newest row is older than allowed, or missing."""
    age = (epoch_us(ntz(cfg.as_of)) - epoch_us(F.col("newest"))) / F.lit(60_000_000.0)
    return (
        table.agg(F.max(loaded_at).alias("newest"))
        .select(F.lit(name).alias("table_name"), "newest", age.alias("age_minutes"))
        .withColumn("status", F.when(F.col("age_minutes") <= max_age_minutes, "pass").otherwise("error"))
    )
