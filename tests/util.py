"""Small frames for tests: rows in, sorted tuples out."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from peernet.schemas import SCHEMAS

DAY = datetime(2024, 1, 10)


def at(text: str | float) -> datetime:
    """'10:30' or seconds on the test day."""
    if isinstance(text, str):
        h, m, *s = text.split(":")
        return DAY + timedelta(hours=int(h), minutes=int(m), seconds=float(s[0]) if s else 0)
    return DAY + timedelta(seconds=text)


def feed(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(when, node, peer, type, data) rows."""
    return spark.createDataFrame([(at(t), n, p, k, d) for t, n, p, k, d in rows], SCHEMAS["network_feed"])


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
