"""Row-for-row comparison of a Spark result with its DuckDB twin."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return bytes(value) if isinstance(value, bytearray) else value


def _close(a: object, b: object) -> bool:
    return isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both results have the same columns and the same rows."""
    columns = sorted(result.columns)
    twin = con.execute(sql)
    names = [d[0] for d in twin.description]
    if sorted(names) != columns:
        return [f"columns {columns} against {sorted(names)}"]
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in twin.fetchall())
    ours = Counter(tuple(_plain(v) for v in r) for r in result.select(*columns).collect())
    only_ours, only_theirs = list((ours - theirs).elements()), list((theirs - ours).elements())
    if only_ours and len(only_ours) == len(only_theirs):
        pairs = zip(sorted(only_ours, key=repr), sorted(only_theirs, key=repr), strict=True)
        if all(all(x == y or _close(x, y) for x, y in zip(a, b, strict=True)) for a, b in pairs):
            return []
    return [f"{sum(ours.values())} rows against {sum(theirs.values())}"] * bool(only_ours or only_theirs) + [
        f"ours   {dict(zip(columns, r, strict=True))}" for r in sorted(only_ours, key=repr)[:2]
    ] + [f"theirs {dict(zip(columns, r, strict=True))}" for r in sorted(only_theirs, key=repr)[:2]]
