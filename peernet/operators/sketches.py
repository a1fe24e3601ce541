"""Approximate distinct counts that merge: accumulate, combine, estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def accumulate(value: Column) -> Column:
    return F.hll_sketch_agg(value)


def combine(sketch: Column) -> Column:
    return F.hll_union_agg(sketch)


def estimate(sketch: Column) -> Column:
    """Distinct count of a sketch, 0 for no sketch at all."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("bigint"))
