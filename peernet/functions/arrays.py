"""Array expressions; indices are 0-based as in the warehouse dialect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def index_of(value: Column, arr: Column) -> Column:
    """Position of the first match, NULL if there is none."""
    found = F.array_position(arr, value)
    return F.when(found > 0, found - 1)


def duplicate_indices(nodes: Column, peers: Column) -> Column:
    """Positions whose (node, peer) pair already occurred further left; by sorting the pairs, so a long array costs n log n."""
    pairs = F.arrays_zip(nodes.alias("n"), peers.alias("p"))
    # Equal pairs stand together, in order of position.
    ordered = F.array_sort(F.transform(pairs, lambda pair, i: F.struct(pair["n"].alias("n"), pair["p"].alias("p"), i.alias("i"))))
    again = F.filter(
        F.zip_with(
            F.slice(ordered, 2, F.size(ordered) - 1),
            F.slice(ordered, 1, F.size(ordered) - 1),
            lambda x, y: F.when(x["n"].eqNullSafe(y["n"]) & x["p"].eqNullSafe(y["p"]), x["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    none = F.array().cast("array<int>")
    return F.when(F.size(nodes) > 0, F.coalesce(F.array_sort(again), none)).when(F.size(nodes) == 0, none)


def remove_indices(arr: Column, indices: Column) -> Column:
    """The elements at the other positions. A NULL position, or NULL for all of them, leaves nothing, as no element is known to stay."""
    known = F.coalesce(~F.exists(indices, lambda i: i.isNull()), F.lit(False))
    kept = F.array_except(F.sequence(F.lit(0), F.size(arr) - 1), indices)  # hashed: no scan of `indices` per element
    some = F.transform(kept, lambda i: F.get(arr, i))
    return F.when(known & (F.size(arr) > 0), some).when(arr.isNotNull(), F.slice(arr, 1, 0))
