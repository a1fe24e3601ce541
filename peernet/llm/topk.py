"""Exact top-k search: tiles of queries x shards as matrix products, and a tree of top lists.

Vectors are dealt into query groups and shards of bounded size. A tile holds one of each; its kernel multiplies them in
slabs and keeps the k best per query. Lists of one query are merged `fan_in` at a time until one is left, so no task
ever holds more than fan_in * k entries of a query.

Defined results: a vector that is NULL or holds a NULL or non-finite component takes no part. A query meets the vectors
of its own dimension. Candidates that share an id are separate rows; all rows with the query's id are its own. Of query
rows that share an id, the smallest vector asks. Scores beyond the range of a long end at its bounds. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = (1 << 63) - 1
TILE_SCHEMA = "query_id long, part long, top array<struct<neg: long, vec_id: long>>"
TILE_ARROW = pa.schema(
    [("query_id", pa.int64()), ("part", pa.int64()),
     ("top", pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())])))]
)


def fixed_point(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) per component; NULL for a vector with a NULL or non-finite component."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.int64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dimension) if dimension else np.zeros((len(column), 0), np.int64)


def _products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer products; by floating-point matrix product while every partial sum fits its 53 bits."""
    top = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    bound = top(queries) * top(shard) * max(queries.shape[1], 1)
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ shard.T.astype(np.float64)).astype(np.int64)
    if bound < LIMIT:
        return queries @ shard.T
    exact = queries.astype(object) @ shard.T.astype(object)
    return np.clip(exact, -LIMIT, LIMIT).astype(np.int64)


def best_of_tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray, k: int, slab: int = 1 << 22
) -> list[list[tuple[int, int]]]:
    """Per query its k best (-score, id) pairs of the shard, ties to the smaller id. `ids` ascend."""
    out: list[list[tuple[int, int]]] = []
    n = len(ids)
    if not n:
        return [[] for _ in query_ids]
    for at in range(0, len(query_ids), max(1, slab // n)):
        scores = _products(queries[at : at + max(1, slab // n)], shard)
        asks = query_ids[at : at + len(scores)]
        for row, own in zip(scores, ids[None, :] == asks[:, None], strict=True):
            places = np.flatnonzero(~own)
            if len(places) > k:
                # All above the k-th score, then the first places of those equal to it.
                values = row[places]
                least = np.partition(values, len(values) - k)[len(values) - k]
                above = places[values > least]
                places = np.concatenate([above, places[values == least][: k - len(above)]])
            order = np.lexsort((ids[places], -row[places]))
            out.append([(-int(row[p]), int(ids[p])) for p in places[order]])
    return out


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str,
    vector_column: str,
    k: int = 10,
    query_rows: int = 4096,
    shard_rows: int = 65_536,
    least_shards: int = 256,
    fan_in: int = 16,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of `vectors` by integer inner product for every query.

    `vector_column` holds arrays of integers (see `fixed_point`). Shards hold at most about `shard_rows` rows, and fewer
    while that leaves under `least_shards` of them, so small tables are spread too.
    """
    usable = lambda df: df.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<long>").alias("v")
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows, asks = usable(vectors), usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    counts = rows.agg(F.count(F.lit(1))).first()[0], asks.agg(F.count(F.lit(1))).first()[0]
    groups = max(1, -(-counts[1] // query_rows))
    shards = max(1, -(-counts[0] // max(1, min(shard_rows, max(256, counts[0] // least_shards)))))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = asks.withColumn("q_part", deal(groups)).withColumn("part", every(shards))
    right = rows.withColumn("part", deal(shards)).withColumn("q_part", every(groups))

    def tile(ask: pa.Table, shard: pa.Table) -> pa.Table:
        found: list[tuple] = []
        sizes_a, sizes_s = (np.asarray([len(v) for v in t.column("v")], dtype=np.int64) for t in (ask, shard))
        for d in np.unique(sizes_a):
            a, s = ask.filter(pa.array(sizes_a == d)), shard.filter(pa.array(sizes_s == d)).sort_by("id")
            ids, asked = s.column("id").to_numpy(), a.column("id").to_numpy()
            tops = best_of_tile(asked, _matrix(a.column("v"), d), ids, _matrix(s.column("v"), d), k)
            part = shard.column("part")[0].as_py() if len(shard) else 0
            found += [(int(q), part, [{"neg": n, "vec_id": i} for n, i in top]) for q, top in zip(asked, tops, strict=True)]
        columns = list(zip(*found, strict=True)) if found else [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, TILE_ARROW, strict=True)], schema=TILE_ARROW)

    keys = ["q_part", "part"]
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, TILE_SCHEMA)
    while True:
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
        lists = lists.groupBy("query_id", F.floor(F.col("part") / fan_in).alias("part")).agg(merged.alias("top"))
        shards = -(-shards // fan_in)
        if shards == 1:
            break
    return lists.select("query_id", F.posexplode("top").alias("place", "best")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("best.vec_id").alias("vec_id"),
        (-F.col("best.neg")).alias("score"),
    )
