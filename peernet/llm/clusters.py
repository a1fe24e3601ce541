"""Centroid clustering over zone maps along a Hilbert curve.

Integer vectors are put in the order of a Hilbert curve through their space and cut into blocks, each with the smallest and
largest value per component (its box). No vector of a block is nearer to a centroid than its box, nor farther than the
box's far corner; so only the centroids whose nearest point of the box is not beyond the least far corner are candidates
for the block. Its vectors are then compared with those exactly, all at once. Blocks are stored once and read per round.

Sums per cluster are made in the tasks; what is read back per round are one row per cluster and component. Centroids are
exact integers: componentwise floor(sum / count).

Defined results: vectors that are NULL, hold a NULL, or have another number of components take no part. Fewer rows than
clusters make as many clusters as rows with an id. Rows that share an id are separate vectors; among equal hashes the
smaller vector starts first. A row with a NULL id starts no centroid, but is assigned. Without any id there are no rows.
Distances and sums beyond the range of a long end at its bound. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peernet.llm.common import stage

LIMIT = (1 << 63) - 1


def hilbert_keys(levels: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve, as bytes in curve order, of rows of components under 2^bits.

    From the highest bit down, a component's set bit mirrors the lower bits of the first component, an unset one exchanges
    them; a Gray code over all components then gives the digits of the place.
    """
    x = levels.astype(np.int64).T.copy()
    d, n = x.shape
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            unset = np.where(x[i] >> b & 1, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] >> b & 1, low, unset)
            if i:
                x[i] ^= unset
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    digits = np.concatenate([x >> b & 1 for b in range(bits - 1, -1, -1)]).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(digits.T, axis=1)]


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box, ascending. Arrays of Python ints."""
    gap = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    return np.flatnonzero((gap * gap).sum(axis=1) <= (far * far).sum(axis=1).min())


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) per vector, exactly; ties to the first centroid."""
    top = max(1, *(abs(int(e)) for m in (vectors, centroids) if m.size for e in (m.max(), m.min())))
    bound = 4 * top * top * max(1, vectors.shape[1])
    if bound < 1 << 53:  # every partial sum is a whole number that floating point holds
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        squares = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)
    else:
        kind = np.int64 if bound < LIMIT else object
        v, c = vectors.astype(kind), centroids.astype(kind)
        squares = np.stack([((v - row) * (v - row)).sum(axis=1) for row in c], axis=1)
    best = np.argmin(squares, axis=1)
    return best, squares[np.arange(len(best)), best]


BLOCKS = "ids array<long>, vectors binary, low binary, high binary"
BLOCKS_ARROW = pa.schema(
    [("ids", pa.list_(pa.int64())), ("vectors", pa.binary()), ("low", pa.binary()), ("high", pa.binary())]
)
RANGES_ARROW = pa.schema([("place", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])
KEYS_ARROW = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int64())), ("key", pa.binary())])
SUMS_ARROW = pa.schema(
    [("cluster", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())]
)
ASSIGNED = "vec_id long, cluster int, distance long"
ASSIGNED_ARROW = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimension)


def _rows(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def zone_blocks(rows: DataFrame, dimension: int, bits: int, block_rows: int) -> DataFrame:
    """Stored BLOCKS of the (id, v) rows, in curve order."""

    def extents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if len(batch):
                m = _matrix(batch.column("v"), dimension)
                low = m.min(axis=0) if low is None else np.minimum(low, m.min(axis=0))
                high = m.max(axis=0) if high is None else np.maximum(high, m.max(axis=0))
        if low is not None:
            yield _rows([np.arange(dimension), low, high], RANGES_ARROW)

    ranges = rows.select("v").mapInArrow(extents, "place int, low long, high long").groupBy("place")
    box = ranges.agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("place").collect()
    floor, width = [r["low"] for r in box], [r["high"] - r["low"] + 1 for r in box]

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("v"), dimension)
            # The key only orders rows, so its levels may be rounded.
            share = (m.astype(np.float64) - np.array(floor, np.float64)) / np.array(width, np.float64)
            levels = np.clip((share * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1)
            yield _rows([batch.column("id"), batch.column("v"), hilbert_keys(levels, bits)], KEYS_ARROW)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], np.zeros((0, dimension), np.int64)
        for batch in _and_end(batches):
            if batch is not None:
                ids += batch.column("id").to_pylist()
                held = np.concatenate([held, _matrix(batch.column("v"), dimension)])
            while len(ids) >= block_rows or (batch is None and ids):
                some, held = held[:block_rows], held[block_rows:]
                box = [some.astype("<i8").tobytes(), some.min(axis=0).astype("<i8").tobytes(), some.max(axis=0).astype("<i8").tobytes()]
                yield _rows([[ids[:block_rows]], *([x] for x in box)], BLOCKS_ARROW)
                ids = ids[block_rows:]

    # Equal vectors share a key; the row's number in its input partition lets them be dealt over several ranges.
    curve = rows.mapInArrow(keyed, "id long, v array<long>, key binary").withColumn("spread", F.monotonically_increasing_id())
    dealt = curve.repartitionByRange("key", F.xxhash64("spread")).sortWithinPartitions("key", "id")
    return stage(dealt.select("id", "v").mapInArrow(cut, BLOCKS), "blocks")


def _and_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _opened(batch: pa.RecordBatch, dimension: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    for row in zip(*(batch.column(c) for c in ("ids", "vectors", "low", "high")), strict=True):
        ids, *parts = (x.as_py() for x in row)
        yield ids, *(np.frombuffer(p, "<i8").reshape(shape) for p, shape in zip(parts, ((-1, dimension), (dimension,), (dimension,)), strict=True))


def _assigned(batches: Iterable[pa.RecordBatch], centroids: list[list[int]], dimension: int):
    """(ids, vectors, clusters, distances) per block."""
    c = np.array(centroids, object).reshape(len(centroids), dimension)
    for batch in batches:
        for ids, v, low, high in _opened(batch, dimension):
            some = candidates(low.astype(object), high.astype(object), c)
            best, squares = nearest(v, c[some].astype(np.int64))
            yield ids, v, some[best], squares


def cluster_vectors(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    k: int = 16,
    rounds: int = 3,
    dimension: int = 64,
    bits: int = 3,
    block_rows: int = 256,
    seed: int = 1,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of integers.

    Centroids start as the k vectors whose SHA-256 of `seed:id` is smallest, and move `rounds` times.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<long>").alias("v"))
    rows = rows.where((F.size("v") == dimension) & ~F.exists("v", F.isnull))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.where(F.col("id").isNotNull()).select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    centroids = [list(r["v"]) for r in first]
    if not centroids:
        return spark.createDataFrame([], f"{ASSIGNED}, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = zone_blocks(rows, dimension, bits, block_rows)

    def sums(centroids: list[list[int]]):
        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, counts = np.zeros((len(centroids), dimension), object), [0] * len(centroids)
            for _, v, clusters, _ in _assigned(batches, centroids, dimension):
                safe = int(np.abs(v.astype(object)).max()) * len(v) < LIMIT
                for c in np.unique(clusters).tolist():
                    own = v[clusters == c]
                    totals[c] += (own if safe else own.astype(object)).sum(axis=0).astype(object)
                    counts[c] += len(own)
            out = [(c, i, Decimal(int(totals[c, i])), counts[c]) for c in range(len(centroids)) if counts[c] for i in range(dimension)]
            if out:
                yield _rows(list(map(list, zip(*out, strict=True))), SUMS_ARROW)

        return add

    for _ in range(rounds):
        found = blocks.mapInArrow(sums(centroids), "cluster int, place int, total decimal(38,0), n long")
        per_place = found.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in per_place.collect():  # clusters x components rows
            centroids[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, clusters, squares in _assigned(batches, centroids, dimension):
            yield _rows([ids, clusters.tolist(), [min(int(s), LIMIT) for s in squares]], ASSIGNED_ARROW)

    assigned = stage(blocks.mapInArrow(assign, ASSIGNED), "assigned")
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = {r["cluster"]: int(r["total"]) for r in per_cluster}
    every = min(sum(inertia.values()), LIMIT)
    told = [
        (c, min(total, LIMIT), every, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, total in inertia.items()
    ]
    facts = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # At most k rows.
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle(k: int = 16, rounds: int = 3, dimension: int = 64, scale: int = 64, seed: int = 1) -> str:
    """The same in DuckDB SQL: every vector against every centroid."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
     FROM embeddings WHERE len(embedding) = {dimension}
     AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR), v) - 1)::INT AS c, v
     FROM v WHERE vec_id IS NOT NULL QUALIFY c < {k})""",
    ]
    square = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT v.r, v.vec_id, v.v, c.c, {square} AS d FROM v, c{i} c
     QUALIFY row_number() OVER (PARTITION BY v.r ORDER BY d, c.c) = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""s{i} AS (SELECT c, p, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({dimension})) AS p FROM a{i}) GROUP BY c, p),
     m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS v FROM s{i} GROUP BY c),
     c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m USING (c))"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON a.c = f.c"""
