"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

Two documents of one source, or of one duplicate cluster, never share a bin. Documents longer than a bin are cut into full
bins and a rest. Pieces are placed by decreasing length: bins are kept in the order of the room they have left, and carry a
bitmap of their sources and one of their clusters; from the first bin that is large enough the search goes on, in that
order, to the first whose bitmaps allow the piece, which is the tightest compatible bin. Otherwise a new bin opens.

Only ids, lengths, sources and clusters move. They are dealt by a hash into shards of about `shard_rows` rows, which are
packed side by side; a bin belongs to one shard. So a task's memory is bounded by the shard, and any source or cluster, of
any size, is spread over all shards.

Defined results: a NULL source or cluster conflicts with nothing. A row whose length is NULL or not positive, or whose id is
NULL, gets a row without bin and with length 0. Rows that share an id are packed apart. Ties go to the smaller id, then
source, then cluster, and to the older bin. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKED = "doc_id long, piece int, bin_id long, start int, length int"
BIN_BITS = 32  # a bin's number within its shard


def _bit_places(values: Iterable, only_shared: bool) -> tuple[np.ndarray, int]:
    """Bit of every value (-1: none), and the number of bits. Values that occur once conflict with nothing."""
    codes, kinds = pd.factorize(pd.Series(values, dtype=object), use_na_sentinel=True)
    if only_shared and len(kinds):
        counts = np.bincount(codes[codes >= 0], minlength=len(kinds))
        places = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)
        codes = np.where(codes >= 0, places[np.maximum(codes, 0)], -1)
    return codes, int(codes.max(initial=-1)) + 1


class Bitmaps:
    """One bitmap per bin, grown as bins open."""

    def __init__(self, bits: int):
        self.words = max(1, -(-bits // 64))
        self.rows = np.zeros((64, self.words), np.uint64)

    def open(self, n: int) -> None:
        if n > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])

    def free(self, bins: np.ndarray, bit: int) -> np.ndarray:
        if bit < 0:
            return np.ones(len(bins), bool)
        return self.rows[bins, bit >> 6] & np.uint64(1 << (bit & 63)) == 0

    def mark(self, number: int, bit: int) -> None:
        if bit >= 0:
            self.rows[number, bit >> 6] |= np.uint64(1 << (bit & 63))


def best_fit(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, start in it) of pieces 1..capacity long, in the given order; sources and clusters are bit places."""
    held = Bitmaps(int(sources.max(initial=-1)) + 1), Bitmaps(int(clusters.max(initial=-1)) + 1)
    order = np.empty(max(64, len(lengths)), np.int64)  # room << BIN_BITS | bin, ascending
    used, bins = 0, 0
    placed, starts = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    mask = (1 << BIN_BITS) - 1
    for i, (length, source, cluster) in enumerate(zip(lengths.tolist(), sources.tolist(), clusters.tolist(), strict=True)):
        at, step, found = int(np.searchsorted(order[:used], length << BIN_BITS)), 16, -1
        while at < used:
            some = order[at : min(used, at + step)] & mask
            fit = held[0].free(some, source) & held[1].free(some, cluster)
            first = int(fit.argmax())
            if fit[first]:
                found = at + first
                break
            at, step = at + step, step * 4
        if found >= 0:
            room, number = int(order[found]) >> BIN_BITS, int(order[found]) & mask
            order[found : used - 1] = order[found + 1 : used]
            used -= 1
        else:
            room, number = capacity, bins
            bins += 1
            for h in held:
                h.open(bins)
        held[0].mark(number, source)
        held[1].mark(number, cluster)
        placed[i], starts[i] = number, capacity - room
        if room > length:
            key = (room - length) << BIN_BITS | number
            at = int(np.searchsorted(order[:used], key))
            order[at + 1 : used + 1] = order[at:used]
            order[at] = key
            used += 1
    return placed, starts


def pack_shard(rows: pd.DataFrame, capacity: int, shard: int = 0) -> pd.DataFrame:
    """Rows (doc_id, length, source, cluster) of one shard as PACKED rows; lengths are positive."""
    rows = rows.sort_values(["doc_id", "source", "cluster", "length"], kind="stable", na_position="first")
    lengths = rows["length"].to_numpy(np.int64)
    ids = rows["doc_id"].to_numpy(np.int64)
    full, rest = lengths // capacity, lengths % capacity
    parts = full + (rest > 0)
    owner = np.repeat(np.arange(len(rows)), parts)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    size = np.where(piece < full[owner], capacity, rest[owner])
    sources, _ = _bit_places(rows["source"], only_shared=True)
    clusters, _ = _bit_places(rows["cluster"], only_shared=True)
    order = np.argsort(-size, kind="stable")
    # A piece that fills a bin alone needs no search.
    whole = size[order] == capacity
    alone, shared = order[whole], order[~whole]
    bins, starts = np.empty(len(owner), np.int64), np.zeros(len(owner), np.int64)
    bins[alone] = np.arange(len(alone))
    found, at = best_fit(size[shared], sources[owner[shared]], clusters[owner[shared]], capacity)
    bins[shared], starts[shared] = found + len(alone), at
    return pd.DataFrame(
        {"doc_id": ids[owner], "piece": piece, "bin_id": (shard << BIN_BITS) + bins, "start": starts, "length": size}
    ).astype({"piece": "int32", "start": "int32", "length": "int32"})


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    id_column: str = "doc_id",
    length_column: str = "length",
    source_column: str = "source",
    cluster_column: str = "cluster",
    shard_rows: int = 20_000,
) -> DataFrame:
    """PACKED rows: every document's pieces with bin and place."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(length_column).cast("long").alias("length"),
        F.col(source_column).cast("string").alias("source"),
        F.col(cluster_column).cast("string").alias("cluster"),
    )
    usable = F.coalesce((F.col("length") > 0) & F.col("doc_id").isNotNull(), F.lit(False))
    shards = max(1, -(-rows.count() // shard_rows))
    # More shards than rows need would only waste bins, so each is as large as a task can hold.
    shard = F.pmod(F.xxhash64("doc_id", "source", "cluster", "length"), F.lit(shards))

    def pack(key: tuple, shard_of_rows: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(shard_of_rows, capacity, int(key[0]))

    packed = rows.where(usable).withColumn("shard", shard).groupBy("shard").applyInPandas(pack, PACKED)
    unusable = rows.where(~usable).select(
        "doc_id", F.lit(0).alias("piece"), F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("start"),
        F.lit(0).alias("length"),
    )
    return packed.unionByName(unusable)


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with the length in words and an end mark, and a cluster of equal texts, for packing whole documents."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return docs.select(
        "doc_id", (words + 1).alias("length"), "source", F.when(text != "", F.xxhash64(F.lower(text))).alias("cluster")
    )
