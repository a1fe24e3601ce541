"""Near-duplicate documents by DartMinHash over weighted word shingles, bands, and an exact check.

A document is the multiset of its shingles of five words: a shingle that occurs w times is a region of weight w, cut into
unit cells. Over each cell, darts fall at hashed ranks with rate one; a dart also hashes to one of K coordinates. The
signature keeps the earliest dart per coordinate. Darts depend on cell and rank only, so two documents agree in a
coordinate with the probability of their weighted Jaccard index. Ranks are looked through up to about K ln K + 2K darts per
document, and further only where a coordinate is still empty; so the work is that of the document's length plus a
constant.

Cells also flip bits of an odd sketch: two sketches differ in at most as many bits as the documents differ in cells, so a
pair whose sketches differ in more than the threshold allows is refused without looking at its cells.

Equal texts (after normalisation) are one node. Nodes that agree in a band of coordinates are compared by the exact
weighted Jaccard index of their cells (`groups.bucket_links`), and linked from `threshold` up. A class is a connected
group and is named by its smallest id. Cells are compared by 32 bits: of two documents of n cells, about n * n / 2^32 cells
agree by chance.

Defined results: texts of one to four words are one shingle. Texts without words are equal if their characters are, and
never near; a NULL text is alone. Rows that share an id are one document, whose texts are linked. A row with a NULL id has
a NULL class. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peernet.llm.common import fresh, normal_words, stage
from peernet.llm.groups import bucket_links, connected, first_shared

SHINGLE, BANDS, ROWS = 5, 25, 5
SKETCH_WORDS = 32  # longs of an odd sketch
BATCH_WORDS, BATCH_TEXTS = 1 << 17, 400  # signed at once; darts take memory by texts as well as by words

_GOLD, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE, _INVERSE = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
# Chances that a Poisson variable of mean 1 is at most 0, 1, 2, ...
_POISSON = np.exp(-1) * np.cumsum(1 / np.cumprod([1.0, *range(1, 16)]))


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base, np.uint64)]), dtype=np.uint64)


def shingle_cells(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(cells, document of each cell): hashed (shingle, copy number) pairs of normalised texts, documents in order."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    blanks = np.flatnonzero(data == 32)
    filled = lengths > 0
    word_starts = np.sort(np.concatenate([starts[filled], blanks + 1]))
    word_ends = np.sort(np.concatenate([ends[filled], blanks]))
    if not len(word_starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # A word's hash is the difference of two prefix sums, freed of its place.
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    words = _mix((sums[word_ends] - sums[word_starts]) * _powers(_INVERSE, len(data) + 1)[word_starts])
    doc = np.searchsorted(ends, word_starts, side="right")
    first = np.searchsorted(doc, np.arange(len(texts)), side="left")
    n_words = np.searchsorted(doc, np.arange(len(texts)), side="right") - first
    place = np.arange(len(words)) - first[doc]
    at = np.flatnonzero((place <= n_words[doc] - size) | (place == 0))
    shingles, owner = np.zeros(len(at), np.uint64), doc[at]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for j in range(size):
        inside = place[at] + j < n_words[owner]
        shingles = (shingles + np.where(inside, padded[at + j], np.uint64(0))) * _GOLD + np.uint64(1)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    index = np.arange(len(shingles))
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    copy = index - np.maximum.accumulate(np.where(new, index, 0))
    return _mix(shingles + copy.astype(np.uint64) * _M2), owner


def dart_signatures(cells: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k: the earliest dart per document and coordinate; documents without cells keep the highest value."""
    best = np.full(n * k, _FULL)
    weight = np.bincount(owner, minlength=n)
    low, high = np.zeros(n), (k * log(k) + 2 * k) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        some = todo[owner]
        cell, doc = cells[some], owner[some]
        first, last = np.floor(low[doc]).astype(np.int64), np.ceil(high[doc]).astype(np.int64)
        # One square of unit weight and unit rank after the other; each holds a Poisson number of darts.
        spread = last - first
        at = np.repeat(np.arange(len(cell)), spread)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(spread) - spread, spread) + first[at]
        square = _mix(cell[at] + rank.astype(np.uint64) * _GOLD)
        darts = np.searchsorted(_POISSON, (square >> np.uint64(11)).astype(np.float64) / (1 << 53))
        of = np.repeat(np.arange(len(at)), darts)
        number = np.arange(len(of)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = _mix(square[of] + (number.astype(np.uint64) + np.uint64(1)) * _M1)
        depth = rank[of] + (dart >> np.uint64(34)).astype(np.float64) / (1 << 30)
        doc = doc[at[of]]
        near = (depth >= low[doc]) & (depth < high[doc])
        dart, depth, doc = dart[near], depth[near], doc[near]
        coordinate = (_mix(dart) % np.uint64(k)).astype(np.int64)
        value = ((depth * (1 << 30)).astype(np.uint64) << np.uint64(20)) | (dart & np.uint64((1 << 20) - 1))
        np.minimum.at(best, doc * k + coordinate, value)
        todo &= (best.reshape(n, k) == _FULL).any(axis=1)
        low, high = np.where(todo, high, low), np.where(todo, 2 * high, high)
    return best.reshape(n, k)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), np.uint64)
    for r in range(rows):
        keys = _mix((keys + signatures[:, r::rows][:, :bands]) * _GOLD + np.uint64(1))
    return _mix(keys + np.arange(bands, dtype=np.uint64)[None, :] * _M2)


def odd_sketches(cells: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x SKETCH_WORDS: per document the bits that an odd number of its cells hash to."""
    bit = _mix(cells + _GOLD) % np.uint64(64 * SKETCH_WORDS)
    out = np.zeros(n * SKETCH_WORDS, np.uint64)
    np.bitwise_xor.at(out, owner * SKETCH_WORDS + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(n, SKETCH_WORDS)


SIGNED = "doc_id long, h1 long, h2 long, cells array<int>, bands array<long>, sketch array<long>"
SIGNED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("cells", pa.list_(pa.int32())),
     ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)


def _signed(bands: int, rows: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column("norm")]
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or (j - i < BATCH_TEXTS and size + len(texts[j]) <= 6 * BATCH_WORDS)):
                    size, j = size + len(texts[j]), j + 1
                with np.errstate(over="ignore"):
                    cells, owner = shingle_cells(texts[i:j])
                    sketches = odd_sketches(cells, owner, j - i)
                    keys = band_keys(dart_signatures(cells, owner, j - i, bands * rows), bands, rows)
                small = (cells >> np.uint64(32)).astype(np.uint32).view(np.int32)
                ends = np.searchsorted(owner, np.arange(j - i + 1), side="left").astype(np.int32)
                filled = np.diff(ends) > 0
                sketch_ends = np.arange(0, (j - i + 1) * SKETCH_WORDS, SKETCH_WORDS, dtype=np.int32)
                key_ends = np.concatenate([[0], np.cumsum(filled * bands)]).astype(np.int32)
                yield pa.record_batch(
                    [
                        *(batch.column(c).slice(i, j - i) for c in ("doc_id", "h1", "h2")),
                        pa.ListArray.from_arrays(ends, pa.array(small)),
                        pa.ListArray.from_arrays(key_ends, pa.array(keys[filled].reshape(-1).view(np.int64))),
                        pa.ListArray.from_arrays(sketch_ends, pa.array(sketches.reshape(-1).view(np.int64))),
                    ],
                    schema=SIGNED_ARROW,
                )
                i = j

    return sign


def _texts(signed: DataFrame, shared: DataFrame) -> DataFrame:
    """One signed row per id and text, with a `name` of its own: the id, or a hash where the id has several texts."""
    own = signed.where(F.col("doc_id").isNotNull())
    if shared.isEmpty():
        return own.withColumn("name", F.col("doc_id"))
    single = own.join(shared, "doc_id", "left_anti").withColumn("name", F.col("doc_id"))
    once = own.join(shared, "doc_id").groupBy("doc_id", "h1", "h2", "differ")
    once = once.agg(*[F.first(c).alias(c) for c in ("cells", "bands", "sketch")])
    name = F.when(F.col("differ"), F.xxhash64(F.lit("text"), "doc_id", "h1", "h2")).otherwise(F.col("doc_id"))
    return stage(single.unionByName(once.withColumn("name", name).drop("differ")), "texts")


def near_duplicate_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, class_id) per row of `docs`."""
    text = F.col(text_column)
    norm = normal_words(text)
    known = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        # Texts without words keep their characters, which no normalised text can equal.
        F.when(text.isNotNull(), F.when(norm == "", F.concat(F.lit("\x00"), text)).otherwise(norm)).alias("whole"),
        norm.alias("norm"),
    ).select("doc_id", F.xxhash64("whole").alias("h1"), F.xxhash64(F.lit(1), "whole").alias("h2"), "norm", F.isnull("whole").alias("no_text"))
    # A NULL text is alone: its hashes are those of its id.
    known = known.select(
        "doc_id",
        F.when(F.col("no_text"), F.xxhash64(F.lit("no text"), "doc_id")).otherwise(F.col("h1")).alias("h1"),
        F.when(F.col("no_text"), F.xxhash64("doc_id", F.lit("no text"))).otherwise(F.col("h2")).alias("h2"),
        "norm",
    )
    signed = stage(known.mapInArrow(_signed(bands, rows), SIGNED), "signed")
    shared = stage(
        signed.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h1", "h2")).alias("x"), F.max(F.struct("h1", "h2")).alias("y"))
        .where(F.col("n") > 1)
        .select("doc_id", (F.col("x") != F.col("y")).alias("differ")),
        "shared",
    )
    texts = _texts(signed, shared)
    # One node per distinct text: its smallest name.
    nodes = stage(
        texts.groupBy("h1", "h2").agg(
            F.min("name").alias("node"),
            F.first("bands").alias("bands"),
            F.first(F.size("cells")).alias("size"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    cells = texts.select(F.col("name").alias("node"), "cells").where(F.size("cells") > 0)

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(cells.select(F.col("node").alias("a"), F.col("cells").alias("x")), "a").join(
            cells.select(F.col("node").alias("b"), F.col("cells").alias("y")), "b"
        )
        common = F.size(F.array_intersect("x", "y"))
        alike = common / (F.size("x") + F.size("y") - common)
        return both.where(alike >= threshold).select("a", "b").distinct()

    # What a pair may differ in: from J >= t follows |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|).
    share = (1 - threshold) / (1 + threshold)

    def possible(x: Column, y: Column) -> Column:
        words = [F.get(x["sketch"], i).bitwiseXOR(F.get(y["sketch"], i)) for i in range(SKETCH_WORDS)]
        differ = reduce(lambda a, b: a + b, map(F.bit_count, words))
        return differ <= F.floor((x["size"] + y["size"]) * F.lit(share) + F.lit(1e-9))

    def meeting(x: Column, y: Column) -> Column:
        return first_shared(*([F.get(z["bands"], i) for i in range(bands)] for z in (x, y)))

    payloads = nodes.select("node", F.struct("size", "sketch", "bands").alias("payload"))
    links = bucket_links(members, payloads, possible, meeting, verify)
    placed = texts.select("doc_id", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"])
    placed = stage(placed.select("doc_id", "node"), "placed")
    # An id of several texts, which names none of them, ties their nodes together.
    several = shared.where("differ").select("doc_id")
    ties = placed.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    roots = connected(links.unionByName(ties))
    rooted = placed.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("class_id"))
    if not several.isEmpty():  # hashed names are no ids: a class is named again, by its smallest id
        rooted = stage(rooted.distinct(), "rooted")
        smallest = rooted.groupBy("class_id").agg(F.min("doc_id").alias("smallest"))
        rooted = rooted.join(smallest, "class_id").select("doc_id", F.col("smallest").alias("class_id"))
    grouped = rooted.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    grouped = stage(grouped, "classes")
    return docs.select(F.col(id_column).cast("long").alias("doc_id")).join(grouped, "doc_id", "left")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One document of each class, the one with the smallest id; of rows that share an id, one row. Rows with a NULL id
    all stay."""
    classes = near_duplicate_classes(docs, id_column, text_column, **settings)
    key, other, place = F.col(id_column).cast("long"), fresh(docs, "_other"), fresh(docs, "_place")
    gone = classes.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias(other)).distinct()
    kept = docs.join(stage(gone, "gone"), key == F.col(other), "left_anti")
    counts = docs.where(key.isNotNull()).groupBy(key.alias(other)).agg(F.count(F.lit(1)).alias(place))
    repeated = stage(counts.where(F.col(place) > 1).select(other), "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, key == F.col(other), "left_anti")
    order = Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns))
    many = kept.join(repeated, key == F.col(other), "left_semi").withColumn(place, F.row_number().over(order))
    return once.unionByName(many.where(F.col(place) == 1).drop(place))
