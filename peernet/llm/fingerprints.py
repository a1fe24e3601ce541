"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, per length, the polynomial hash of that many first code points, modulo a prime, for two
bases. Differences of two entries give the hash of any span, so spans compare in constant time, the longest common
extension of two places is a binary search, and the hash of a text put together from parts follows from the parts' arrays.

A fingerprint holds the length, both hashes of the whole text, and the smallest hashes of all its spans of SPAN code
points (the whole text as one span if it is shorter). Likeness is 1 for equal length and hashes, else the share of common
values among the smallest of both (an estimate of the spans' Jaccard index).

Neighbours: texts are dealt once into id ranges and sorted there; a range's tasks see each text and its successor. The
last text of a range meets the first of the next one in a second small step with two texts per range.

Defined results: a NULL text is an empty one. Rows that share an id follow each other by the hash of their
text, then by text. NULL ids come first. The
only row of a table is its own successor. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peernet.llm.common import stage

PRIME = (1 << 31) - 1  # Fixed values: the modulus, and the two bases below it.
BASES = (1_000_003, 911_382_323)
SPAN, SKETCH = 24, 32


@lru_cache(maxsize=16)
def _powers(base: int, bits: int) -> np.ndarray:
    """base^0 .. base^(2^bits - 1) modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    for i in range(bits):
        out = np.concatenate([out, out * np.uint64(pow(base, 1 << i, PRIME)) % np.uint64(PRIME)])
    return out


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, max(n - 1, 1).bit_length())[:n]


class Prefixes:
    """Prefix hashes of one text; hashes[b][n] covers its first n code points."""

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        self.n = len(self.codes)
        self.hashes = []
        for base in BASES:
            terms = (self.codes + np.uint64(1)) * powers(base, self.n) % np.uint64(PRIME)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.hashes.append(sums % np.uint64(PRIME))
        self._spans: np.ndarray | None = None
        self.print: Fingerprint | None = None

    def whole(self, n: int | None = None) -> tuple[int, ...]:
        return tuple(int(h[self.n if n is None else n]) for h in self.hashes)

    def span(self, start: int, length: int) -> tuple[int, ...]:
        """Hashes of a span, independent of where it stands."""
        return tuple(
            (int(h[start + length]) - int(h[start])) * pow(base, -start, PRIME) % PRIME
            for h, base in zip(self.hashes, BASES, strict=True)
        )

    def spans(self) -> np.ndarray:
        """A 32-bit value per span of SPAN code points, in order of place."""
        if self._spans is None:
            if self.n < SPAN:
                self._spans = _mixed(np.asarray(self.span(0, self.n)[:1] if self.n else (), np.uint64))
            else:
                h = self.hashes[0]
                away = (h[SPAN:] + np.uint64(PRIME) - h[: len(h) - SPAN]) % np.uint64(PRIME)
                back = powers(pow(BASES[0], -1, PRIME), self.n - SPAN + 1)
                self._spans = _mixed(away * back % np.uint64(PRIME))
        return self._spans


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread values over 32 bits, so that the smallest are a fair sample."""
    with np.errstate(over="ignore"):
        x = values * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)


def smallest(values: np.ndarray, k: int = SKETCH) -> tuple[int, ...]:
    """The k smallest distinct values, ascending."""
    if len(values) > 4 * k:
        few = sorted(set(np.partition(values, 2 * k)[: 2 * k].tolist()))
        if len(few) >= k:
            return tuple(few[:k])
    return tuple(sorted(set(values.tolist()))[:k])


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common extension of place i of a and place j of b, by binary search on span equality."""
    low, high = 0, min(a.n - i, b.n - j)
    # A span's hash at place i carries the factor base^i, so each side is raised by the other's.
    sides = [
        (x, int(x[i]), pow(base, j, PRIME), y, int(y[j]), pow(base, i, PRIME))
        for x, y, base in zip(a.hashes, b.hashes, BASES, strict=True)
    ]
    while low < high:
        n = (low + high + 1) // 2
        if all((int(x[i + n]) - xi) * up % PRIME == (int(y[j + n]) - yj) * vp % PRIME for x, xi, up, y, yj, vp in sides):
            low = n
        else:
            high = n - 1
    return low


Fingerprint = tuple[int, tuple[int, ...], tuple[int, ...]]


def fingerprint(a: Prefixes) -> Fingerprint:
    if a.print is None:
        a.print = a.n, a.whole(), smallest(a.spans())
    return a.print


def joined_fingerprint(a: Prefixes, keep: int, b: Prefixes, take: int) -> Fingerprint:
    """That of the first `keep` code points of a followed by the first `take` of b, from the two prefix arrays."""
    n = keep + take
    whole = tuple(
        (int(x[keep]) + pow(base, keep, PRIME) * int(y[take])) % PRIME
        for x, y, base in zip(a.hashes, b.hashes, BASES, strict=True)
    )
    if n < SPAN:
        values = smallest(_mixed(np.asarray(whole[:1] if n else (), np.uint64)))
    else:
        parts = [x.spans()[: max(0, m - SPAN + 1)] for x, m in ((a, keep), (b, take))]
        seam = np.concatenate([a.codes[max(0, keep - SPAN + 1) : keep], b.codes[: min(take, SPAN - 1)]])
        if len(seam) >= SPAN and keep and take:
            parts.append(Prefixes(seam.astype("<u4").tobytes().decode("utf-32-le")).spans())
        values = tuple(sorted({v for p in parts for v in smallest(p)})[:SKETCH])
    return n, whole, values


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if a[:2] == b[:2]:
        return 1.0
    ours, theirs = set(a[2]), set(b[2])
    both = sorted(ours | theirs)[:SKETCH]
    return round(sum(v in ours and v in theirs for v in both) / len(both), 6) if both else 0.0


def written(f: Fingerprint) -> str:
    return f"{f[0]:x}-{''.join(f'{h:08x}' for h in f[1])}-{''.join(f'{v:08x}' for v in f[2])}"


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, common_next long, common_edited long"
)
ROW_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
     ("common_next", pa.int64()), ("common_edited", pa.int64())]
)
PART_ARROW = pa.schema([*ROW_ARROW, ("part", pa.int64()), ("head", pa.string()), ("tail", pa.string())])
Text = tuple[int | None, str, Prefixes]


def compare(doc: Text, successor: Text) -> tuple:
    """A document's row: its text, the text with its last half replaced from the successor, and the successor."""
    (doc_id, text, a), (_, next_text, b) = doc, successor
    half = a.n // 2
    keep, take = a.n - half, min(half, b.n)
    own, edited = fingerprint(a), joined_fingerprint(a, keep, b, take)
    sha = hashlib.sha256((text[:keep] + next_text[:take]).encode()).hexdigest()
    common = keep + common_extension(a, keep, b, 0) if take else keep
    return (doc_id, a.n, sha, written(own), written(edited), likeness(own, edited), likeness(own, fingerprint(b)),
            common_extension(a, 0, b, 0), min(common, keep + take))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _within(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range but for its last text, which goes out as `tail`; its first text goes out as `head`."""
    part, last, rows = TaskContext.get().partitionId(), None, []
    blank = (None,) * len(ROW_ARROW)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            now = doc_id, text, Prefixes(text)
            rows.append((*compare(last, now), part, None, None) if last else (*blank, part, text, None))
            last = now
            if len(rows) >= 2000:
                yield _table(rows, PART_ARROW)
                rows = []
    if last:
        rows.append((last[0], *blank[1:], part, None, last[1]))
    yield _table(rows, PART_ARROW)


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            compare((r["doc_id"], r["tail"], Prefixes(r["tail"])), (None, r["head"], Prefixes(r["head"])))
            for r in batch.to_pylist()
        ]
        yield _table(rows, ROW_ARROW)


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_next,
    common_edited) per row; the last two are the code points that the text shares from its start with the next text
    and with its edited text."""
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    tie = F.xxhash64("text")
    dealt = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    found = stage(dealt.mapInArrow(_within, f"{FIELDS}, part long, head string, tail string"), "fingerprints")
    heads = found.where(F.col("head").isNotNull()).select(F.col("part").alias("next_part"), "head")
    parts = heads.select(F.col("next_part").alias("part"))  # one row per range that has texts
    in_order = Window.orderBy("part")
    everything = Window.partitionBy()
    follows = parts.select(
        "part", F.coalesce(F.lead("part").over(in_order), F.min("part").over(everything)).alias("next_part")
    )
    tails = found.where(F.col("tail").isNotNull()).select("doc_id", "part", "tail")
    last = tails.join(follows, "part").join(heads, "next_part").select("doc_id", "tail", "head")
    inner = found.where(F.col("n_chars").isNotNull()).drop("part", "head", "tail")
    return inner.unionByName(last.mapInArrow(_across, FIELDS))
