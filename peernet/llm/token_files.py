"""Token ids in files of patched frame-of-reference blocks.

A block holds up to BLOCK ids: the block's minimum is subtracted, the rest is packed at the width that a given share of
them needs, and the ids that need more are also kept in full in an exception list. A file ends with a table of its
documents (id, number of tokens) and the start of every block, so any span of ids is read without the blocks before it.

Documents are dealt once, as text, into id ranges; a task tokenizes its sorted range and writes one file, and returns a
manifest row. The manifest is written by Spark's committer and names the file of one attempt per task; a lost or repeated
attempt leaves an unlisted file. A running sum over the manifest (one row per file) gives every file its place in the
whole sequence.

Defined results: a NULL text is an empty one and holds the end id alone. Rows that share an id follow each other by
the hash of their text, then by text. NULL ids come first. Other columns are ignored. An empty table gives an empty manifest.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peernet.llm.common import open_store

MAGIC = b"PFORIDS1"
BLOCK, PERCENTILE = 4096, 95.0
_BLOCK_HEAD = struct.Struct("<IHBH")  # minimum, ids, width, exceptions
_TRAILER = struct.Struct("<QQQQ8s")  # documents, blocks, ids, start of the document table, magic


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    at = min(len(rest) - 1, int(len(rest) * percentile / 100))
    width = int(np.partition(rest, at)[at]).bit_length()
    outliers = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    head = _BLOCK_HEAD.pack(low, len(rest), width, len(outliers))
    return head + packed + outliers.astype("<u2").tobytes() + rest[outliers].astype("<u4").tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    low, n, width, n_out = _BLOCK_HEAD.unpack_from(data)
    end = _BLOCK_HEAD.size + (n * width + 7) // 8
    packed = np.frombuffer(data, np.uint8, end - _BLOCK_HEAD.size, _BLOCK_HEAD.size)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    rest = np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1).astype(np.uint32)
    places = np.frombuffer(data, "<u2", n_out, end)
    rest[places] = np.frombuffer(data, "<u4", n_out, end + 2 * n_out)
    return rest + np.uint32(low)


class Writer:
    """Ids of many documents into one file; holds one block and the document table."""

    def __init__(self, sink, percentile: float = PERCENTILE):
        self.sink, self.percentile = sink, percentile
        self.rest, self.held = [], 0
        self.doc_ids, self.counts, self.starts = [], [], []
        self.at = sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.rest.append(ids.astype(np.uint32, copy=False))
        self.held += len(ids)
        if self.held >= BLOCK:
            self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.rest)
        end = len(ids) - len(ids) % BLOCK if least == BLOCK else len(ids)
        for i in range(0, end, BLOCK):
            self.starts.append(self.at)
            self.at += self.sink.write(pack_block(ids[i : i + BLOCK], self.percentile))
        self.rest, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        if self.held:
            self._flush(1)
        known = np.array([i is not None for i in self.doc_ids], np.uint8)
        for part in (
            np.array([i or 0 for i in self.doc_ids], "<i8"),
            known,
            np.array(self.counts, "<u8"),
            np.array([*self.starts, self.at], "<u8"),
        ):
            self.sink.write(part.tobytes())
        ids = sum(self.counts)
        self.sink.write(_TRAILER.pack(len(self.doc_ids), len(self.starts), ids, self.at, MAGIC))


class Reader:
    """Documents and spans of one file; reads the tables at once and blocks as needed."""

    def __init__(self, source, size: int):
        self.source = source
        docs, blocks, self.n_ids, tables, magic = _TRAILER.unpack(source.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token-id blocks")
        data = source.read_at(size - _TRAILER.size - tables, tables)
        ids, known = np.frombuffer(data, "<i8", docs), np.frombuffer(data, np.uint8, docs, 8 * docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.counts = np.frombuffer(data, "<u8", docs, 9 * docs).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", blocks + 1, 17 * docs).astype(np.int64)

    def blocks(self, first: int, last: int, together: int = 256) -> Iterator[np.ndarray]:
        """Blocks first..last-1, some read at once."""
        for i in range(first, last, together):
            j = min(last, i + together)
            base = int(self.starts[i])
            data = self.source.read_at(int(self.starts[j]) - base, base)
            for k in range(i, j):
                yield unpack_block(data[int(self.starts[k]) - base : int(self.starts[k + 1]) - base])

    def span(self, start: int, n: int) -> np.ndarray:
        """Ids start..start+n-1 of the file."""
        if n <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-(start + n) // BLOCK)
        ids = np.concatenate(list(self.blocks(first, last)))
        return ids[start - first * BLOCK : start - first * BLOCK + n]

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, first place, pieces of its ids) in file order; the pieces of each must be used up in turn."""
        blocks, held, start = self.blocks(0, len(self.starts) - 1), np.zeros(0, np.uint32), 0
        for doc_id, n in zip(self.doc_ids, self.counts.tolist(), strict=True):

            def pieces(left: int = n) -> Iterator[np.ndarray]:
                nonlocal held
                while left:
                    if not len(held):
                        held = next(blocks)
                    now, held = held[:left], held[left:]
                    left -= len(now)
                    yield now

            yield doc_id, start, pieces()
            start += n


class _Known(dict[str, bytes]):
    """Chunk -> its ids, encoded when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.encode = tokenizer.encode_batch_fast

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode([chunk], add_special_tokens=False)[0].ids
        found = self[chunk] = array("I", ids).tobytes()  # four bytes each, in the order of the machine
        return found


class CachedEncoder:
    """Exactly the ids of `tokenizer.encode(text, add_special_tokens=False)`, with chunks of a text encoded once.

    The byte-level pre-tokenizer never joins what stands on both sides of these places, so a text may be cut there:
    before a blank or line feed that follows no white space, after a single line feed, between a Latin letter and an
    ASCII character that is none, and after ASCII signs (but for an apostrophe) before a letter. Texts with other white
    space, or with a special token written out, are encoded whole.
    """

    # Letters in every Unicode version, and ASCII signs and digits.
    LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
    CHUNK = re.compile(
        rf" ?[{LETTERS}]+(?=[{SIGNS}'0-9 \n]|$)|\n(?=[^ \n])| ?[{SIGNS}]+(?=[A-Za-z \n]|$)|[ \n]*[^ \n]+|[ \n]+"
    )
    ODD_SPACE = "".join(c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n")

    def __init__(self, path: str, max_chunks: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_chunks = max_chunks
        self.known = _Known(self.tokenizer)

    def _ids(self, text: str) -> np.ndarray:
        if any(c in text for c in self.ODD_SPACE) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(self.known) >= self.max_chunks:
            self.known.clear()
        # The chunks of one text at a time, so that they are looked up while the processor's caches still hold them.
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.CHUNK.findall(text))), np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._ids(text) for text in texts]


@lru_cache(maxsize=2)
def _encoder(path: str) -> CachedEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return CachedEncoder(path)


MANIFEST = "part long, file string, docs long, ids long"
MANIFEST_ARROW = pa.schema([("part", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
DOCS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    percentile: float = PERCENTILE,
) -> DataFrame:
    """Write every text's ids and `end_id`, in ascending id order over the files; returns the stored manifest with the
    place of each file's first id in the whole sequence (`start`)."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder, writer, sink = TaskContext.get(), _encoder(tokenizer), None, None
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        for batch in batches:
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                if writer is None:
                    store, path = open_store(name)
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    sink = store.open_output_stream(path, compression=None)
                    writer = Writer(sink, percentile)
                ids = encoder.encode(some.column("text").to_pylist())
                for doc_id, found in zip(some.column("doc_id").to_pylist(), ids, strict=True):
                    writer.add(doc_id, np.append(found, np.uint32(end_id)))
        rows = []
        if writer is not None:
            writer.close()
            sink.close()
            rows = [(task.partitionId(), name, len(writer.counts), sum(writer.counts))]
        yield _table(rows, MANIFEST_ARROW)

    dealt = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for entry in batch.to_pylist():
            store, path = open_store(entry["file"])
            with store.open_input_file(path) as source:
                rows = []
                for doc_id, start, pieces in Reader(source, source.size()).documents():
                    n = crc = 0
                    for ids in pieces:
                        n, crc = n + len(ids), zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, entry["start"] + start, n, crc))
                    if len(rows) == 10_000:
                        yield _table(rows, DOCS_ARROW)
                        rows = []
                yield _table(rows, DOCS_ARROW)


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    files = manifest.agg(F.count(F.lit(1))).first()[0]
    # A task per file: as the manifest is small, Spark would read all files in one.
    return manifest.select("part", "file", "start").repartitionByRange(max(1, files), "part").mapInArrow(_read, DOCS)
