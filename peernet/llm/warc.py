"""WARC archives: written with an index of every record, read by coalesced byte ranges.

Writing: payload digests alone are grouped to find, per distinct payload, the record that keeps it; only then do the
payloads move, once, to the tasks that write. A task writes one archive file of gzip members, one member per record,
and returns an index row per record. The index is a Parquet table written by Spark's committer, so it lists the file
of exactly one attempt per task: a lost or repeated attempt leaves an unlisted file, never a wrong or double record.

Reading: the selected index rows are dealt by (file, offset) ranges and sorted; a task joins neighbouring ranges into
one read as long as gap and size allow.

Defined results: a NULL payload is an empty one. Rows that repeat an id with an equal payload are separate records of
the same type. A NULL id takes part and is never the smaller one; a group of NULL ids only has responses alone. A NULL
URL leaves the header out; line breaks in a URL are percent-encoded. Other columns are ignored. An empty table gives
an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peernet.llm.common import open_store, stage

INDEX_SCHEMA = "file string, offset long, length long, url string, digest string, record_type string, id long"
RECORD_SCHEMA = (
    "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
# The alphabets of base-32 numbers as Spark's conv() writes them and as RFC 4648 does.
CONV_DIGITS, RFC_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: every 5 hex digits are 4 base-32 digits."""
    code = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(code, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*fours)), CONV_DIGITS, RFC_DIGITS)


def _record_id(record_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {url} {digest}')}>"


def _member(fields: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    """One WARC record as one gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = (b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n")
    return b"".join([*map(squeeze.compress, parts), squeeze.flush()])


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 6,
) -> DataFrame:
    """Write a record per row under `folder`; returns the stored index (INDEX_SCHEMA).

    Of records with equal payloads of at least `min_bytes` bytes, the one with the smallest id holds the payload
    (response); the others refer to it (revisit).
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit("")).cast("binary")
    records = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": sha1_base32(F.col("payload"))})
    kept = (
        records.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & F.col("first_id").isNotNull())
        .drop("copies")
    )
    kept = stage(kept, "kept")  # as a table, it lets the join split a payload that a large part of the rows share
    revisits = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    rows = records.join(kept, ["digest", "bytes"], "left").select(
        "id",
        "url",
        "digest",
        "bytes",
        F.when(revisits, F.col("first_id")).alias("refers_to"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            index: list[tuple] = []
            for row in batch.to_pylist():
                if out is None:
                    store, path = open_store(name)
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(path, compression=None)
                    info = b"software: peernet-analytics\r\nformat: WARC File Format 1.1\r\n"
                    fields = [("WARC-Type", "warcinfo"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"),
                              ("WARC-Record-ID", _record_id(None, name.rsplit("/", 1)[1], ""))]
                    offset += out.write(_member(fields, info, level))
                revisit = row["refers_to"] is not None
                url = row["url"] if row["url"] is None else row["url"].replace("\r", "%0D").replace("\n", "%0A")
                kind = "revisit" if revisit else "response"
                fields = [
                    ("WARC-Type", kind),
                    ("WARC-Record-ID", _record_id(row["id"], url, row["digest"])),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", url),
                    ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                    ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("X-Record-Key", row["id"]),
                    ("X-Refers-To-Key", row["refers_to"]),
                    ("X-Payload-Length", row["bytes"]),
                ]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n"
                length = out.write(_member(fields, http.encode() + (b"" if revisit else row["payload"]), level))
                index.append((name, offset, length, url, row["digest"], kind, row["id"]))
                offset += length
            yield _batch(index, INDEX_ARROW)
        if out is not None:
            out.close()

    rows.mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


INDEX_ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
     ("record_type", pa.string()), ("id", pa.int64())]
)
RECORD_ARROW = pa.schema(
    [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def coalesced(ranges: Iterable[tuple[str, int, int]], max_gap: int, max_read: int) -> Iterator[tuple[str, int, int, list]]:
    """Sorted (file, offset, length) ranges as (file, start, end, members); neighbours share a read."""
    run: tuple[str, int, int, list] | None = None
    for file, offset, length in ranges:
        if run and file == run[0] and offset - run[2] <= max_gap and offset + length - run[1] <= max_read:
            run = (file, run[1], max(run[2], offset + length), [*run[3], (offset, length)])
        else:
            if run:
                yield run
            run = (file, offset, offset + length, [(offset, length)])
    if run:
        yield run


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one gzip member."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def read_records(
    index: DataFrame, max_gap: int = 1 << 16, max_read: int = 1 << 23, with_payload: bool = True, task_bytes: int = 1 << 25,
    least_tasks: int = 16,
) -> DataFrame:
    """The records that `index` lists (RECORD_SCHEMA). A response's payload is checked against its digest.

    A revisit has no payload of its own: its length and digest are those of the full payload, as its header says.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = (
            (str(f), o, n)
            for b in batches
            for f, o, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)
        )
        rows, size = [], 0
        for file, start, end, members in coalesced(ranges, max_gap, max_read):
            store, path = open_store(file)
            with store.open_input_file(path) as source:
                data = source.read_at(end - start, start)
            for offset, length in members:
                fields, block = parse_record(data[offset - start : offset - start + length])
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                payload, n_bytes = None, int(fields["X-Payload-Length"])
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    n_bytes = len(payload)
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{file} at {offset}: payload and digest differ")
                key, refers = fields.get("X-Record-Key"), fields.get("X-Refers-To-Key")
                rows.append((key and int(key), fields.get("WARC-Target-URI"), kind, refers and int(refers), n_bytes, digest,
                             payload if with_payload else None))
                size += n_bytes if with_payload else 0
                if len(rows) >= 10_000 or size >= max_read:
                    yield _batch(rows, RECORD_ARROW)
                    rows, size = [], 0
        yield _batch(rows, RECORD_ARROW)

    # Tasks by the bytes to read: the index is small, so Spark would read all archives in one.
    total = index.agg(F.sum("length")).first()[0] or 0
    places = index.select("file", "offset", "length")
    places = places.repartitionByRange(max(least_tasks, -(-total // task_bytes)), "file", "offset")
    return places.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD_SCHEMA)
