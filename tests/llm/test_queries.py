"""Every query with a twin against it, the others against a plain computation, on given tables and on odd rows."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import connect, differences
from peernet.llm.common import scratch
from peernet.llm.fingerprints import Prefixes, common_extension, fingerprint_documents
from peernet.llm.licenses import oracle as license_oracle
from peernet.llm.licenses import scan_licenses
from peernet.llm.queries import ORACLES, QUERIES
from peernet.llm.token_files import BLOCK, CachedEncoder, Reader, Writer, read_documents, write_token_files
from peernet.llm.topk import best_of_tile, exact_top_k, fixed_point
from peernet.llm.warc import coalesced, read_records, write_archives
from tests.util import plan_of

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# WARC


def test_archives_hold_every_payload(spark):
    pages = [
        (5, "u5", "same"), (2, "u2", "same"), (9, None, "same"), (7, "a\r\nb", ""), (3, "u3", None), (4, "u4", "x" * 300_000),
        (6, "u6", "ünï\r\n\r\n"), (2, "u2", "same"), (None, "n", "same"), (None, "n", "only here"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS id")
    index = write_archives(frame, scratch(spark, "test"))
    assert index.where("record_type = 'revisit'").count() == 4
    found = rows(read_records(index, max_gap=10).select("id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"))
    smallest = {}
    for page, _, html in pages:
        if page is not None:
            smallest[html or ""] = min(page, smallest.get(html or "", page))
    expected = []
    for page, _, html in pages:
        data = (html or "").encode()
        first = smallest.get(html or "")
        again = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, "revisit" if again else "response", first if again else None, len(data), digest,
                         None if again else bytearray(data)))
    assert found == sorted(expected, key=repr)
    some = read_records(index.where(F.col("id").isin(4, 6)))
    assert sorted(r.id for r in some.collect()) == [4, 6]


def test_small_payloads_and_an_empty_table(spark):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    index = write_archives(frame, scratch(spark, "test"), min_bytes=3)
    assert [r.id for r in index.where("record_type = 'revisit'").collect()] == [4]
    none = write_archives(frame.where("page_id = 9"), scratch(spark, "test"))
    assert none.collect() == [] and read_records(none).collect() == []


def test_archives_are_gzip_members_of_warc_records(spark):
    folder = scratch(spark, "test")
    index = write_archives(spark.createDataFrame([(1, "http://a/", "hello")], "page_id long, url string, html string"), folder)
    file = re.sub(r"^file:", "", index.first().file)
    data = open(file, "rb").read()
    text = b""
    while data:
        part = zlib.decompressobj(31)
        text, data = text + part.decompress(data), part.unused_data
    assert text.count(b"WARC/1.1\r\n") == 2 and text.endswith(b"hello\r\n\r\n")


def test_ranges_share_reads():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 100, 5), ("b", 0, 5)]
    assert [(f, s, e) for f, s, e, _ in coalesced(ranges, 20, 1000)] == [("a", 0, 15), ("a", 100, 105), ("b", 0, 5)]
    assert len(list(coalesced(ranges, 1000, 12))) == 4


# Exact search


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = random.Random(1)
    vectors = [(i, [float(rng.randrange(-3, 4)) for _ in range(3)]) for i in range(300)]
    vectors += [(300 + i, [1.0, 1.0, 1.0]) for i in range(200)] + [(600, None), (700, [1.0, None, 2.0]), (701, [1.0, float("nan"), 2.0])]
    vectors += [(702, [float("inf"), 1.0, 1.0]), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (900, []), (901, []), (None, [1.0, 1.0, 1.0])]
    vectors += [(1000, [1e12, 1.0, 1.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").select(
        "vec_id", fixed_point(F.col("embedding")).alias("v"), F.lit(1).alias("part")
    )
    found = exact_top_k(frame, frame.where("vec_id % 100 = 0"), "vec_id", "v", 10, query_rows=2, least_shards=1000, fan_in=2)
    usable = {i: [int(np.floor(1024 * x)) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = []
    for q in usable:
        if q % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(usable[q], v, strict=True)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])]
            expected += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:10], 1)]
    assert rows(found) == sorted(expected, key=repr)


def test_tile_of_large_numbers():
    ids = np.array([1, 2, 3, 4])
    shard = np.array([[1 << 40], [1 << 40], [3 << 60], [-5]], dtype=object).astype(np.int64, casting="unsafe")
    out = best_of_tile(np.array([9]), np.array([[1 << 22]]), ids, shard, 2)
    assert out == [[(-((1 << 63) - 1), 3), (-(1 << 62), 1)]]


# Licences


def test_licenses_on_odd_texts(spark, tmp_path):
    words = "gnu general public license apache cc by mit GNU License, version 3 2 0 nc 4 lesser released under the — \x00 é".split(" ")
    rng = random.Random(4)
    texts = [" ".join(rng.choices(words, k=rng.randrange(30))) for _ in range(400)]
    texts += [None, "", "...", "MIT License", "the mit license the mit license", "Released under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit("x"))
    docs.select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    result = scan_licenses(docs)
    assert differences(result.drop("places"), con, license_oracle()) == []
    last = result.where(f"doc_id = {len(texts) - 1}").first()
    assert (last.n_base, last.first_word, last.labels, last.score) == (1, 3, "mit", 1.0)
    assert scan_licenses(docs.where("doc_id < 0")).collect() == []
    assert not any(x in plan_of(result) for x in ("Python", "Pandas", "Arrow", "Exchange"))


# Token files


def test_token_files_hold_the_library_s_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    odd = [(-3, None), (-2, ""), (-2, ""), (1 << 40, "<|endoftext|> don't \t  stop\n\n now"), (None, "x"), (-1, "a" * 50_000)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).repartition(7)
    found = read_documents(write_token_files(docs, scratch(spark, "test"), BPE)).collect()
    tokenizer = Tokenizer.from_file(BPE)
    expected, start = [], 0
    for doc, text in sorted(map(tuple, docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    empty = write_token_files(docs.where("doc_id = 12345678"), scratch(spark, "test"), BPE)
    assert read_documents(empty).collect() == []


def test_rows_of_one_id_stand_in_one_order(spark):
    """Over several files: by the hash of the text."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)], "doc_id long, text string").repartition(5)
    tokenizer = Tokenizer.from_file(BPE)
    expected = []
    for r in docs.orderBy(F.xxhash64("text")).collect():
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        expected.append(zlib.crc32(ids.tobytes()))
    found = read_documents(write_token_files(docs, scratch(spark, "test"), BPE)).orderBy("start").collect()
    assert [r.ids_crc32 for r in found] == expected
    texts = [r.text for r in docs.orderBy(F.xxhash64("text")).collect()]
    edited = {hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t, n in pairwise([*texts, texts[0]])}
    assert {r.edited_sha256 for r in fingerprint_documents(docs).collect()} == edited


def test_cut_texts_encode_like_whole_ones():
    rng = random.Random(2)
    parts = ["a", "B", " ", " ", "\n", "'s", "'", "é", "1", "  ", "\t", "\xa0", "\x1c", ".", "!", "<|endoftext|>", "😀", "the", "日本", "\u0085"]
    encoder, tokenizer = CachedEncoder(BPE, max_chunks=100), Tokenizer.from_file(BPE)
    texts = ["".join(rng.choices(parts[: rng.choice([4, 8, 9, 10, 15, 20])], k=rng.randrange(30))) for _ in range(3000)]
    for i in range(0, 3000, 50):
        for text, ids in zip(texts[i : i + 50], encoder.encode(texts[i : i + 50]), strict=True):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_an_encoder_holds_the_chunks_of_one_text_beyond_its_bound():
    encoder, tokenizer = CachedEncoder(BPE, max_chunks=10), Tokenizer.from_file(BPE)
    texts = [f"alpha{i} beta{i} gamma{i}" for i in range(300)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 10 + 6


@pytest.mark.parametrize("percentile", [0, 60, 95, 100])
def test_blocks_round_trip_and_spans(percentile):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32) for high in (1, 2, 300, 50_257, 1 << 32) for n in (0, 1, 5, 3000, 9000)]
    sink = pa.BufferOutputStream()
    writer = Writer(sink, percentile)
    for i, ids in enumerate(docs):
        writer.add(None if i == 3 else i, ids)
    writer.close()
    data = sink.getvalue()
    reader = Reader(pa.BufferReader(data), data.size)
    for (doc, _, pieces), (i, ids) in zip(reader.documents(), enumerate(docs), strict=True):
        assert doc == (None if i == 3 else i)
        assert [x for p in pieces for x in p.tolist()] == ids.tolist()
    whole = np.concatenate(docs)
    for start, n in [(0, 0), (0, 10), (BLOCK - 1, 2), (5000, 20_000), (len(whole) - 1, 1)]:
        assert reader.span(start, n).tolist() == whole[start : start + n].tolist()


# Fingerprints


def test_fingerprints_of_neighbours(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(80)
    odd = [(-4, None), (-3, "x"), (-2, "é😀" * 40), (-2, "é😀" * 40), (1 << 40, "a" * 9000)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).repartition(6)
    table = sorted(((d, t or "") for d, t in map(tuple, docs.collect())), key=lambda r: r)
    # Many ranges, so that neighbours often lie in two.
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    found = fingerprint_documents(docs.withColumn("head", F.lit(1))).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == len(table)
    by_key: dict = {}
    for r in found:
        by_key.setdefault((r.doc_id, r.edited_sha256), r)
    prints: dict[str, str] = {}
    for i, (doc, text) in enumerate(table):
        after = table[(i + 1) % len(table)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = by_key[doc, hashlib.sha256(edited.encode()).hexdigest()]
        assert r.n_chars == len(text)
        assert r.common_next == len(os.path.commonprefix([text, after]))
        assert r.common_edited == len(os.path.commonprefix([text, edited]))
        for t, p in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(t, p) == p
        assert text != edited or r.near_edited == 1.0
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(set(prints.values())) == len(prints)
    alone = fingerprint_documents(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and alone.near_next == 1.0
    assert fingerprint_documents(docs.where("doc_id = 7777777")).collect() == []


def test_extensions_by_binary_search():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ("".join(rng.choices("ab😀", k=rng.randrange(60))) for _ in "ab")
        b = a[: rng.randrange(len(a) + 1)] + b
        i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        assert common_extension(Prefixes(a), i, Prefixes(b), j) == len(os.path.commonprefix([a[i:], b[j:]]))
