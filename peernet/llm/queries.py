"""The operators over the whole tables they are for, and their DuckDB twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peernet.llm.common import scratch, table
from peernet.llm.clusters import cluster_vectors
from peernet.llm.clusters import oracle as cluster_oracle
from peernet.llm.fingerprints import fingerprint_documents
from peernet.llm.language import identify
from peernet.llm.licenses import oracle as license_oracle
from peernet.llm.licenses import scan_licenses
from peernet.llm.line_dedup import drop_repeated_lines
from peernet.llm.near_duplicates import near_duplicate_classes
from peernet.llm.packing import measured, pack_documents
from peernet.llm.prefix_trie import oracle as trie_oracle
from peernet.llm.prefix_trie import prefix_trie
from peernet.llm.quality import judge_quality
from peernet.llm.quality import oracle as quality_oracle
from peernet.llm.subwords import sampled_ids
from peernet.llm.token_files import read_documents, write_token_files
from peernet.llm.topk import exact_top_k, fixed_point
from peernet.llm.warc import RFC_DIGITS, read_records, write_archives


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read_records(index, with_payload=False).select(
        F.col("id").alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(measured(table(spark, sf_dir, "documents")), capacity=2048)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", fixed_point(F.col("embedding")).alias("v"))
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), "vec_id", "v", k=10)


def op5_subwords(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Number and CRC-32 of every text's sampled ids, and whether they decode to the text."""
    import public_tokenizers

    path = model or public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = docs.select("doc_id", sampled_ids(F.col("doc_id"), F.col("text"), path).alias("found"))
    return found.select("doc_id", F.col("found.ids").alias("ids"), F.col("found.lossless").alias("lossless")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), "lossless"
    )


def op6_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """`tokenizer` is a path that every executor can open; the installed public byte-level BPE by default."""
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return read_documents(write_token_files(table(spark, sf_dir, "documents"), scratch(spark, "ids"), path))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each text: its number of lines and its SHA-256."""
    left = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.size(F.split("text", "\n")).alias("n_lines"), F.sha2("text", 256).alias("text_sha256"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("places")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("rejected_by", "n_tests")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", fixed_point(F.col("embedding"), 64).alias("v"))
    return cluster_vectors(vectors, "vec_id", "v", k=16, rounds=3, dimension=64)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language": op2_language,
    "op3_packing": op3_packing,
    "op4_topk": op4_topk,
    "op5_subwords": op5_subwords,
    "op6_token_files": op6_token_files,
    "op7_line_dedup": op7_line_dedup,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_fingerprints": op9_fingerprints,
    "op10_licenses": op10_licenses,
    "op11_quality": op11_quality,
    "op12_clusters": op12_clusters,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
     d AS (SELECT page_id, url, strlen(payload) AS payload_bytes,
                  array_to_string(list_transform(range(32), lambda i: substr('{RFC_DIGITS}', 1 + ((
                    ('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '')
                    AS payload_digest,
                  min(page_id) OVER (PARTITION BY payload) AS kept
           FROM p)
SELECT page_id, url, payload_bytes, payload_digest, CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM d""",
    "op4_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op10_licenses": license_oracle(),
    "op11_quality": quality_oracle(),
    "op12_clusters": cluster_oracle(),
    "op13_prefix_trie": trie_oracle(),
}
