"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of labelled rows in the tasks that read them (dense counts per language and bucket, summed by one
aggregation) and keeps a matrix of log probabilities, languages x buckets, which is the model: its size depends on the
number of languages only, and it is broadcast. Scoring cuts whole texts into batches of code points; a batch's n-grams are
hashed at once, and each text adds up the matrix entries of its n-grams.

Labelled rows are thinned per language to about `max_rows_per_language` by a hash of the id, for training only.

Defined results: `und` with score 0 for a text that is NULL or has no letter, and for every text where no row is labelled.
Rows that repeat an id are scored apart. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNDETERMINED = "und"
BITS, ORDERS = 16, 3
PIECE = 1 << 18  # code points handled at once; n-grams run over the cuts


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = ord(chr(c).lower()[0])
    return out


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers (1..2^BITS-1) of a text's n-grams of 1..ORDERS characters, in arrays of bounded size.

    All that is no letter counts as one boundary mark; n-grams start at a letter or at a boundary before one.
    """
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[max(0, at - 1) : at + PIECE + ORDERS - 1].encode("utf-32-le"), "<u4")
        letters = _letters()[codes]
        # One mark before the text, and enough after it for the last n-gram.
        c = np.zeros(len(letters) + ORDERS + (at == 0), np.uint64)
        c[at == 0 :][: len(letters)] = letters
        starts = min(PIECE + (at == 0), len(c) - ORDERS)
        skip = 0 if at == 0 else 1
        first, second = c[skip : skip + starts] > 0, c[skip + 1 : skip + 1 + starts] > 0
        code = np.zeros(starts, np.uint64)
        for n in range(ORDERS):
            with np.errstate(over="ignore"):
                code = (code + c[skip + n : skip + n + starts] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            bucket = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)
            keep = first | second if n else first
            yield np.maximum(bucket[keep], np.uint64(1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray  # log share of each language
    weights: np.ndarray  # languages x 2^BITS log probabilities

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages:
            return UNDETERMINED, 0.0
        totals, seen = self.prior.copy(), 0
        for buckets in ngram_buckets(text):
            seen += len(buckets)
            for i, row in enumerate(self.weights):
                totals[i] += row[buckets].sum()
        if not seen:
            return UNDETERMINED, 0.0
        best = int(np.argmax(totals))
        return self.languages[best], round(float(1 / np.exp(totals - totals[best]).sum()), 6)


COUNTS_ARROW = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            own = counts.setdefault(lang, np.zeros(1 << BITS, np.int64))
            for buckets in ngram_buckets(text.as_py()):
                own += np.bincount(buckets, minlength=1 << BITS)
    for lang, own in counts.items():
        used = np.flatnonzero(own)
        columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(own[used], pa.int64())]
        yield pa.record_batch(columns, schema=COUNTS_ARROW)


def held_out(id_column: str) -> Column:
    """Rows kept out of training: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    max_rows_per_language: int = 5000,
    smoothing: float = 0.5,
) -> Model:
    """The model of the rows that have a text and a language and are not held out."""
    rows = docs.where(
        F.col(text_column).isNotNull() & F.col(lang_column).isNotNull() & ~held_out(id_column)
    ).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return Model((), np.zeros(0), np.zeros((0, 1 << BITS)))
    languages = tuple(sorted(shares))
    chance = F.coalesce(
        *[F.when(F.col("lang") == lang, F.lit(max_rows_per_language / shares[lang])) for lang in languages]
    )
    point = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(1 << 20)
    counted = rows.where(point < chance).select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
    # At most languages x buckets sums, whatever the corpus.
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    weights = np.full((len(languages), 1 << BITS), smoothing)
    weights[sums["lang"].map(languages.index).to_numpy(np.int64), sums["bucket"].to_numpy(np.int64)] += sums["n"].to_numpy()
    total = sum(shares.values())
    prior = np.log(np.array([shares[lang] / total for lang in languages]))
    return Model(languages, prior, np.log(weights / weights.sum(axis=1, keepdims=True)))


def predictor(spark: SparkSession, model: Model):
    """Column function: text -> struct(lang string, score double)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            yield pd.DataFrame([own.predict(t) for t in texts], columns=["lang", "score"])

    return predict


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", **settings
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row, by a model of the rows that are not held out."""
    model = train(docs, id_column, text_column, lang_column, **settings)
    predict = predictor(docs.sparkSession, model)
    return docs.select(
        F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), predict(F.col(text_column)).alias("p")
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, least_score: float = 0.5, **columns) -> DataFrame:
    """The rows whose language is found with a score of at least `least_score`, with their own columns."""
    text = columns.get("text_column", "text")
    model = train(docs, **columns)
    if not model.languages:  # nothing to tell languages by: only texts without letters are rejected
        return docs.where(F.col(text).rlike(r"\p{L}"))
    found = predictor(docs.sparkSession, model)(F.col(text))
    return docs.where((found["lang"] != UNDETERMINED) & (found["score"] >= least_score))
