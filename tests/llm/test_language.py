"""Language identification: against plain naive Bayes, and by held-out accuracy."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from math import exp, log

import numpy as np
import pytest

import peernet.llm.language as language
from peernet.llm.language import UNDETERMINED, identify, keep_identified, ngram_buckets, train

SCHEMA = "doc_id long, text string, lang string"


def ngrams(text: str) -> list[tuple]:
    marks = [0, *(ord(c.lower()[0]) if c.isalpha() else 0 for c in text), 0, 0, 0]
    out = []
    for i in range(len(text) + 1):
        for n in (1, 2, 3):
            if marks[i] or (n > 1 and marks[i + 1]):
                out.append(tuple(marks[i : i + n]))
    return out


def buckets(text: str) -> list[int]:
    return sorted(int(b) for part in ngram_buckets(text) for b in part)


@pytest.mark.parametrize("piece", [5, 1 << 18])
def test_every_ngram_has_a_bucket_wherever_the_text_is_cut(monkeypatch, piece):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB é1 .ñ😀") for _ in range(rng.randrange(40))) for _ in range(200)]
    whole = [buckets(t) for t in texts]
    monkeypatch.setattr(language, "PIECE", piece)
    for text, expected in zip(texts, whole, strict=True):
        assert buckets(text) == expected
        assert len(expected) == len(ngrams(text))


def held(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_model_and_scores_are_those_of_plain_naive_bayes(spark):
    rng = random.Random(2)
    words = {"aa": "foo bar baz qux".split(), "bb": "lorem ipsum bar dolor".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=6)), lang) for i in range(60) for lang in [rng.choice(["aa", "bb"])]]
    rows += [(60, None, "aa"), (61, "42 !", "bb"), (62, "", None), (63, "bar bar", None)]
    seen: dict[str, Counter] = {"aa": Counter(), "bb": Counter()}
    prior: Counter = Counter()
    for doc, text, lang in rows:
        if text is not None and lang is not None and not held(doc):
            seen[lang].update(buckets(text))
            prior[lang] += 1
    result = {r.doc_id: r for r in identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    for doc, text, _ in rows:
        r = result[doc]
        assert r.held_out == held(doc)
        if text is None or not buckets(text):
            assert (r.lang_pred, r.score) == (UNDETERMINED, 0.0)
            continue
        total = {
            k: log(prior[k] / prior.total())
            + sum(log((seen[k][b] + 0.5) / (seen[k].total() + 0.5 * (1 << language.BITS))) for b in buckets(text))
            for k in seen
        }
        best = max(total, key=total.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(exp(v - total[best]) for v in total.values()), abs=2e-6)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = identify(docs).where("held_out").join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_held_out_rows_source_and_id_teach_nothing(spark):
    rows = [(i, "foo bar", "aa") for i in range(30)]
    other = [(d, t, "zz" if held(d) else lang) for d, t, lang in rows]
    a, b = (train(spark.createDataFrame(r, SCHEMA)) for r in (rows, other))
    assert a.languages == b.languages == ("aa",) and (a.weights == b.weights).all()


def test_stage_keeps_clean_rows_and_their_columns(spark):
    rows = [(1, "foo bar", "aa", "x"), (1, "foo bar", "aa", "x"), (2, None, "aa", "y"), (3, "...", "aa", "z"), (None, "bar", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    kept = keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[1], rows[4]], key=repr)


def test_nothing_labelled_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "foo", None), (2, "1", None)], SCHEMA)
    assert {r.lang_pred for r in identify(docs).collect()} == {UNDETERMINED}
    assert [r.doc_id for r in keep_identified(docs).collect()] == [1]
    assert identify(docs.where("doc_id = 9")).collect() == []
