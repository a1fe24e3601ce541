"""Sampled segmentations: exact distribution, reproducible draws, lossless decoding."""

from __future__ import annotations

import random
from collections import Counter
from math import exp

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from peernet.llm.subwords import Sampler, decoded, sampled_ids

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sampler():
    return Sampler(MODEL)


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\n", "é", "▁", "😀", "the", "ing", "日本", "\x00", ".", ", ", "don't", " word."]
    return ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(n)]


def test_decoding_gives_back_every_text(sampler):
    some = [*texts(1, 2000), "x" * 5000, " " * 40, "", None]
    for text, ids in zip(some, sampler.encode(list(range(len(some))), some), strict=True):
        assert sampler.decode(ids) == (text or "")


def test_a_row_is_drawn_alike_in_any_company(sampler):
    some = texts(2, 400)
    together = sampler.encode(list(range(400)), some)
    for i in (0, 7, 399):
        alone = Sampler(MODEL).encode([i], [some[i]])[0]
        assert alone.tolist() == together[i].tolist()
    turned = sampler.encode(list(range(399, -1, -1)), some[::-1])
    assert [x.tolist() for x in turned[::-1]] == [x.tolist() for x in together]


def ways(sampler, look: str) -> list[tuple[tuple, float]]:
    """Every segmentation with its log weight."""
    if not look:
        return [((), 0.0)]
    out = []
    for n in range(1, len(look) + 1):
        piece = sampler.vocabulary.pieces.get(look[:n])
        if piece is not None:
            out += [((piece, *rest), float(sampler.weight[piece]) + w) for rest, w in ways(sampler, look[n:])]
    return out


@pytest.mark.parametrize("text", ["the", "of ing"])
def test_draws_follow_the_weights_of_all_segmentations(sampler, text):
    n = 40_000
    drawn = Counter(tuple(x.tolist()) for x in sampler.encode(list(range(n)), [text] * n))
    every = ways(sampler, "▁" + text.replace(" ", "▁"))
    total = sum(exp(w) for _, w in every)
    assert set(drawn) <= {p for p, _ in every}
    assert max(abs(drawn[p] / n - exp(w) / total) for p, w in every) < 0.012


def test_a_full_cache_changes_nothing():
    some = texts(3, 300)
    small, large = Sampler(MODEL, max_edges=50), Sampler(MODEL)
    for i in range(0, 300, 30):
        keys = list(range(i, i + 30))
        a, b = (s.encode(keys, some[i : i + 30]) for s in (small, large))
        assert [x.tolist() for x in a] == [x.tolist() for x in b]


def test_columns(spark):
    rows = [(1, "the word", "x"), (1, "the word", "x"), (None, "other", "y"), (2, None, "z"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = docs.withColumn("both", sampled_ids(F.col("doc_id"), F.col("text"), MODEL))
    out = out.withColumn("found", F.col("both.ids")).withColumn("back", decoded(F.col("found"), MODEL))
    assert out.where("both.lossless").count() == 5
    out = out.drop("both")
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert [r[:3] for r in got] == sorted(rows, key=repr)
    assert all(r[4] == (r[1] or "") for r in got)
    repeated = [r for r in got if r[0] == 1]
    assert repeated[0] == repeated[1] and len(repeated[0][3]) % 4 == 0
    assert np.frombuffer(got[-1][3], "<u4").max() < 32_000
    assert out.where("doc_id = 9").collect() == []
