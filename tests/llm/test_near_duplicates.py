"""MinHash near-duplicates against exact weighted Jaccard over all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from peernet.llm.near_duplicates import (
    dart_signatures,
    drop_near_duplicates,
    near_duplicate_classes,
    odd_sketches,
    shingle_cells,
)

SCHEMA = "doc_id long, text string"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(text: str) -> Counter:
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes_by_force(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    found = {d: (t, shingles(t or "")) for d, t in docs}
    for a, b in combinations(sorted(found), 2):
        (x, sx), (y, sy) = found[a], found[b]
        equal = x is not None and x == y
        if equal or (sx and sy and jaccard(sx, sy) >= 0.8):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d in root}


def corpus(seed: int, n: int = 60) -> list[tuple[int, str | None]]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 8, 40, 150]))) for _ in range(n)]
    docs: list[str | None] = list(texts)
    for _ in range(n):
        base = rng.choice(texts).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        docs.append(rng.choice([" ", ", ", "\n"]).join(base).title())
    docs += [None, None, "", "", "...", "?!", "...", "one", "One!", "Один два"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_are_those_of_all_pairs(spark, seed):
    docs = corpus(seed)
    result = near_duplicate_classes(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in result} == classes_by_force(docs)
    assert len(result) == len(docs)


def test_cells_are_the_weighted_shingles():
    texts = ["a b c d e f a b c d e f a b c d e", "", "x y", "a b c d e"]
    cells, owner = shingle_cells([t.encode() for t in texts])
    assert [int((owner == i).sum()) for i in range(4)] == [13, 0, 1, 1]
    assert len(set(cells[owner == 0].tolist())) == 13
    assert cells[owner == 3][0] in cells[owner == 0]
    a, b = shingles(texts[0]), shingles(texts[3])
    assert len(set(cells[owner == 0].tolist()) & set(cells[owner == 3].tolist())) == sum((a & b).values())


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    shared, own_a, own_b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 200, 200))
    cells = np.concatenate([shared, own_a, shared, own_b])
    owner = np.repeat([0, 1], [800, 800])
    k = 4000
    with np.errstate(over="ignore"):
        signatures = dart_signatures(cells, owner, 2, k)
    assert abs((signatures[0] == signatures[1]).mean() - 0.6) < 0.04


def test_a_document_is_signed_alike_alone_and_in_company():
    rng = np.random.default_rng(6)
    cells = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    owner = np.repeat([0, 1, 2], [1, 40, 4959])
    with np.errstate(over="ignore"):
        together = dart_signatures(cells, owner, 3, 125)
        for i in range(3):
            some = cells[owner == i]
            alone = dart_signatures(some, np.zeros(len(some), np.int64), 1, 125)
            assert (alone[0] == together[i]).all()


def test_one_of_each_class_stays_with_all_its_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [
        (3, text, "x", 1), (1, text.upper(), "y", 2), (2, "other words in here now", "z", 3), (2, "other words in here now", "z", 3),
        (None, text, "n", 4), (4, None, "q", 5), (5, None, "q", 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, _place int")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([rows[1], rows[2], *rows[4:]], key=repr)


def test_rows_that_share_an_id_tie_their_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (7, a), (7, b), (9, b)], SCHEMA)
    assert {(r.doc_id, r.class_id) for r in near_duplicate_classes(docs).collect()} == {(1, 1), (7, 1), (9, 1)}


@pytest.mark.parametrize("seed", [3, 4])
def test_classes_of_shared_ids_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = [t for _, t in corpus(seed)]
    rows = [(rng.randrange(60) if rng.random() < 0.5 else 100 + i, t) for i, t in enumerate(texts)]
    rows += rng.choices(rows, k=20)
    alike = classes_by_force(list(enumerate(t for _, t in rows)))
    root = {d: d for d, _ in rows}
    # Rows of one class, or of one id, are one class of ids; repeat until nothing moves.
    while True:
        before = dict(root)
        of_class: dict[int, int] = {}
        for i, (d, _) in enumerate(rows):
            of_class[alike[i]] = min(of_class.get(alike[i], root[d]), root[d])
        for i, (d, _) in enumerate(rows):
            root[d] = min(root[d], of_class[alike[i]])
        if root == before:
            break
    result = near_duplicate_classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in result} == root and len(result) == len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicate_classes(docs).collect() == [] and drop_near_duplicates(docs).collect() == []


def test_a_large_group_costs_a_pair_per_node(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(300):
        text = list(base)
        text[rng.randrange(200)] = f"x{rng.random()}"
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert {r.class_id for r in near_duplicate_classes(docs).collect()} == {0}


def test_sketches_differ_in_no_more_bits_than_documents_in_cells():
    rng = np.random.default_rng(7)
    shared, own_a, own_b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 20, 31))
    cells, owner = np.concatenate([shared, own_a, shared, own_b]), np.repeat([0, 1], [320, 331])
    with np.errstate(over="ignore"):
        a, b = odd_sketches(cells, owner, 2)
    differ = sum(int(x).bit_count() for x in a ^ b)
    assert 40 <= differ <= 51 and (51 - differ) % 2 == 0
