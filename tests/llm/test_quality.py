"""The rule cascade against a plain computation, in every order of its rules."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from peernet.llm.quality import JUDGED, RULES, Rule, Text, judge_quality, repeated_words, rule_order
from peernet.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def base_by_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeat = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    signs = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), signs, dup, len(repeat), len(words) < 10 or 100 * len(repeat) > 20 * len(words)


def texts(seed: int):
    rng = random.Random(seed)
    some = [None, "", " \n\t", "one", "a b c d e a b c d e", "x\n" * 30, "é ü   wörd\x1cs\x85 " * 4, "- a\n- b\n- c\n" * 3,
            "word " * 5000, "\n".join(["Same line here."] * 3 + [f"other {i}" for i in range(9)]), "ALL CAPS!! HERE!! " * 9,
            "so on ...\nand on…\nmore " + " ".join(map(str, range(40))), "日本語 の 文章 です。" * 3]
    for _ in range(120):
        words = [rng.choice(["ab", "cd", "Ef", "g,", "###", "|", "…", "x" * 25, "lange", "wörter"]) + str(rng.randrange(40)) for _ in range(rng.randrange(300))]
        some.append("".join(w + rng.choice(" \n\t\x0b") for w in words))
    return some


def test_base_columns_and_verdict(spark):
    rows = [(i // 2, t) for i, t in enumerate(texts(3))] + [(None, "null id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS kept", "2 AS rule")
    found = sorted((tuple(r)[:8] for r in judge_quality(frame).collect()), key=repr)
    expected = []
    for doc_id, text in rows:
        *figures, failed = base_by_force(text)
        t = Text(None if text is None else text.encode())
        expected.append((doc_id, *figures, failed, not failed and not any(r.rejects(t) for r in RULES)))
    assert found == sorted(expected, key=repr)


def test_order_changes_no_verdict(spark):
    frame = spark.createDataFrame(list(enumerate(texts(4))), "doc_id long, text string")
    ways = [judge_quality(frame, rules=rules, sample_rows=n) for rules, n in ((RULES, 32), (RULES[::-1], 1), (RULES[3:] + RULES[:3], 0))]
    results = [sorted((r.doc_id, r.kept, r.rejected_by is None) for r in w.collect()) for w in ways]
    assert results[0] == results[1] == results[2]


def test_cheap_rules_that_reject_come_first(spark):
    slow = Rule("slow", lambda t: sum(i * i for i in range(20_000)) > 0, "")
    never = Rule("never", lambda t: False, "")
    fast = Rule("fast", lambda t: t.n_words > 0, "")
    frame = spark.createDataFrame([(i, f"{i} " + " ".join(f"w{j}" for j in range(30))) for i in range(50)], "doc_id long, text string")
    assert rule_order(frame, "text", (never, slow, fast), 1000) == [2, 1, 0]
    judged = judge_quality(frame, rules=(never, slow, fast)).collect()
    assert {(r.rejected_by, r.n_tests, r.kept) for r in judged} == {("fast", 1, False)}


def test_windows_of_many_kinds():
    rng = np.random.default_rng(5)
    for kinds, n in ((3, 200), (9_000, 20_000), (60_000, 60_000)):
        ids = rng.integers(0, kinds, n)
        ids[100:140] = ids[20:60]
        counts = Counter(tuple(ids[i : i + 5]) for i in range(n - 4))
        places = {i + j for i in range(n - 4) if counts[tuple(ids[i : i + 5])] > 1 for j in range(5)}
        assert repeated_words(ids.astype(np.int64), kinds) == len(places)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert judge_quality(none).collect() == [] and judge_quality(none).schema.simpleString() == spark.createDataFrame([], JUDGED).schema.simpleString()


def test_labelled_documents(spark, sf_dir):
    """Documents marked good stay and bad ones go."""
    judged = QUERIES["op11_quality"](spark, sf_dir).where("not base_failed").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    counts = Counter((r.quality, r.kept) for r in judged.collect())
    assert counts[1, True] > 0.97 * (counts[1, True] + counts[1, False])
    assert counts[0, False] >= 0.9 * (counts[0, True] + counts[0, False])
