r"""Quality rules as a short-circuit cascade.

Every text gets its base figures: words `[^\x20\x09-\x0D]+`, their code points, signs `[#*$%&|<>]`, lines that repeat an
earlier line, and words in repeated windows of five words. A text of few or mostly repeated words fails at once. The others
go through RULES until the first that rejects them. The order of the rules is set beforehand: on a sample, the first
`sample_rows` rows of every input partition, every rule is timed on every text, and rules are sorted by rejections per
nanosecond, so a cheap rule that rejects much comes first. Nothing beyond the sample is read for it. A text is kept if no rule
rejects it, so any order gives the same verdicts; the sample changes the cost only.

A word's number within its text stands for it, and windows are compared by exact combinations of these numbers. Texts are
taken one by one; a text's arrays are proportional to its length. There is no shuffle.

Defined results: a NULL or empty text has no words and fails. Rows that repeat an id are judged apart; a NULL id stays NULL.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import count, islice
from time import perf_counter_ns

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, MIN_WORDS = 5, 10
# What separates words, which signs count, and the bytes of letters (all beyond ASCII count as letters).
SPACE, SIGNS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_LETTER_WORD = re.compile(rb"[^ \t-\r]*?[A-Za-z\x80-\xff][^ \t-\r]*")
_ALL = bytes(range(256))


def _only(kept: bytes) -> bytes:
    """The bytes to delete so that `kept` stay."""
    return _ALL.translate(None, kept)


_BUT_UPPER, _BUT_LATIN = _only(UPPER), _only(UPPER + LOWER)
_BUT_POINTS = bytes(c for c in range(256) if 0x80 <= c < 0xC0)  # bytes that continue a code point


def repeated_words(ids: np.ndarray, kinds: int, window: int = WINDOW) -> int:
    """Places in windows of `window` numbers under `kinds` that stand twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    keys, top = ids[:n].copy(), kinds
    for j in range(1, window):
        if top * kinds >= 1 << 62:
            found, keys = np.unique(keys, return_inverse=True)
            top = len(found)
        keys, top = keys * kinds + ids[j : j + n], top * kinds
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int(np.count_nonzero(np.cumsum(edge)))


class Text:
    """Figures of one text, each computed when it is first asked for."""

    def __init__(self, data: bytes | None):
        self.data = data or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # bytes are split at the six ASCII blanks, which are those of SPACE

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data.translate(None, SPACE + _BUT_POINTS))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SIGNS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.data.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter(map(numbers.__getitem__, self.words), np.int64, self.n_words)
        return repeated_words(ids, len(numbers))

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > 20 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]
    sql: str  # the same in terms of the twin's columns


def _capitals(t: Text) -> bool:
    return 2 * len(t.data.translate(None, _BUT_UPPER)) > len(t.data.translate(None, _BUT_LATIN))


def _ends_open(line: bytes) -> bool:
    return line.rstrip().endswith((b"...", "…".encode()))


RULES = (
    Rule("signs", lambda t: 10 * t.n_symbols > 3 * t.n_words, "10 * n_symbols > 3 * n_words"),
    Rule("capitals", _capitals, "2 * n_upper > n_latin"),
    Rule("exclamations", lambda t: 2 * t.data.count(b"!") > t.n_words, "2 * n_exclaim > n_words"),
    Rule("word length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
         "NOT (2 * n_words <= word_chars AND word_chars <= 20 * n_words)"),
    Rule("letters", lambda t: 10 * sum(1 for _ in _LETTER_WORD.finditer(t.data)) < 6 * t.n_words,
         "10 * n_letter_words < 6 * n_words"),
    Rule("repeated lines", lambda t: 2 * t.n_dup_lines > len(t.lines), "2 * n_dup_lines > len(lines)"),
    Rule("bullets", lambda t: len(t.lines) > 2 and 10 * sum(x.lstrip()[:1] in (b"-", b"*", b"+") for x in t.lines) > 9 * len(t.lines),
         r"len(lines) > 2 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*+]'))) > 9 * len(lines)"),
    Rule("open lines", lambda t: 10 * sum(map(_ends_open, t.lines)) > 3 * len(t.lines),
         r"10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) > 3 * len(lines)"),
)

JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, rejected_by string, n_tests int"
)
JUDGED_ARROW = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
     ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("rejected_by", pa.string()), ("n_tests", pa.int32())]
)
COSTS_ARROW = pa.schema([("rule", pa.int32()), ("nanos", pa.int64()), ("rejected", pa.int64())])


def _texts(batch: pa.RecordBatch) -> Iterator[Text]:
    for value in batch.column("text"):
        yield Text(value.as_buffer().to_pybytes() if value.is_valid else None)


def _slices(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def rule_order(docs: DataFrame, text_column: str, rules: tuple[Rule, ...], sample_rows: int) -> list[int]:
    """Rules by falling rejections per nanosecond on a sample; one row per rule and task is read."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nanos, rejected = [0] * len(rules), [0] * len(rules)
        first = (text for batch in batches for text in _texts(batch))
        for text in islice(first, sample_rows):
            if not text.base_failed:
                for i, rule in enumerate(rules):
                    start = perf_counter_ns()
                    rejected[i] += bool(rule.rejects(text))
                    nanos[i] += perf_counter_ns() - start
        yield _slices([list(range(len(rules))), nanos, rejected], COSTS_ARROW)

    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    costs = texts.mapInArrow(measure, "rule int, nanos long, rejected long").groupBy("rule")
    found = {r["rule"]: (r["rejected"], max(r["nanos"], 1)) for r in costs.agg(F.sum("nanos").alias("nanos"), F.sum("rejected").alias("rejected")).collect()}
    return sorted(range(len(rules)), key=lambda i: (-found[i][0] / found[i][1] if i in found else 0, found.get(i, (0, 1))[1]))


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = 32,
) -> DataFrame:
    """JUDGED rows, one per row of `docs`: base figures, verdict, the rule that rejected the text, and rules it was put to.

    The last two depend on the order of the rules, the verdict does not.
    """
    order = rule_order(docs, text_column, rules, sample_rows)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = [rules[i] for i in order]
        for batch in batches:
            out: list[tuple] = []
            for doc_id, t in zip(batch.column("doc_id").to_pylist(), _texts(batch), strict=True):
                failed, by, tests = t.base_failed, None, 0
                if not failed:
                    for rule in cascade:
                        tests += 1
                        if rule.rejects(t):
                            by = rule.name
                            break
                kept = not failed and by is None
                figures = (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words)
                out.append((doc_id, *figures, failed, kept, "base" if failed else by, tests))
            if out:
                yield _slices(list(map(list, zip(*out, strict=True))), JUDGED_ARROW)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(judge, JUDGED)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in DuckDB SQL, every rule on every text."""
    count_of = lambda cls: f"length(regexp_replace(t, '{cls}', '', 'g'))"
    grams = " || ' ' || ".join(["x", *(f"lead(x, {i}) OVER o" for i in range(1, WINDOW))])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
     x AS (SELECT r, unnest(words) AS x, unnest(range(len(words))) AS i FROM w),
     win AS (SELECT r, i, {grams} AS g FROM x WINDOW o AS (PARTITION BY r ORDER BY i)),
     rep AS (SELECT r, i, g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 AS twice FROM win),
     cov AS (SELECT r, count(*) FILTER (near) AS n FROM (
               SELECT r, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS {WINDOW - 1} PRECEDING) AS near FROM rep) GROUP BY r),
     f AS (SELECT doc_id, len(words)::BIGINT AS n_words, lines, {count_of(r"[\x20\x09-\x0D]")}::BIGINT AS word_chars,
                  (length(t) - length(translate(t, '{SIGNS.decode()}', '')))::BIGINT AS n_symbols,
                  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
                  {count_of("[^A-Z]")} AS n_upper, {count_of("[^A-Za-z]")} AS n_latin, {count_of("[^!]")} AS n_exclaim,
                  len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words
           FROM w LEFT JOIN cov USING (r)),
     b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(f"({rule.sql})" for rule in rules)}) AS kept
FROM b"""
