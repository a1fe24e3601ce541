"""Licence scan by a positional index of rare words; DataFrame operations only.

A template is a licence notice with a mandatory key phrase. Document frequencies of all template words are counted over
the whole corpus; they name the rarest word of each key phrase. In a file, the positions of that word are looked up
(its posting list), shifted by the word's place in the phrase to possible starts, and a start stays if every word of the
phrase stands at its relative position. The rest of the notice is then aligned at the same start: the share of its words
that stand at their places is the score of the place.

Everything about one file is computed inside its own row, so there is no shuffle, and no key can be hot. The word counts
per template word are one row in all.

Defined results: a NULL text is an empty one; a file without words or phrases has no first or last word, empty labels and
the score 0. Rows that repeat an id are scanned apart. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters of a word, after A-Z are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key: str  # consecutive words of the notice that must all be there
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_place(self) -> int:
        n, k = self.words, self.key_words
        return next(i for i in range(len(n)) if n[i : i + len(k)] == k)


# The base phrases with their labels, then the notices of versions and further licences.
TEMPLATES = (
    Template("gpl", "licensed under the gnu general public license", "gnu general public license", True),
    Template("apache", "licensed under the apache license", "apache license", True),
    Template("cc-by", "licensed under cc by", "cc by", True),
    Template("mit", "released under the mit license", "mit license", True),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("bsd", "redistribution and use in source and binary forms", "source and binary forms"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))


def document_frequencies(docs: DataFrame, words: str, vocabulary: list[str]) -> dict[str, int]:
    """Documents per vocabulary word: one aggregate row, whatever the corpus."""
    counts = docs.agg(*[F.count_if(F.array_contains(words, w)).alias(f"n{i}") for i, w in enumerate(vocabulary)])
    return dict(zip(vocabulary, counts.first(), strict=True))


def _starts(words: Column, at: Column, key: list[str], anchor: int) -> Column:
    """Starts of the phrase among the posting list of its anchor word."""
    rest = [i for i in range(len(key)) if i != anchor]
    here = lambda s: reduce(
        lambda a, b: a & b, [F.coalesce(F.get(words, s + F.lit(i)) == key[i], F.lit(False)) for i in rest], s >= 0
    )
    return F.filter(F.transform(at, lambda p: p - F.lit(anchor)), here)


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) per row of `docs`.

    `places` lists every found phrase as (label, start); positions count words from 0.
    """
    files = docs.select(F.col(id_column).alias("doc_id"), words_of(F.col(text_column)).alias("words"))
    vocabulary = sorted({w for t in templates for w in t.key_words})
    found_in = document_frequencies(files, "words", vocabulary)
    rarest = {t: min(range(len(t.key_words)), key=lambda i: (found_in[t.key_words[i]], i)) for t in templates}
    anchors = sorted({t.key_words[i] for t, i in rarest.items()})
    words = F.col("words")
    posting = lambda w: F.when(
        F.array_contains(words, w),
        F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == w),
    ).otherwise(F.array().cast("array<int>"))
    files = files.withColumns({f"at_{i}": posting(w) for i, w in enumerate(anchors)})
    files = files.withColumns(
        {
            f"starts_{n}": _starts(words, F.col(f"at_{anchors.index(t.key_words[rarest[t]])}"), t.key_words, rarest[t])
            for n, t in enumerate(templates)
        }
    )

    def alignment(t: Template) -> Column:
        """The best share of the notice's words that stand at their places."""

        def share(start: Column) -> Column:
            at = [F.get(words, start + F.lit(i - t.key_place)) == w for i, w in enumerate(t.words)]
            return reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(False)).cast("int") for x in at]) / F.lit(len(t.words))

        return F.array_max(F.transform(starts[t], share))

    def listed(t: Template) -> Column:
        return F.transform(starts[t], lambda s: F.struct(F.lit(t.label).alias("label"), s.alias("start")))

    starts = {t: F.col(f"starts_{n}") for n, t in enumerate(templates)}
    base = [t for t in templates if t.base]
    labels = lambda some: F.array_join(
        F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(starts[t]) > 0, t.label) for t in some])))), ","
    )
    all_base = F.flatten(F.array(*[starts[t] for t in base]))
    return files.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.size(all_base).cast("long").alias("n_base"),
        F.array_min(all_base).cast("long").alias("first_word"),
        F.array_max(all_base).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(templates).alias("labels"),
        F.round(F.coalesce(F.greatest(*map(alignment, templates)), F.lit(0.0)), 6).alias("score"),
        F.flatten(F.array(*map(listed, templates))).alias("places"),
    )


def oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The scan in DuckDB SQL, by comparing every window of words with every key phrase."""
    words = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{u}', '{l}'), '{p}'), lambda w: w <> '')"
    words = words.format(u=UPPER, l=LOWER, p=r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    parts, base = [], []
    for n, t in enumerate(templates):
        k, o = len(t.key_words), t.key_place
        parts.append(f"list_filter(range(len(w)), lambda i: w[i + 1 : i + {k}] = {quoted(t.key_words)}) AS s{n}")
        base += [f"s{n}"] if t.base else []
    scores, labels, base_labels = [], [], []
    for n, t in enumerate(templates):
        same = " + ".join(
            f"CASE WHEN i + {j - t.key_place} >= 0 AND w[greatest(i + {j - t.key_place} + 1, 1)] = '{x}' THEN 1 ELSE 0 END"
            for j, x in enumerate(t.words)
        )
        scores.append(f"list_max(list_transform(s{n}, lambda i: ({same}) / {len(t.words)}.0::DOUBLE))")
        labels.append(f"CASE WHEN len(s{n}) > 0 THEN '{t.label}' END")
        base_labels += [labels[-1]] if t.base else []
    join = lambda xs: (
        f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL))), ','), '')"
    )
    return f"""
WITH f AS (SELECT doc_id, {words} AS w FROM documents), s AS (SELECT doc_id, w, {', '.join(parts)} FROM f),
     b AS (SELECT *, flatten([{', '.join(base)}]) AS places FROM s)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
       list_max(places)::BIGINT AS last_word, {join(base_labels)} AS base_labels, {join(labels)} AS labels,
       round(coalesce(greatest({', '.join(scores)}), 0.0), 6)::DOUBLE AS score
FROM b"""
