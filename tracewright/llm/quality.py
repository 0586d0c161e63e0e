"""Quality rules as a short-circuit cascade.

Each rule looks at one or two features of a text and rejects or passes it. On a
bounded sample the cascade measures every rule's cost (seconds a text) and
selectivity (share rejected) and then runs the rules in the order of rejections
per cost, stopping at the first rejection. The order changes the work, never
the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
#: Rows of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 512


class Features:
    """Features of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    def __getattr__(self, name):
        value = getattr(type(self), "_" + name)(self)
        self.__dict__[name] = value
        return value

    def _words(self):
        return WORD.findall(self.text)

    def _n_words(self):
        return len(self.words)

    def _word_chars(self):
        return sum(map(len, self.words))

    def _n_symbols(self):
        return len(SYMBOL.findall(self.text))

    def _lines(self):
        return [x for x in self.text.split("\n") if WORD.search(x)]

    def _n_dup_lines(self):
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self):
        w = self.words
        if len(w) < 6:
            return 0
        windows = list(zip(w, w[1:], w[2:], w[3:], w[4:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered, n = 0, 0  # words up to `covered` are counted
        for k, x in enumerate(windows):
            if counts[x] > 1:
                n += k + 5 - max(covered, k)
                covered = k + 5
        return n

    def _n_alpha_words(self):
        return sum(1 for w in self.words if any(map(str.isalpha, w)))

    def _n_upper(self):
        return sum(map(str.isupper, self.text))

    def _n_letters(self):
        return sum(map(str.isalpha, self.text))


#: name → (rejects, what it rejects). Every rule holds for whole texts.
RULES = {
    "few_words": (lambda f: f.n_words < 10, "fewer than 10 words"),
    "repeats": (lambda f: 100 * f.n_repeat_words > 20 * f.n_words, "over 20 % of words in repeated five-word windows"),
    "symbols": (lambda f: 10 * f.n_symbols > f.n_words, "over one symbol in ten words"),
    "word_length": (lambda f: not 2 * f.n_words <= f.word_chars <= 15 * f.n_words, "mean word length outside 2 to 15"),
    "dup_lines": (lambda f: len(f.lines) >= 4 and 10 * f.n_dup_lines > 3 * len(f.lines), "over 30 % of lines repeat an earlier one"),
    "alphabetic": (lambda f: 10 * f.n_alpha_words < 6 * f.n_words, "under 60 % of words with a letter"),
    "shouting": (lambda f: 2 * f.n_upper > f.n_letters, "over half of the letters are capitals"),
    "exclaiming": (lambda f: 2 * f.text.count("!") > f.n_words, "over one exclamation mark in two words"),
}


def measured(texts: list[str | None]) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected), each rule on features of its own."""
    out = []
    for name, (rejects, _) in RULES.items():
        began, hits = time.perf_counter(), 0
        for t in texts:
            hits += rejects(Features(t))
        out.append((name, (time.perf_counter() - began) / max(1, len(texts)), hits / max(1, len(texts))))
    return out


def ordered(costs: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejections per cost, most first; by name where they are equal."""
    return [n for n, c, s in sorted(costs, key=lambda x: (-x[2] / max(x[1], 1e-9), x[0]))]


def verdict(f: Features, order: list[str]) -> str | None:
    """The first rule that rejects, or None."""
    return next((n for n in order if RULES[n][0](f)), None)


def fit_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The order of rules from a sample of at most ``sample_rows`` texts."""
    n = docs.count()
    some = docs.select(docs["text"].cast("string")).sample(fraction=min(1.0, 2.0 * sample_rows / max(n, 1)), seed=7).limit(sample_rows)
    return ordered(measured([r[0] for r in some.collect()]))


def assess(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, rejected_by.

    Null and empty texts have no words and fail. Repeated rows and null ids are
    assessed like others; further columns are ignored. ``rejected_by`` is the
    rule that the cascade met first and may differ between runs where several
    rules reject; it is null for texts kept.
    """
    order = fit_order(docs, sample_rows)

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for t in b.column(1).to_pylist():
                f = Features(t)
                failed = RULES["few_words"][0](f) or RULES["repeats"][0](f)
                by = verdict(f, order)
                for c, v in zip(cols, (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, failed, by is None, by)):
                    c.append(v)
            types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"])

    src = docs.select("doc_id", docs["text"].cast("string"))
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents")).drop("rejected_by")


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
w AS (SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS i FROM f),
five AS (
  SELECT rid, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d, lead(word, 4) OVER o AS e
  FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (
  SELECT rid, i, e IS NOT NULL AND count(*) OVER (PARTITION BY rid, a, b, c, d, e) > 1 AS again FROM five),
covered AS (
  SELECT rid, max(CAST(again AS INT)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM twice),
r AS (SELECT rid, sum(hit) AS n FROM covered GROUP BY rid),
n AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_alpha_words,
         len(regexp_extract_all(text, '\p{Lu}')) AS n_upper, len(regexp_extract_all(text, '\p{L}')) AS n_letters,
         len(regexp_extract_all(text, '!')) AS n_marks
  FROM f LEFT JOIN r ON r.rid = f.rid),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM n)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR (n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines) OR 10 * n_alpha_words < 6 * n_words
            OR 2 * n_upper > n_letters OR 2 * n_marks > n_words) AS kept
FROM v
"""

QUERIES = {"op7_quality": op7_quality}
ORACLES = {"op7_quality": ORACLE}
