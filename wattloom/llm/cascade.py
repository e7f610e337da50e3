"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a test of the text that rejects it. On a bounded sample each rule's cost (seconds of a run that
evaluates it alone) and selectivity (share rejected) are measured; the rules then run by falling rejection per cost, and
a text that one rule rejects is not put to the next. The order changes the time, never the verdict, as a text is kept if no rule
rejects it. Base counts are taken of every text: a text that they fail is not put to the rules at all.

Defined cases: a null text has no words; texts without words fail the base test; repeated rows are judged one by one; an empty
table keeps the rules as listed; other columns are not read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import WORD
from wattloom.session import store

WINDOW = 8
LEAST_WORDS = 20
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a test over the columns text, words, n_words and the base counts."""

    name: str
    rejects: Column


def letters(pattern: str) -> Column:
    return F.length(F.regexp_replace("text", pattern, ""))


def standard_rules() -> list[Rule]:
    runs = F.size(F.filter(F.arrays_zip(F.slice("words", 1, F.greatest(F.col("n_words") - 1, F.lit(0)).cast("int")).alias("a"),
                                        F.slice("words", 2, F.greatest(F.col("n_words") - 1, F.lit(0)).cast("int")).alias("b")),
                           lambda p: p["a"] == p["b"]))
    lines = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule("word_length", (F.col("word_chars") > 15 * F.col("n_words")) | (2 * F.col("word_chars") < 3 * F.col("n_words"))),
        Rule("shouting", 2 * letters(r"\P{Lu}+") > letters(r"\P{L}+")),
        Rule("few_letters", 2 * letters(r"\P{L}+") < F.col("word_chars")),
        Rule("word_runs", 10 * runs > 3 * F.col("n_words")),
        Rule("repeated_lines", 5 * F.col("n_dup_lines") > 4 * lines),
    ]


def repeat_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes in text order.

    Texts without such a window, nearly all, are told by their number of distinct hashes. In the others the windows are
    sorted by hash, those equal to a neighbour are taken back into text order, and each adds the words that the one before it has not.
    """
    placed = F.array_sort(F.arrays_zip(hashes.alias("hash"), F.sequence(F.lit(0), F.size(hashes) - 1).alias("at")))

    def repeated(ordered: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(ordered, i - 1)["hash"] == x["hash"], F.lit(False)) | F.coalesce(
            F.get(ordered, i + 1)["hash"] == x["hash"], F.lit(False))
        return F.array_sort(F.transform(F.filter(ordered, same), lambda x: x["at"]))

    covered = F.aggregate(
        F.flatten(F.transform(F.array(placed), repeated)), F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
        lambda found, at: F.struct((found["words"] + F.least(F.lit(WINDOW), at - found["last"])).alias("words"), at.alias("last")),
        lambda found: found["words"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, text, words, n_words and the base counts of each text."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = texts.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    starts = F.size("words") - (WINDOW - 1)
    windows = F.when(starts > 0, F.transform(F.sequence(F.lit(1), F.greatest(starts, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
                     ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    hashed = words.withColumn("windows", windows).withColumn("lines", lines)
    return hashed.select(
        "doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("windows")).alias("n_repeat_words"))


def ordered_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by falling rejection per cost, as measured on about ``sample_rows`` rows."""
    rows = docs.count()
    share = min(1.0, sample_rows / max(rows, 1))
    taken = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = store(counted(docs.where(taken) if share < 1 else docs), "cascade")
    size = max(1, sample.count())
    worth = {}
    for rule in rules:
        began = time.perf_counter()
        rejected = sample.select(F.count_if(rule.rejects)).first()[0]
        worth[rule.name] = rejected / size / (time.perf_counter() - began)
    return sorted(rules, key=lambda r: -worth[r.name])


def verdict(rules: list[Rule]) -> Column:
    """True if no rule rejects; each rule is only evaluated where all before it let the text pass."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(F.coalesce(rule.rejects, F.lit(False)), False).otherwise(kept)
    return kept


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    order = ordered_rules(docs.select("doc_id", "text"), rules or standard_rules())
    return counted(docs).withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(verdict(order)).alias("kept"))


SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT id, i, count(*) OVER (PARTITION BY id, w) AS times FROM (
    SELECT id, i, words[i:i + 7] AS w FROM (SELECT id, words, unnest(range(1, len(words) - 6)) AS i FROM words))),
covered AS (
  SELECT id, sum(least(8, i - before)) AS n FROM (
    SELECT id, i, lag(i, 1, -100) OVER (PARTITION BY id ORDER BY i) AS before FROM windows WHERE times > 1)
  GROUP BY id),
counts AS (
  SELECT doc_id, text, words, len(lines) AS n_lines, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS upper, length(regexp_replace(text, '\P{L}+', '', 'g')) AS letters,
         coalesce(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])), 0) AS runs
  FROM words LEFT JOIN covered USING (id)),
failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars > 15 * n_words OR 2 * word_chars < 3 * n_words
            OR 2 * upper > letters OR 2 * letters < word_chars OR 10 * runs > 3 * n_words OR 5 * n_dup_lines > 4 * n_lines) AS kept
FROM failed
"""
