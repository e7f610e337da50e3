import re
from collections import Counter

import pytest

from wattloom.llm import cascade

TEXTS = [
    None, "", " \n\t", "one two", "a b c d e f g h " * 3, "x " * 30, "The quick brown fox jumps over it all day. " * 1 + "More words here too, " * 2,
    "word " * 7, "\n".join(["same line here"] * 4 + ["other"]), "UP " * 12 + "AND DOWN THE ROAD WE GO NOW", "### *** %%% $$$ " * 8,
    "éè ñ ß ü " * 6, "long" * 4000 + " " + "tail words of many kinds " * 2, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21",
    "p q r s t u v w x y " + " ".join(f"w{i}" for i in range(40)) + " p q r s t u v w x y", "a b c\x1cd e\x85f " * 9]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    windows = [tuple(words[i:i + 8]) for i in range(n - 7)]
    times = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, words))
    failed = n < 20 or 100 * len(repeated) > 30 * n
    symbols, dup = sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    upper, letters = sum(c.isupper() for c in text), sum(c.isalpha() for c in text)
    runs = sum(a == b for a, b in zip(words, words[1:]))
    bad = (10 * symbols > n or chars > 15 * n or 2 * chars < 3 * n or 2 * upper > letters or 2 * letters < chars
           or 10 * runs > 3 * n or 5 * dup > 4 * len(lines))
    return n, chars, symbols, dup, len(repeated), failed, not failed and not bad


def test_against_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "again"), (None, TEXTS[6], "null")]
    found = cascade.judged(spark.createDataFrame(rows, "doc_id long, text string, n_words string")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(i, *brute(t)) for i, t, _ in rows], key=str)


@pytest.mark.parametrize("order", [1, -1])
def test_order_never_changes_the_verdict(spark, order):
    counts = cascade.counted(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))
    found = counts.select("doc_id", cascade.verdict(cascade.standard_rules()[::order]).alias("kept")).collect()
    plain = counts.select("doc_id", *[r.rejects.alias(r.name) for r in cascade.standard_rules()]).collect()
    assert {r[0]: r[1] for r in found} == {r[0]: not any(r[1:]) for r in plain}


def test_empty_table(spark):
    assert cascade.judged(spark.createDataFrame([], "doc_id long, text string")).count() == 0
