"""Collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wattloom.llm import phrases


def plain(rows, least, top):
    found = []
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        sizes[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i:i + n])] += 1
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        found += [(lang, i + 1, p.decode(), -a, l, r, sizes[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(found)


def texts(seed, count):
    pick = random.Random(seed)
    words = ["Red", "red", "é", "É", "x-1", "a b", "lorem", "IPSUM", "on", "of", "the", "\x1c", "日本"]
    fixed = ["new york city hall", "as soon as possible", "the of the of", "on on on on on"]
    marks = [" ", "  ", "\t", " \t ", ". ", ",", "\n", "\r\n", "\x0b", "; ", "?!", ": "]

    def text():
        return "".join((pick.choice(fixed) if pick.random() < 0.2 else pick.choice(words)) + pick.choices(marks, [30, 3, 3, 3, *[1] * 8])[0] for _ in range(pick.randint(0, 120)))

    return [(text(), pick.choice(["en", "en", "en", "de", None, "und", ""])) for _ in range(count)]


@pytest.mark.parametrize(("least", "top"), [(30, 2000), (4, 25)])
def test_against_plain_version(spark, least, top):
    rows = texts(least, 150) + [(None, "en"), ("", "fr"), ("only one", "it"), (" \t.", None)] + [("copy right by us", "de")] * 40
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, phrase string, n long").repartition(5)
    expected = plain(rows, least, top)
    assert len(expected) > 40
    assert sorted(map(tuple, phrases.collocations(docs, least, top).collect())) == expected


def test_no_frequent_key_is_lost():
    pick = np.random.default_rng(3)
    for least in (2, 5, 30):
        for _ in range(60):
            parts = []
            for _ in range(int(pick.integers(1, 30))):
                keys, counts = np.unique(pick.zipf(1.3, int(pick.integers(1, 400))).astype(np.uint32) % 5000, return_counts=True)
                parts.append((keys, counts.astype(np.int64)))
            exact = Counter()
            for keys, counts in parts:
                for k, c in zip(keys.tolist(), counts.tolist()):
                    exact[k] += c
            mass = sum(exact.values())
            keys, counters, loss = phrases.summary(iter(parts), mass, least)
            assert loss < least and len(keys) <= mass // least + 1
            held = dict(zip(keys.tolist(), counters.tolist()))
            assert all(held.get(k, 0) <= n <= held.get(k, 0) + loss for k, n in exact.items())
            assert all(k in held for k, n in exact.items() if n >= least)


def test_small_blocks_and_long_words(spark, monkeypatch):
    rows = [("w" * 3_000_000 + " end here. " + "to be or not " * 100_000, "en")] * 2 + [("y" * 5000 + " end here", "en")] * 40
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = {r.phrase: r.a for r in phrases.collocations(docs).collect()}
    assert found["y" * 5000 + " end here"] == 40 and found["to be or not"] == 200_000


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
