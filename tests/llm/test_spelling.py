"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

from wattloom.llm import spelling


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    found = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return found


def texts(seed, count, alphabet, longest):
    pick = random.Random(seed)
    stems = ["".join(pick.choice(alphabet) for _ in range(pick.randint(4, longest))) for _ in range(40)]

    def word():
        w = pick.choice(stems[:1 + pick.randrange(40)])
        if pick.random() < 0.5:
            i = pick.randrange(len(w) + 1)
            w = w[:i] + pick.choice([pick.choice(alphabet), "", pick.choice(alphabet) * 2]) + w[i + pick.randrange(2):]
        return w.upper() if pick.random() < 0.1 else w

    return [(i, " ".join(word() for _ in range(150))) for i in range(count)]


def test_against_plain_version(spark):
    for seed, alphabet, longest in ((1, "ab", 9), (2, "abcdeé", 12), (3, "aàÿ×÷z", 7)):
        rows = texts(seed, 60, alphabet, longest) + [(None, "Other othet other OTHER othet othet"), (5, None), (6, ""), (7, "12 3 ."), (7, "abcdef abcdef abcdef")]
        docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long")
        expected = plain_variants(rows)
        assert len(expected) > 30 and any(f and f != r for _, f, r, *_ in expected)
        assert {tuple(r) for r in spelling.variants(docs).collect()} == expected


def test_acceptor_is_minimal_and_finds_all_pairs():
    pick = random.Random(4)
    for _ in range(200):
        words = sorted({"".join(pick.choice("abc") for _ in range(pick.randint(0, 6))) for _ in range(pick.randint(1, 40))})
        acceptor = spelling.Acceptor(words)
        found = list(acceptor.pairs())
        assert len(found) == len(set(found))
        assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b)}
        assert len({(f, a) for f, a in zip(acceptor.final, acceptor.arcs)}) == len(acceptor.arcs)


def test_long_words_and_empty_tables(spark):
    long = "abcde" * 4000
    rows = [(1, " ".join([long] * 6 + [long[:9000] + "x" + long[9000:]] * 3 + [long + "e"] * 3))]
    found = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((len(r.word), r.n, r.n_near, r.root == long) for r in found) == [(20000, 6, 2, True), (20001, 3, 1, True), (20001, 3, 1, True)]
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chain_of_forms(spark):
    rows = [(i, " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["zzzzz"] * 3)) for i in (None,)]
    found = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    if set(found) == {"aaaaa", "aaaab", "aaabb", "aabbb", "zzzzz"}:  # the hash may shorten one
        assert found == {"aaaaa": ("aaaab", "aabbb"), "aaaab": ("aaabb", "aabbb"), "aaabb": ("aabbb", "aabbb"), "aabbb": (None, "aabbb"), "zzzzz": (None, "zzzzz")}
    assert {(w, f, r) for w, (f, r) in found.items()} == {x[:3] for x in plain_variants(rows)}
