import random

import numpy as np
import pytest

from wattloom.llm import lsh_forest, sets


def brute(rows, length, percent):
    found = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(length, len(words))
        found.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, x in enumerate(found):
        for j in range(i):
            both = len(x & found[j])
            if x and found[j] and 100 * both >= percent * (len(x) + len(found[j]) - both):
                group[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None), default=None)
        component = least if found[i] else doc_id
        out.append((doc_id, len(found[i]), component, doc_id == component))
    return sorted(out, key=str)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for family in range(25):
        base = draw.choices(vocabulary, k=draw.choice([4, 30, 120, 400]))
        for _ in range(draw.choice([1, 1, 2, 12])):
            text = list(base)
            for _ in range(draw.randrange(0, 1 + len(text) // 12)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append(" ".join(text))
    rows += ["", None, " \n", "one", "ONE", "one two", "one  two\n", "a b c d", "a b c d", "a b c d e f g h i j é"]
    draw.shuffle(rows)
    return [(i, text) for i, text in enumerate(rows)] + [(None, rows[0]), (None, "alone here only"), (3, rows[3]), (-4, rows[5])]


@pytest.mark.parametrize("length, percent, tile", [(3, 85, 1024), (5, 80, 2)])
def test_against_brute_force(spark, monkeypatch, length, percent, tile):
    monkeypatch.setattr(lsh_forest, "TILE", tile)
    rows = corpus(length)
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, key string")
    found = lsh_forest.near_duplicates(docs, length, percent).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, length, percent)


def test_empty_table(spark):
    assert lsh_forest.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000)], "a long, b long")
    found = dict(map(tuple, sets.components(edges).collect()))
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_depth_follows_the_similarity():
    assert (lsh_forest.first_depth(0.85), lsh_forest.first_depth(0.8)) == (4, 3)


def test_signatures_estimate_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    alike = (lsh_forest.signature(a[:900]) == lsh_forest.signature(a)).mean()
    assert abs(alike - 0.9) < 0.1
