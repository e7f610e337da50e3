import itertools
import random

import numpy as np
import pytest

from wattloom.llm import line_crf


def brute(good, move):
    """Marginals, expected moves and log partition by enumerating every labelling."""
    n, total, one, moves = len(good), 0.0, np.zeros(len(good)), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        steps = list(zip(labels, labels[1:]))
        weight = np.exp(sum(g for g, y in zip(good, labels) if y) + sum(move[s] for s in steps))
        total += weight
        one += weight * np.array(labels)
        for s in steps:
            moves[s] += weight
    return one / total, moves / total, np.log(total)


def test_marginals_against_enumeration():
    draw = np.random.default_rng(3)
    counts = np.array([1, 5, 2, 7, 1])
    good, move = draw.normal(0, 2, counts.sum()), draw.normal(0, 1, (2, 2))
    line, moves, total = line_crf.marginals(good, move, counts)
    parts = [brute(g, move) for g in np.split(good, np.cumsum(counts)[:-1])]
    assert np.allclose(line, np.concatenate([p[0] for p in parts]))
    assert np.allclose(moves, sum(p[1] for p in parts))
    assert total == pytest.approx(sum(p[2] for p in parts))


def corpus():
    draw = random.Random(4)
    words = [f"{a}{b}" for a in ("re", "to", "in", "mo", "la") for b in ("ten", "ra", "sol", "vi", "", "dor")]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        lines = [[draw.choice(words) for _ in range(draw.randrange(5, 40))] for _ in range(draw.randrange(1, 6))]
        if bad:
            lines = [[w + "###" for w in x] if i % 8 else [x[0]] * 30 for x in lines]
        rows.append((i, "\n".join(" ".join(x) + "." for x in lines)))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    odd = [(1000, None), (1001, ""), (1002, "\n \n"), (None, "in la.\n"), (5, rows[5][1]), (1003, "x " * 30000 + "\ny" * 3000)]
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in rows + odd], "doc_id long, text string, score double")
    known = spark.createDataFrame([(i, q, "z") for i, q in labels] + [(None, 1, ""), (7, None, ""), (0, 0, "")], "doc_id long, quality int, text string")
    found = line_crf.quality(docs, known).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    empty = {r.score for r in found if r.doc_id in (1000, 1001, 1002)}
    assert len(empty) == 1


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in line_crf.quality(docs, none).collect()] == [(0.5, 1)]
    assert line_crf.quality(docs.limit(0), none).count() == 0
