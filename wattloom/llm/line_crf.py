"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line with a word is labelled good or bad from its own features and those of the lines before and after it. Forward-backward
gives each line's probability of being good; their mean, weighted by the lines' words, is the document's, put on the scale of
the labels by a logistic curve. A document's label serves as the label of all its lines in training.

Fitting takes a bounded sample: at most SAMPLE_DOCS labelled documents of each class, those with the smallest hash of doc_id among
the ones that the caller lets in, without documents of more than SAMPLE_LINES lines. Scoring reads every document whole, in one pass.

Defined cases: a text without words, or null, is one line without words; a document labelled twice takes its lower label; null labels and null
doc_ids are never learned from; without both classes every score is 0.5; repeated rows are scored one by one; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import remainder

SAMPLE_DOCS = 2000
SAMPLE_LINES = 200
STEPS = 120
DOCS_AT_ONCE = 1000
OWN = 13
SYMBOLS = bytes(c for c in range(256) if c not in b"#*$%&|<>")
NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
NOT_LETTER = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122 or c >= 128))
NOT_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)


def line_features(line: bytes) -> tuple[list[float], int]:
    """Features of one line, and its words."""
    words = line.split()
    n = len(words)
    if not n:
        return [0.0] * (OWN - 1) + [1.0], 0
    chars = sum(map(len, words))
    letters = len(line.translate(None, NOT_LETTER)) or 1
    return [
        np.log1p(n) / 5, min(1.0, len(line.translate(None, SYMBOLS)) / n), len(line.translate(None, NOT_UPPER)) / letters,
        min(1.0, line.count(b"!") / n), len(line.translate(None, NOT_DIGIT)) / chars, len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n, min(3.0, chars / n / 6), float(b"|" in line), float(line.rstrip()[-1:] in b".!?"),
        float(n < 4), letters / chars, 0.0], n


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with its neighbours', its words, and the number of lines of each text."""
    rows, words, counts = [], [], []
    for text in texts:
        before = len(rows)
        for line in (text or "").encode().split(b"\n"):
            found, n = line_features(line)
            if n:
                rows.append(found)
                words.append(n)
        if len(rows) == before:
            rows.append(line_features(b"")[0])
            words.append(1)
        counts.append(len(rows) - before)
    own, count = np.array(rows).reshape(-1, OWN), np.array(counts, int)
    ends = np.cumsum(count)
    above, below = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    above[ends - count], below[ends - 1] = 0, 0
    return np.hstack([own, above, below, np.ones((len(own), 1))]), np.array(words, float), count


def marginals(good: np.ndarray, move: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Each line's probability of good, the expected moves (from, to), and the sum of log partition functions.

    ``good`` is the score of good over bad by line; ``move`` the scores of moves between labels, bad first.
    """
    order = np.argsort(-counts, kind="stable")
    first, size = (np.cumsum(counts) - counts)[order], counts[order]
    live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    step, ahead, total = np.exp(move), [], 0.0
    emit = np.stack([np.exp(-np.maximum(good, 0)), np.exp(np.minimum(good, 0))], 1)  # scaled so that the larger is 1
    total += np.maximum(good, 0).sum()
    scales = []
    state = None
    for t, n in enumerate(live):
        state = (emit[first] if t == 0 else (state[:n] @ step) * emit[first[:n] + t])
        scale = state.sum(1, keepdims=True)
        state = state / scale
        total += np.log(scale).sum()
        ahead.append(state)
        scales.append(scale)
    out, moves = np.empty(len(good)), np.zeros((2, 2))
    back = np.ones((live[-1] if len(live) else 0, 2))
    for t in range(len(live) - 1, -1, -1):
        held = ahead[t] * back
        out[first[:live[t]] + t] = held[:, 1] / held.sum(1)
        if t:
            onward = emit[first[:live[t]] + t] * back / scales[t]
            moves += step * (ahead[t - 1][:live[t]].T @ onward)
            back = np.ones((live[t - 1], 2))
            back[:live[t]] = onward @ step.T
    return out, moves, total


@dataclass
class Crf:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def document_means(self, texts: list[str | None]) -> np.ndarray:
        found, words, counts = features(texts)
        good = ((found - self.centre) / self.spread) @ self.weights
        line, _, _ = marginals(np.clip(good, -30, 30), self.move, counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        return np.bincount(doc, weights=line * words) / np.bincount(doc, weights=words)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        mean = np.clip(self.document_means(texts), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.shift)))


def fitted(texts: list[str | None], good: np.ndarray, prior: float, steps: int = STEPS, ridge: float = 1.0) -> Crf:
    """Conditional likelihood by gradient ascent with Adam; then the logistic curve, with classes weighted to ``prior``."""
    found, _, counts = features(texts)
    centre, spread = found.mean(0), found.std(0) + 1e-3
    centre[-1], spread[-1] = 0.0, 1.0
    scaled = (found - centre) / spread
    label = np.repeat(good, counts)
    same = counts - 1
    seen = np.array([[same[good == 0].sum(), 0.0], [0.0, same[good == 1].sum()]])
    theta = np.zeros(scaled.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        line, moves, _ = marginals(np.clip(scaled @ theta[:-4], -30, 30), theta[-4:].reshape(2, 2), counts)
        slope = np.concatenate([scaled.T @ (label - line), (seen - moves).ravel()]) - ridge * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        theta += 0.1 * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.99 ** i)) + 1e-8)
    crf = Crf(centre, spread, theta[:-4], theta[-4:].reshape(2, 2))
    share = np.clip(crf.document_means(texts), 1e-6, 1 - 1e-6)
    odds = np.log(share / (1 - share))
    weight = np.where(good == 1, prior / max(good.sum(), 1), (1 - prior) / max((1 - good).sum(), 1)) * len(good)
    curve = np.array([1.0, 0.0])
    for _ in range(30):  # Newton steps of a ridge logistic regression on one variable
        p = 1 / (1 + np.exp(-(curve[0] * odds + curve[1])))
        x = np.stack([odds, np.ones_like(odds)], 1)
        grad = x.T @ (weight * (good - p)) - 0.1 * (curve - [1, 0])
        curve = curve + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), grad).clip(-2, 2)
    crf.slope, crf.shift = max(float(curve[0]), 1e-3), float(curve[1])
    return crf


def trained(docs: DataFrame, labels: DataFrame, learn_from: Column, sample_docs: int = SAMPLE_DOCS) -> Crf | None:
    """The model from a bounded sample of the labelled documents that ``learn_from`` (a test of doc_id) lets in."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learn_from).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if not shares.get(0) or not shares.get(1):
        return None
    chosen = None
    for kind in (0, 1):
        one = known.where(F.col("quality") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        chosen = one if chosen is None else chosen.union(one)
    short = F.length("text") - F.length(F.replace("text", F.lit("\n"))) < SAMPLE_LINES
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(short).dropDuplicates(["doc_id"]).select(
        "text", "quality").orderBy(F.xxhash64("text")).collect()  # at most 2 * sample_docs rows
    good = np.array([r["quality"] for r in rows], float)
    if not 0 < good.sum() < len(good):
        return None
    return fitted([r["text"] for r in rows], good, shares[1] / (shares[0] + shares[1]))


def classified(docs: DataFrame, crf: Crf | None, name: str = "_score") -> DataFrame:
    """Every column of ``docs`` and a last one, the score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            parts = [crf.scores(texts[i:i + DOCS_AT_ONCE]) if crf else np.full(len(texts[i:i + DOCS_AT_ONCE]), 0.5)
                     for i in range(0, len(texts), DOCS_AT_ONCE)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else [], pa.float64())],
                                             [*batch.schema.names, name])

    place = docs.columns.index("text")
    return docs.mapInArrow(score, docs.select("*", F.lit(0.0).alias(name)).schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of every document, learned without those whose remainder is 1."""
    held_out = remainder(F.col("doc_id"), 3) == 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    crf = trained(texts, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")), ~held_out)
    return classified(texts, crf).select(
        "doc_id", held_out.alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
