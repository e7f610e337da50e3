"""Spelling variants: words one edit apart, found by composing vocabulary acceptors with a one-edit transducer.

1. Words are the runs of LETTERS, with A-Z lower-cased. The contract's digest deletes one code point of a few of them, by hash. Tasks count
   their words document by document; the counts are summed by word.
2. Two words one edit apart have the same first half or, if the edit lies there, the same second half. So each word is dealt to the initial states that
   its first half leads to and, reversed, to those of its second half, once as the shorter and once as the longer word of a pair (``dealt``).
   A partition holds whole initial states; the words of one lie next to each other in order.
3. Of the words of an initial state a minimised acceptor is built (``Acceptor``). Composed with the transducer and itself, its states are pairs: equal ones before
   the edit, two that go on together after it. Each state's accepted pairs with the edit right there are found once (``edits``), whatever
   the number of ways that lead to it; the walk from the initial state goes only where there are pairs below (``pairs``).
   A pair whose first halves agree is left to the forward side, so each comes up once.
4. A word's form is its near word of largest count if that is at least RATIO times its own; roots follow forms by pointer doubling.

Memory is bounded by the words of one initial state: of words of one length, with one half in common. No text is shuffled.

Defined cases: a null or empty text has no words; a null doc_id hashes as the empty text; rows that share a doc_id are counted each; ties of
counts go to the smallest word in code-point order; an empty table gives no rows; other columns are not read; long words are worked on without recursion.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.session import store

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
DELETED_IN = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
HELD_WORDS = 300_000
DEALT = "length int, backward boolean, half string, word string, n long"
NEAR = "word string, near string, near_n long"


def document_words(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """Distinct lower-cased words of a text and how often they occur, one code point gone where the hash says so."""
    start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    own: Counter[str] = Counter()
    for run, times in Counter(LETTERS.findall(text)).items():
        own[run if run.islower() else run.encode().lower().decode()] += times
    for word, times in own.items():
        h = zlib.crc32(word.encode(), start)
        if h % DELETED_IN == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, times


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, times in document_words(doc_id, text.as_py() or ""):
                    if len(word) >= least_length:
                        total[word] += times
                if len(total) >= HELD_WORDS:
                    yield given()
        yield given()

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(counts, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def dealt(words: DataFrame, least_length: int) -> DataFrame:
    """Each word under the halves that it shares with possible partners; ``length`` is that of the pair's shorter word."""
    size = F.length("word")
    lengths = F.filter(F.array(size, size - 1), lambda x: x >= least_length)
    rows = words.withColumn("length", F.explode(lengths)).withColumn("backward", F.explode(F.array(F.lit(False), F.lit(True))))
    half = F.floor(F.col("length") / 2).cast("int")
    turned = rows.withColumn("word", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")))
    kept = F.when(F.col("backward"), F.col("length") - half).otherwise(half)
    return turned.select("length", "backward", F.substring("word", F.lit(1), kept).alias("half"), "word", "n")


class Acceptor:
    """The minimised acceptor of a sorted list of distinct words. A state's number is above those of the states that it leads to."""

    def __init__(self, words: Iterable[str]) -> None:
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[tuple[list[tuple[str, int]], list[bool]]] = [([], [False])]
        previous = ""

        def settled(depth: int) -> None:
            while len(path) > depth + 1:
                arcs, final = path.pop()
                key = (final[0], tuple(arcs))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.arcs)
                    self.arcs.append(key[1])
                    self.final.append(key[0])
                path[-1][0].append((previous[len(path) - 1], state))

        for word in words:
            common = shared(previous, word)
            settled(common)
            path.extend(([], [False]) for _ in range(len(word) - common))
            path[-1][1][0] = True
            previous = word
        settled(0)
        self.start = len(self.arcs)
        self.arcs.append(tuple(path[0][0]))
        self.final.append(path[0][1][0])
        self.follow = [dict(arcs) for arcs in self.arcs]
        self.barren: set[tuple[int, int]] = set()

    def common(self, a: int, b: int, without: str = "") -> list[str]:
        """What both states accept, but for words that begin with ``without``."""
        if not without and (a, b) in self.barren:
            return []
        found: list[str] = []
        stack: list[tuple[int, int, tuple | None]] = [(a, b, None)]
        while stack:
            x, y, way = stack.pop()
            if self.final[x] and self.final[y]:
                found.append(spelled(way))
            if (x, y) in self.barren:
                continue
            short, other = (x, y) if len(self.arcs[x]) <= len(self.arcs[y]) else (y, x)
            for c, to in self.arcs[short]:
                with_it = self.follow[other].get(c)
                if with_it is not None and (way is not None or c != without):
                    stack.append((to, with_it, (way, c)) if short == x else (with_it, to, (way, c)))
        if not found and not without:
            self.barren.add((a, b))
        return found

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Accepted pairs with the edit at once: (a, b) of equal length, or b with one more code point. Of one pair, the latest place of an insertion counts."""
        arcs = self.arcs[state]
        found = []
        for i, (c, to) in enumerate(arcs):
            for d, other in arcs[i + 1:]:
                found += [(c + rest, d + rest) for rest in self.common(to, other)]
            found += [(rest, c + rest) for rest in self.common(state, to, c)]
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted words one edit apart, the shorter one first."""
        edits = [self.edits(state) for state in range(len(self.arcs))]
        fruitful = [False] * len(self.arcs)
        for state, arcs in enumerate(self.arcs):
            fruitful[state] = bool(edits[state]) or any(fruitful[to] for _, to in arcs)
        stack: list[tuple[int, tuple | None]] = [(self.start, None)] if fruitful[self.start] else []
        while stack:
            state, way = stack.pop()
            if edits[state]:
                before = spelled(way)
                for a, b in edits[state]:
                    yield before + a, before + b
            stack.extend((to, (way, c)) for c, to in self.arcs[state] if fruitful[to])


def shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def spelled(way: tuple | None) -> str:
    letters = []
    while way is not None:
        way, c = way
        letters.append(c)
    return "".join(reversed(letters))


def pairs_of_state(length: int, backward: bool, half: str, words: dict[str, int]) -> Iterator[tuple[str, str]]:
    """Near pairs of an initial state: the shorter word is ``length`` long, and on the backward side the first halves differ."""
    skip, front = len(half), length // 2
    for a, b in Acceptor(w[skip:] for w in words).pairs():
        if skip + len(a) != length:
            continue
        a, b = half + a, half + b
        if backward:
            a, b = a[::-1], b[::-1]
            if a[:front] == b[:front]:
                continue
        yield a, b


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, near, near_n): each word with every word one edit away, and that one's count."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}
        out: list[tuple[str, str, int]] = []

        def worked() -> None:
            if len(held) < 2:
                return
            length, backward, half = at
            turn = (lambda w: w[::-1]) if backward else (lambda w: w)
            for a, b in pairs_of_state(length, backward, half, held):
                out.append((a, b, held[turn(b)]))
                out.append((b, a, held[turn(a)]))

        def given() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                                              ["word", "near", "near_n"])

        for batch in batches:
            for length, backward, half, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (length, backward, half) != at:
                    worked()
                    at, held = (length, backward, half), {}
                    if len(out) >= HELD_WORDS:
                        yield given()
                held[word] = n
        worked()
        yield given()

    rows = dealt(words, least_length).repartition("length", "backward", "half").sortWithinPartitions("length", "backward", "half", "word")
    return rows.mapInArrow(found, NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last word that forms lead to. Each round doubles how far a pointer reaches."""
    reach = store(forms.select("word", F.col("form").alias("root")), "spelling")
    while True:
        onward = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = store(reach.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling")
        moved = not further.where("moved").isEmpty()
        reach = further.select("word", "root")
        if not moved:
            return reach


def variants(docs: DataFrame) -> DataFrame:
    """One row for each word of the vocabulary: its count, how many words are near, its form with count, and its root."""
    words = store(vocabulary(docs), "spelling")
    best = F.min(F.struct(F.negative("near_n").alias("turned"), F.col("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    likely = -F.col("best.turned") >= RATIO * F.col("n")
    known = store(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(likely, F.col("best.near")).alias("form"),
        F.when(likely, -F.col("best.turned")).alias("form_n")), "spelling")
    last = roots(known.where("form is not null"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
