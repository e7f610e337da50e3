"""Sets of 64-bit hashes inside tasks, fixed-size tables summed over tasks, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.session import store

SLICE = 1 << 14
TABLE = "slice int, sums binary"


class WordHashes(dict):
    """64-bit hashes of words, kept for the words of a task; emptied when it grows past ``most``."""

    most = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def summed_table(df: DataFrame, size: int, task_sums: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum over tasks of a table of ``size`` 32-bit counts; summed on executors slice by slice, so the driver gets one table."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = task_sums(batches)
        parts = [p for p in range(0, size, SLICE) if total[p:p + SLICE].any()]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(
            [total[p:p + SLICE].astype(np.uint32).tobytes() for p in parts], pa.binary())], ["slice", "sums"])

    return added_slices(df.mapInArrow(of_task, TABLE), size)


def added_slices(tables: DataFrame, size: int) -> np.ndarray:
    """The sum of tables of ``size`` 32-bit counts that lie as rows (slice, sums)."""

    def of_slice(tables: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.uint64)
        for x in tables["sums"]:
            part = np.frombuffer(x.as_py(), np.uint32)
            total[:len(part)] += part
        sums = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pa.table({"slice": tables["slice"][:1], "sums": pa.array([sums.tobytes()], pa.binary())})

    found = np.zeros(-(-size // SLICE) * SLICE, np.uint32)
    for row in tables.groupBy("slice").applyInArrow(of_slice, TABLE).collect():  # size / SLICE rows
        found[row["slice"]:row["slice"] + SLICE] = np.frombuffer(bytes(row["sums"]), np.uint32)
    return found[:size]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the least node that it is joined to.

    Large-star and small-star in turns: every node's neighbours are hung on their least one, until nothing changes.
    Each round writes its edges, so that a lost executor costs one round.
    """
    pairs = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "components")
    before = None
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("hub"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["hub"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store(large, "components")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(small.withColumnRenamed("a", "hub"), large["a"] == F.col("hub")).where("b != m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = store(hung.union(small.select("a", F.col("m").alias("b"))).distinct(), "components")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
