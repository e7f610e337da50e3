"""MinHash near-duplicates by an LSH forest, confirmed on the full shingle sets.

1. Each text becomes a set of word shingles, and the set a signature for TREES trees of DEEPEST min-hashes each. Texts with equal sets
   are one class from here on; copies are never paired.
2. Every tree is one sorted order of signatures. Two sets share a region if they agree in a tree's first ``depth`` hashes. The depth follows from
   the similarity sought: a pair at the threshold shares no region with probability below MISS.
   Regions of one class end here, which nearly all do.
3. Neighbours in the sorted orders, those with the longest common prefix, are the first candidates: as a pair that is alike in more trees
   is likelier to be close, each class keeps the BEST partners that most trees name. Confirmed pairs give components.
4. Regions that still hold several components are searched whole, for pairs across components that are alike. A region above TILE classes is cut into tiles, of which each pair is one task's work, so none is capped.

Defined cases: a text with fewer words than a shingle is one shingle, all its words; texts without words, and nulls, have empty
sets and are linked with nothing; a null doc_id never becomes a component's id unless all are null, and a row is kept if its
doc_id is its component's; repeated rows share component and verdict; an empty table gives no rows; other columns are not read.
Shingles and sets are told apart by 64 and 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.sets import WordHashes, components, mixed, overlap, summed_table
from wattloom.session import store

TREES, DEEPEST = 20, 8
HASHES = TREES * DEEPEST
MISS = 1e-6
BEST = 2
TILE = 1024
WANTED = 1 << 22
MULTIPLIERS = np.random.default_rng(17).integers(0, 2**64, (2, HASHES), np.uint64) | np.uint64(1)
MARKED = "key binary, size int, signature binary"


def shingle_set(text: str | None, hashes: WordHashes, length: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = hashes.of(words)
    length = min(length, len(words))
    total = np.zeros(len(own) - length + 1, np.uint64)
    for i in range(length):
        total = mixed(total + own[i:len(own) - length + 1 + i] + np.uint64(i + 1))
    return np.unique(total)


def set_key(members: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(members.tobytes())


def signature(members: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(members), 2048):
        part = members[at:at + 2048, None]
        least = np.minimum(least, ((part ^ MULTIPLIERS[0]) * MULTIPLIERS[1]).min(0))
    return (least >> np.uint64(32)).astype(np.uint32)


def first_depth(similarity: float) -> int:
    """The deepest prefix at which a pair of this similarity is missed by every tree with probability below MISS."""
    return max(d for d in range(1, DEEPEST + 1) if d == 1 or (1 - similarity ** d) ** TREES < MISS)


def read_sets(docs: DataFrame, length: int) -> DataFrame:
    """One row for each text: its set's key and size, and the signature."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), hashes, length) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([set_key(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())], ["doc_id", "key", "size", "signature"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(marked, "doc_id long, " + MARKED)


def regions(classes: DataFrame, depth: int) -> DataFrame:
    """(tree, prefix, order, key): each class in each tree; ``order`` is its place in the tree's sorted order."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k for k in batch.column(0).to_pylist() for _ in range(TREES)]
            orders = [np.frombuffer(s.as_py(), np.uint32).reshape(TREES, DEEPEST)[t].astype(">u4").tobytes()
                      for s in batch.column(1) for t in range(TREES)]
            yield pa.RecordBatch.from_arrays([
                pa.array(list(range(TREES)) * batch.num_rows, pa.int32()), pa.array([o[:4 * depth] for o in orders], pa.binary()),
                pa.array([o[4 * depth:] for o in orders], pa.binary()), pa.array(keys, pa.binary())], ["tree", "prefix", "order", "key"])

    return classes.select("key", "signature").mapInArrow(places, "tree int, prefix binary, order binary, key binary")


def neighbours(entries: DataFrame) -> DataFrame:
    """(a, b) of classes that follow each other in a tree's order and share a region.

    The order is dealt by range on the whole signature and key, so no region lies in one task by need. Pairs that a task's border parts
    are among those of step 4.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            found = []
            for tree, prefix, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if last and last[:2] == (tree, prefix) and last[2] != key:
                    found.append((min(last[2], key), max(last[2], key)))
                last = (tree, prefix, key)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in range(2)], ["a", "b"])

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = entries.repartitionByRange(parts, "tree", "prefix", "order", "key").sortWithinPartitions("tree", "prefix", "order", "key")
    return placed.select("tree", "prefix", "key").mapInArrow(pairs, "a binary, b binary")


def best_partners(pairs: DataFrame) -> DataFrame:
    """For each class the BEST partners that most trees name."""
    named = pairs.groupBy("a", "b").agg(F.count("*").alias("trees"))
    both = named.select(F.col("a").alias("own"), "a", "b", "trees").union(named.select(F.col("b").alias("own"), "a", "b", "trees"))
    kept = both.groupBy("own").agg(F.slice(F.sort_array(F.collect_list(F.struct("trees", "a", "b")), asc=False), 1, BEST).alias("best"))
    return kept.select(F.explode("best").alias("pair")).select("pair.a", "pair.b").distinct()


def full_sets(docs: DataFrame, keys: DataFrame, length: int) -> DataFrame:
    """(key, members) of the wanted keys. Texts are read again; a fixed-size bit table keeps most others out of the shuffle."""

    def marks(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros(WANTED, bool)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                found[int.from_bytes(key[:4]) % WANTED] = True
        return found

    wanted = np.packbits(summed_table(keys, WANTED, marks) > 0).tobytes()

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), np.unpackbits(np.frombuffer(wanted, np.uint8))
        for batch in batches:
            found = {}
            for text in batch.column(0):
                own = shingle_set(text.as_py(), hashes, length)
                key = set_key(own)
                if known[int.from_bytes(key[:4]) % WANTED]:
                    found[key] = own.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["key", "members"])

    return docs.select("text").mapInArrow(members, "key binary, members binary").join(keys, "key", "left_semi").dropDuplicates(["key"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * common >= percent * all, on the full sets."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = overlap(x, y)
                kept.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = sets.select(F.col("key").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(exact, "a binary, b binary")


def across(entries: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, depth: int) -> DataFrame:
    """(a, b) that are alike, lie in one region and in different components; enough of them to join all that are alike.

    A task that holds a region (or two tiles of one) compares signatures, which rule a pair out at five deviations, and
    confirms the others on the full sets. A pair is looked at in the first tree that it shares, and not where links found before
    in the task already join the two components, so a task gives fewer rows than it has components.
    """
    wanted = percent / 100
    least = int(HASHES * (wanted - 5 * (wanted * (1 - wanted) / HASHES) ** 0.5))
    known = entries.select("tree", "prefix", "key").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "label", F.coalesce("label", "key"))
    mixed_regions = known.groupBy("tree", "prefix").agg(
        F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select(
        "tree", "prefix", F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))
    placed = known.join(mixed_regions, ["tree", "prefix"]).withColumn("own", F.pmod(F.xxhash64("key"), F.col("tiles").cast("long")).cast("int"))
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "tree", "prefix", "key", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    signed = tiled.join(classes.select("key", "signature"), "key").join(sets, "key")

    def links(rows: pa.Table) -> pa.Table:
        keys, labelled, own = rows["key"].to_pylist(), rows["label"].to_pylist(), np.array(rows["own"])
        number = {label: i for i, label in enumerate(dict.fromkeys(labelled))}
        label = np.array([number[x] for x in labelled])
        signs = np.stack([np.frombuffer(s.as_py(), np.uint32) for s in rows["signature"]])
        members = [np.frombuffer(s.as_py(), np.uint64) for s in rows["members"]]
        i, j, tree = rows["i"][0].as_py(), rows["j"][0].as_py(), rows["tree"][0].as_py()
        found = []
        for x in np.flatnonzero(own == i):
            others = np.flatnonzero((own == j) & (label != label[x]))
            if i == j:
                others = others[others > x]
            same = signs[others] == signs[x]
            alike = same.sum(1) >= least
            shared = same[alike].reshape(-1, TREES, DEEPEST)[:, :, :depth].all(2).argmax(1)
            for y in others[alike][shared == tree]:
                if label[x] != label[y]:
                    common = overlap(members[x], members[y])
                    if 100 * common >= percent * (len(members[x]) + len(members[y]) - common):
                        label[label == label[y]] = label[x]
                        found.append((min(keys[x], keys[y]), max(keys[x], keys[y])))
        return pa.table({"a": pa.array([p[0] for p in found], pa.binary()), "b": pa.array([p[1] for p in found], pa.binary())})

    return signed.groupBy("tree", "prefix", "i", "j").applyInArrow(links, "a binary, b binary")


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    depth = first_depth(percent / 100)
    texts = docs.select("doc_id", "text")
    rows = store(read_sets(texts, length), "forest")
    classes = store(rows.where("size > 0").select("key", "signature").dropDuplicates(["key"]), "forest")
    every = store(regions(classes, depth), "forest")
    shared = every.groupBy("tree", "prefix").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high")
    entries = store(every.join(shared.select("tree", "prefix"), ["tree", "prefix"], "left_semi"), "forest")
    sets = store(full_sets(texts, entries.select("key").distinct(), length), "forest")
    labels = store(components(confirmed(best_partners(neighbours(entries)), sets, percent)), "forest")
    rest = store(across(entries, labels, classes, sets, percent, depth), "forest")
    if not rest.isEmpty():
        label_of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        bridges = rest.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left").select(
            F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
        further = store(components(bridges), "forest").select(F.col("node").alias("label"), F.col("label").alias("final"))
        nodes = labels.union(further.select(F.col("label").alias("node"), "label").join(
            labels.select("node"), "node", "left_anti"))
        labels = store(nodes.join(further, "label", "left").select("node", F.coalesce("final", "label").alias("label")), "forest")
    members = rows.where("size > 0").groupBy("key").agg(F.min("doc_id").alias("least")).join(
        labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    smallest = members.groupBy("label").agg(F.min("least").alias("component_id"))
    named = store(members.join(smallest, "label").select("key", "component_id"), "forest")
    linked = rows.select("doc_id", "size", "key").join(named, "key", "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", F.col("size").cast("long").alias("n_shingles"), component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
