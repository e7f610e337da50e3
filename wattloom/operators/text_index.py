"""A stored inverted index in segments, refreshed by what changed and searched without reading a text.

Layout below the index's folder, all Parquet:

* ``postings/<segment>``: blocks of at most BLOCK postings of one term, with the block's highest term count and least document length. Each file holds
  the documents of one task, sorted by term and in a term by weight, the highest first; so the postings are never shuffled. These two bound the weight of every posting in it, whatever the average length is by now.
* ``documents/<segment>``: one row per document: key, length, hash of the text, attributes.
* ``dead/<segment>``: (doc, segment) of what the refresh that wrote the segment replaced or removed.
* ``commits``: one row per finished refresh. A refresh that breaks off leaves files that no commit names, which nothing reads.

A search prunes by a proven bound: the blocks of highest bound give a score that ``k`` documents reach; a block is opened only if its bound and the best
ones of the other terms reach that score together. Its documents are the same as without pruning.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.texts import tokens
from wattloom.operators.search import by_repeated_key, term_index
from wattloom.session import store

BLOCK = 128
COMMITS = "segment string, number long, documents long, total_length long, dead_documents long, dead_length long"
K1, B = 1.2, 0.75


def weight(tf: Column, length: Column, average: Column) -> Column:
    """What a term's count adds to a document's score, but for the term's rarity. Grows with the count, falls with the length."""
    return tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / average))


def rarity(documents: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (documents - df + F.lit(0.5)) / (df + F.lit(0.5)))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in order of term and weight as blocks; a block ends with its term, with its batch or when it is full. Their numbers tell a task's blocks of a term apart."""
    task, number = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        term, place = batch["term"], np.arange(batch.num_rows)
        opens = np.ones(len(place), bool)
        opens[1:] = pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
        opens |= (place - np.maximum.accumulate(np.where(opens, place, 0))) % BLOCK == 0
        starts = np.flatnonzero(opens)
        entries = pa.StructArray.from_arrays([batch["doc"], batch["tf"], batch["doc_length"]], ["doc", "tf", "doc_length"])
        yield pa.RecordBatch.from_arrays(
            [term.take(pa.array(starts)), pa.array(task + number + np.arange(len(starts))), pa.array(np.diff(np.append(starts, len(place)))),
             pa.array(np.maximum.reduceat(batch["tf"].to_numpy(), starts)), pa.array(np.minimum.reduceat(batch["doc_length"].to_numpy(), starts)),
             pa.ListArray.from_arrays(pa.array(np.append(starts, len(place)).astype(np.int32)), entries)],
            ["term", "block", "size", "most", "shortest", "entries"])
        number += len(starts)


class TextIndex:
    """An index over rows with a key ``doc``, a text and attribute columns."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> list:
        """Finished refreshes, oldest first: one row each."""
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits").orderBy("number").collect()
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _segments(self, kind: str, names: list[str]) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/{kind}/{name}").withColumn("segment", F.lit(name)) for name in names]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _dead(self, commits: list) -> DataFrame | None:
        return self._segments("dead", [c.segment for c in commits if c.dead_documents])

    def documents(self) -> DataFrame | None:
        """The documents that the index holds now."""
        commits = self.commits()
        held, dead = self._segments("documents", [c.segment for c in commits if c.documents]), self._dead(commits)
        if held is None or dead is None:
            return held
        return held.join(dead.select("doc", F.col("in_segment").alias("segment")), ["doc", "segment"], "left_anti")

    def refresh(self, corpus: DataFrame, key: str, text: str) -> dict[str, int]:
        """Bring the index to the state of ``corpus``: one new segment holds the documents that are new or changed. Returns what was done.

        Columns other than key and text become attributes; a change of an attribute counts like one of the text. Keys must be unique.
        """
        attributes = [c for c in corpus.columns if c not in (key, text)]
        mark = F.md5(F.to_json(F.struct(F.coalesce(F.col(text), F.lit("")).alias("text"), *attributes)))
        hashed = corpus.withColumnRenamed(key, "doc").withColumn("content_hash", mark)
        commits, held = self.commits(), self.documents()
        segment = f"{len(commits):06d}-{uuid.uuid4().hex[:8]}"
        if held is None:
            changed, gone = hashed, None
        else:
            state = store(hashed.select("doc", "content_hash").join(
                held.select("doc", F.col("content_hash").alias("known"), "doc_length", F.col("segment").alias("in_segment")), "doc", "full"), "index")
            renewed = F.col("content_hash").isNotNull() & ~F.col("content_hash").eqNullSafe(F.col("known"))
            stale = F.col("known").isNotNull() & ~F.col("content_hash").eqNullSafe(F.col("known"))
            changed = hashed.join(state.where(renewed).select("doc"), "doc", "left_semi")
            gone = state.where(stale).select("doc", "in_segment", "doc_length")
        if held is not None:
            changed = store(changed, "index")
        if gone is not None:
            gone.write.parquet(f"{self.path}/dead/{segment}")
            dead = self.spark.read.schema(gone.schema).parquet(f"{self.path}/dead/{segment}").agg(
                F.count("*"), F.coalesce(F.sum("doc_length"), F.lit(0))).first()
        else:
            dead = (0, 0)
        shared = by_repeated_key(changed, "doc")[1]
        length = F.when(F.col("doc").isNotNull(), F.size(tokens(F.coalesce(text, F.lit(""))))).otherwise(0).cast("int")
        rows = changed.withColumn("doc_length", length).drop(text)
        if shared is not None:  # rows that share a key are one document to the postings
            longest = rows.groupBy("doc").agg(F.max("doc_length").alias("doc_length"))
            rows = rows.drop("doc_length").join(longest, "doc", "left").withColumn("doc_length", F.coalesce("doc_length", F.lit(0)))
        rows.write.parquet(f"{self.path}/documents/{segment}")
        new = self.spark.read.schema(rows.schema).parquet(f"{self.path}/documents/{segment}").agg(
            F.count("*"), F.coalesce(F.sum("doc_length"), F.lit(0))).first()
        if new[0] or dead[0]:
            self._write_postings(term_index(changed.select("doc", text), "doc", text), f"{self.path}/postings/{segment}")
            done = [(segment, len(commits), new[0], new[1], dead[0], dead[1])]
            self.spark.createDataFrame(done, COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return {"indexed": new[0], "dropped": dead[0]}

    def _write_postings(self, counts: DataFrame, path: str) -> None:
        """Blocks in order of term and weight, made by each task from its own documents."""
        order = ("term", F.desc("tf"), "doc_length", "doc")
        doc = counts.schema["doc"].dataType.simpleString()
        layout = f"term string, block long, size long, most long, shortest int, entries array<struct<doc: {doc}, tf: bigint, doc_length: int>>"
        counts.sortWithinPartitions(*order).select("doc", "term", "tf", "doc_length").mapInArrow(blocks_of, layout).write.parquet(path)

    def search(self, query_terms: list[str], k: int = 5, where: Column | None = None) -> DataFrame:
        """The ``k`` best documents by BM25 over all documents of the index, those that fit ``where`` only, with their attributes; ties by key.

        ``where`` reads attributes. No text is read; of the postings, the blocks of the query's terms that can matter.
        """
        commits = self.commits()
        terms = sorted(set(query_terms) - {""})
        held = self.documents()
        if held is None:
            raise ValueError(f"there is no index at {self.path}")
        shown = held.drop("segment", "content_hash", "doc_length")
        live = [c for c in commits if c.documents]
        blocks = self._segments("postings", [c.segment for c in live]).where(F.col("term").isin(terms))
        total = sum(c.documents - c.dead_documents for c in commits)
        length = sum(c.total_length - c.dead_length for c in commits)
        if not total or not terms:
            return shown.limit(0).withColumn("score", F.lit(0.0))
        dead = self._dead(commits)
        documents, average = F.lit(float(total)), F.lit(float(length) / total)

        def hits(of: DataFrame) -> DataFrame:
            """One row per posting that is alive and fits ``where``."""
            found = of.withColumn("entry", F.explode("entries")).select("term", "segment", "df", "entry.*")
            if dead is not None:
                found = found.join(dead.select("doc", F.col("in_segment").alias("segment")), ["doc", "segment"], "left_anti")
            return found if where is None else found.join(held.where(where).select("doc"), "doc", "left_semi")

        if dead is None:
            sizes = blocks.groupBy("term").agg(F.sum("size").alias("df"))
        else:  # postings of documents that are gone don't count
            entries = blocks.withColumn("entry", F.explode("entries")).select("term", "segment", "entry.doc")
            sizes = entries.join(dead.select("doc", F.col("in_segment").alias("segment")), ["doc", "segment"], "left_anti").groupBy("term").agg(
                F.count("*").alias("df"))
        frequency = F.broadcast(sizes)  # at most len(terms) rows
        known = blocks.join(frequency, "term")
        bound = rarity(documents, F.col("df")) * weight(F.col("most"), F.col("shortest"), average)
        score = F.sum(rarity(documents, F.col("df")) * weight(F.col("tf"), F.col("doc_length"), average))
        heads = known.select("term", "segment", "block", "size", "df", bound.alias("bound"))
        best = {r.term: r.bound for r in heads.groupBy("term").agg(F.max("bound").alias("bound")).collect()}  # one row per query term
        if not best:
            return shown.limit(0).withColumn("score", F.lit(0.0))
        first = heads.orderBy(F.desc("bound"), "term", "segment", "block").limit(max(k, len(terms))).select("term", "segment", "block")
        seeds = hits(known.join(F.broadcast(first), ["term", "segment", "block"], "left_semi"))  # max(k, terms) blocks
        reached = seeds.groupBy("doc").agg(score.alias("score")).orderBy(F.desc("score")).limit(k).collect()  # k rows
        least = min(r.score for r in reached) - 1e-6 if len(reached) == k else float("-inf")
        others = F.lit(sum(best.values())) - reduce(lambda a, t: F.when(F.col("term") == t, F.lit(best[t])).otherwise(a), best, F.lit(0.0))
        opened = known.where(bound + others >= F.lit(least)) if least > float("-inf") else known
        ranked = hits(opened).groupBy("doc").agg(F.round(score, 6).alias("score")).orderBy(F.desc("score"), "doc").limit(k)
        return shown.join(F.broadcast(ranked), "doc")  # at most k rows
