"""From raw documents to packed token sequences: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import line_crf, line_dedup, lsh_forest, mixing, packing
from wattloom.llm.common import fresh, numbered, table
from wattloom.llm.queries import VOCABULARY
from wattloom.session import store


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model accepts; it learns from every labelled document among them."""
    crf = line_crf.trained(docs, table(spark, sf_dir, "labels"), F.lit(True))
    score = fresh(docs, "_score")
    return line_crf.classified(docs, crf, score).where(F.col(score) >= 0.5).drop(score)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is like; those that lose all their words go."""
    return line_dedup.without_removed(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the smallest doc_id, of several rows with it the first as read; no doc_id comes last."""
    row, key = fresh(docs, "_row"), fresh(docs, "_gone")
    rows = numbered(docs, row, nulls_last=True)
    near = lsh_forest.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    gone = store(near.where("not kept").select(F.col("doc_id").alias(key)), "pipeline")
    some, others = line_dedup.parted(rows, row, gone)
    return others.union(some.join(gone, F.col(row) == F.col(key), "left_anti")).drop(row)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("quality classifier", good_quality), ("line dedup", fresh_lines), ("MinHash near-dedup", one_of_each),
    ("mixing sources to target weights", mixed_sources), ("packing", packed)]

#: Neither the trained model nor the tokenizer can be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again, so that a lost executor costs one stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
