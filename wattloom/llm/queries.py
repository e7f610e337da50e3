"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import cascade, hidden_markov, line_crf, line_dedup, lsh_forest, mixing, packing, phrases, prefix_tokens, spelling, syncmers, url_model, warc
from wattloom.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_links(table(spark, sf_dir, "documents"))


def op2_url_markov_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judged(table(spark, sf_dir, "pages"))


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), length=3, percent=85)


def op9_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.judged(table(spark, sf_dir, "documents"))


def op10_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(table(spark, sf_dir, "documents"))


def op11_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.digests(table(spark, sf_dir, "documents"), PIECES)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_url_markov_filter, op3_pack_sequences, op4_crf_quality, op5_mix_sources, op6_warc_chain, op7_closed_syncmers, op8_lsh_forest, op9_rule_cascade,
        op10_hmm_score, op11_prefix_tokens, op12_spelling_variants, op13_phrases)}

SQL: dict[str, str] = {
    "op5_mix_sources": mixing.SQL, "op6_warc_chain": warc.SQL, "op9_rule_cascade": cascade.SQL,
    "op13_phrases": phrases.SQL}
