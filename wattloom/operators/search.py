"""Ranked text search, section splitting, vector search and index refresh."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.texts import tokens
from wattloom.session import store

HEADING = r"(?m)^(?=#{1,6} )"


def sections(parsed: DataFrame) -> DataFrame:
    """Markdown documents cut at their headings; each part carries its heading as title."""
    part = F.posexplode(F.split("content", HEADING)).alias("section", "content")
    heading = F.regexp_extract("content", r"^#{1,6} ([^\n]*)", 1)
    return (parsed.select(*[c for c in parsed.columns if c != "content"], part)
            .where(F.trim("content") != "")
            .withColumn("title", F.trim(heading)))


def term_index(corpus: DataFrame, key: str, text: str) -> DataFrame:
    """Term counts per document with the document's length: the stored form that searches read.

    A document's terms are counted inside its row, so nothing is shuffled; only rows that share a key are counted together.
    Write it sorted by term (``write_term_index``), so a search reads only the row groups of its own terms.
    """
    single, shared = by_repeated_key(corpus, key)
    counted = row_counts(single.select(F.col(key).alias("doc"), tokens(F.col(text)).alias("words")))
    return counted if shared is None else counted.unionByName(_term_counts(shared, key, text, lambda words: words))


def by_repeated_key(corpus: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key is theirs alone, and those that share one, null included; None if there is no such row. Only keys are shuffled to find out."""
    repeated = corpus.groupBy(F.col(key).alias("_shared")).agg(F.count("*").alias("n")).where("n > 1").select("_shared")
    if repeated.isEmpty():
        return corpus, None
    same = F.col(key).eqNullSafe(F.col("_shared"))
    return corpus.join(repeated, same, "left_anti"), corpus.join(repeated, same, "left_semi")


def row_counts(rows: DataFrame) -> DataFrame:
    """(doc, doc_length, term, tf) of rows (doc, words): each row's words are sorted, and a term's count is how long its run is."""
    ordered = rows.where(F.size("words") > 0).select("doc", F.size("words").alias("doc_length"), F.sort_array("words").alias("words"))
    runs = ordered.select("doc", "doc_length", "words", F.filter(F.sequence(F.lit(0), F.col("doc_length") - 1), lambda i: (i == 0) | (
        F.get("words", i) != F.get("words", i - 1))).alias("starts"))
    counts = F.transform("starts", lambda at, i: F.struct(F.get("words", at).alias("term"), (
        F.coalesce(F.get("starts", i + 1), F.col("doc_length")) - at).cast("long").alias("tf")))
    return runs.select("doc", "doc_length", F.inline(counts))


def _term_counts(corpus: DataFrame, key: str, text: str, kept: Callable[[Column], Column]) -> DataFrame:
    words = corpus.select(F.col(key).alias("doc"), tokens(F.col(text)).alias("words"))
    return (words.select("doc", F.size("words").alias("doc_length"), F.explode(kept(F.col("words"))).alias("term"))
            .groupBy("doc", "doc_length", "term").agg(F.count("*").alias("tf")))


def corpus_stats(corpus: DataFrame, text: str) -> DataFrame:
    """One row: number of documents and total length."""
    return corpus.agg(F.count("*").alias("documents"), F.sum(F.size(tokens(F.col(text)))).alias("total_length"))


def write_term_index(index: DataFrame, path: str) -> None:
    index.repartitionByRange("term", "doc").sortWithinPartitions("term", "doc").write.parquet(path)


def bm25_search(index: DataFrame, stats: DataFrame, query_terms: list[str], k: int = 5,
                k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The ``k`` best documents for a query, ties broken by document key.

    The terms become a filter on the index. The number of documents per term is a table of at most
    one row per query term, so it is broadcast; scores then add up per document.
    """
    terms = sorted(set(query_terms) - {""})
    hits = index.where(F.col("term").isin(terms))
    frequency = F.broadcast(hits.groupBy("term").agg(F.count("*").alias("df")))  # at most len(terms) rows
    scored = (hits.join(frequency, "term")
              .withColumn("_stats", stats.select(F.struct("documents", "total_length")).scalar()))
    count, df, tf = F.col("_stats.documents"), F.col("df"), F.col("tf")
    relative_length = F.col("doc_length") / (F.col("_stats.total_length") / count)
    idf = F.log(F.lit(1.0) + (count - df + F.lit(0.5)) / (df + F.lit(0.5)))
    score = idf * tf * F.lit(k1 + 1) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * relative_length))
    return (scored.groupBy("doc").agg(F.round(F.sum(score), 6).alias("score"))
            .orderBy(F.desc("score"), "doc").limit(k))


def search(corpus: DataFrame, key: str, text: str, query_terms: list[str], k: int = 5) -> DataFrame:
    """Search a corpus without a stored index; every other column comes back as an attribute.

    The texts are cut into words once. What is left of them, the counts of the query's terms and one
    marker row per document that carries its length, is stored, because ranking reads it three times.
    """
    terms = sorted(set(query_terms) - {""})
    marker = F.array(F.lit(""))  # no word is empty
    hits = store(_term_counts(corpus, key, text, lambda words: F.concat(
        marker, F.filter(words, lambda word: word.isin(terms)))), "hits")
    stats = hits.where(F.col("term") == "").agg(
        F.count("*").alias("documents"), F.sum("doc_length").alias("total_length"))
    best = bm25_search(hits, stats, terms, k)
    found = F.broadcast(best.withColumnRenamed("doc", key))  # at most k rows
    return corpus.drop(text).join(found, key)


def vector_search(vectors: DataFrame, key: str, column: str, query: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` vectors with the highest cosine to the one-row ``query`` frame, ties broken by key."""

    def wide(vector: str) -> Column:
        return F.transform(vector, lambda x: x.cast("double"))

    def dot(a: Column, c: Column) -> Column:
        return F.aggregate(F.zip_with(a, c, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    probe = query.select(wide(column).alias("v")).select(F.struct("v", F.sqrt(dot(F.col("v"), F.col("v"))).alias("norm")))
    pairs = vectors.select(key, wide(column).alias("v"), probe.scalar().alias("q"))
    v, q = F.col("v"), F.col("q")
    cosine = F.try_divide(dot(v, q["v"]), F.sqrt(dot(v, v)) * q["norm"])
    return (pairs.select(key, F.round(cosine, 6).alias("cosine"))
            .orderBy(F.desc("cosine"), key).limit(k))


def changed_documents(corpus: DataFrame, indexed: DataFrame, key: str, text: str) -> DataFrame:
    """Documents that are new, or whose content hash differs from the indexed one."""
    hashed = corpus.withColumn("content_hash", F.md5(F.col(text)))
    return hashed.join(indexed.select(key, "content_hash"), [key, "content_hash"], "left_anti")


def removed_documents(corpus: DataFrame, indexed: DataFrame, key: str) -> DataFrame:
    return indexed.join(corpus.select(key), key, "left_anti")


def refreshed_index(index: DataFrame, corpus: DataFrame, indexed: DataFrame, key: str, text: str) -> DataFrame:
    """The index with only changed documents rebuilt and removed ones dropped."""
    changed = changed_documents(corpus, indexed, key, text)
    stale = (changed.select(F.col(key).alias("doc"))
             .unionByName(removed_documents(corpus, indexed, key).select(F.col(key).alias("doc"))))
    return index.join(stale, "doc", "left_anti").unionByName(term_index(changed, key, text))


