"""Stored name lookup: trigrams of names in a bucketed table, of which a lookup reads the buckets of its own trigrams.

Answers are those of ``resolve_literal``. A name counts as many common trigrams as it has rows among the query's; together with the stored number of
its trigrams that gives the overlap, so neither the other names nor the other trigrams are read. Only names whose overlap reaches that of the
``k``-th best are compared letter by letter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.exact import ratio
from wattloom.functions.texts import folded, trigrams
from wattloom.session import scratch_path, store

BUCKETS = 32


class NameIndex:
    """Trigrams of the distinct values of a column, in a table of the session's catalog whose files lie in ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_path(spark, "names")
        self.table = f"names_{uuid.uuid4().hex}"

    def add(self, values: DataFrame, column: str) -> None:
        """Index the values that are not there yet; only these are cut into trigrams."""
        new = values.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
        present = self.spark.catalog.tableExists(self.table)
        if present:
            known = self.spark.table(self.table).where("first").select("value")
            new = store(new.join(known, "value", "left_anti"), "names")  # the table can't be read and appended to in one job
        grams = new.select("value", folded(F.col("value")).alias("folded")).select("value", "folded", trigrams(F.col("folded")).alias("grams"))
        rows = grams.select("value", "folded", F.size("grams").alias("size"), F.posexplode("grams").alias("place", "gram")).select(
            "gram", "value", "folded", "size", (F.col("place") == 0).alias("first"))
        writer = rows.repartition(self.buckets, "gram").write.bucketBy(self.buckets, "gram").sortBy("gram").mode("append")
        (writer if present else writer.option("path", self.path)).saveAsTable(self.table)

    def _hits(self, typed: str) -> DataFrame:
        """(value, folded, size, common) of the names that share a trigram with ``typed``."""
        wanted = self.spark.range(1).select(trigrams(folded(F.lit(typed)))).first()[0]
        rows = self.spark.table(self.table).where(F.col("gram").isin(wanted))
        counted = rows.groupBy("value", "folded", "size").agg(F.count("*").alias("common"))
        return counted.withColumn("want", F.lit(len(wanted)))

    def resolve(self, typed: str, k: int = 5) -> DataFrame:
        """The ``k`` names closest to ``typed``: trigram overlap, then edit distance, then name."""
        overlap = ratio(F.col("common"), F.col("size") + F.col("want") - F.col("common"))
        hits = self._hits(typed).select("value", "folded", F.round(overlap, 6).alias("similarity"))
        least = hits.orderBy(F.desc("similarity")).limit(k).agg(F.min("similarity").alias("least")).scalar()
        probe = folded(F.lit(typed))
        return (hits.where(F.col("similarity") >= least).withColumn("edits", F.levenshtein("folded", probe))
                .select("value", "similarity", "edits").orderBy(F.desc("similarity"), "edits", "value").limit(k))
