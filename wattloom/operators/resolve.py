"""Find the stored spelling of a name that a person typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.exact import ratio
from wattloom.functions.texts import folded, trigrams


def resolve_literal(values: DataFrame, column: str, typed: str, k: int = 5) -> DataFrame:
    """The ``k`` distinct values closest to ``typed``: trigram overlap, then edit distance, then name.

    The typed text is one literal, so every value is scored where it is read and nothing is paired up.
    """
    distinct = values.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    probe = folded(F.lit(typed))
    scored = distinct.select(
        "value", trigrams(folded(F.col("value"))).alias("have"), trigrams(probe).alias("want"),
        F.levenshtein(folded(F.col("value")), probe).alias("edits"))
    common = F.size(F.array_intersect("have", "want"))
    overlap = ratio(common, F.size(F.array_union("have", "want")))
    return (scored.where(common > 0).select("value", F.round(overlap, 6).alias("similarity"), "edits")
            .orderBy(F.desc("similarity"), "edits", "value").limit(k))
