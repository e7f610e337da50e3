"""Data checks: nulls, uniqueness, accepted values, references, layout."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


def column_tests(df: DataFrame, table: str, declared: Mapping[str, tuple]) -> DataFrame:
    """One row per declared test: how many rows fail it, and how many different values they have.

    ``declared`` maps a column to its tests: NOT_NULL, UNIQUE or a tuple of accepted values. NULL fails NOT_NULL only. All tests of a table
    take one pass: rows are counted per column and value inside each task, and columns that need no values bring one count for NULL and one
    for the rest. A table without rows passes every test.
    """
    def needed(column: str, tests: tuple) -> Column:
        value = F.col(column).cast("string") if set(tests) - {NOT_NULL} else F.when(F.col(column).isNotNull(), F.lit(""))
        return F.struct(F.lit(column).alias("column_name"), value.alias("value"))

    value, rows = F.col("value"), F.col("rows")
    counted = (df.select(F.inline(F.array(*[needed(c, tests) for c, tests in declared.items()])))
               .groupBy("column_name", "value").agg(F.count("*").alias("rows")))
    results = []
    for column, tests in declared.items():
        for test in tests:
            breach = (value.isNull() if test == NOT_NULL else value.isNotNull() & (rows > 1) if test == UNIQUE
                      else value.isNotNull() & ~value.isin(*test))
            fails = (F.col("column_name") == column) & breach
            results.append(F.struct(
                F.lit(column).alias("column_name"), F.lit(test if isinstance(test, str) else ACCEPTED).alias("test"),
                F.coalesce(F.sum(F.when(fails, rows)), F.lit(0)).alias("failing_rows"), F.count_if(fails).alias("failing_values")))
    return counted.agg(F.array(*results).alias("results")).select(F.lit(table).alias("table_name"), F.inline("results"))


def declared_report(tables: Mapping[str, DataFrame], declared: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    """``column_tests`` for every table that has declared tests."""
    return reduce(DataFrame.unionByName, [column_tests(tables[name], name, tests) for name, tests in declared.items()])


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs per column: one pass over the table, one output row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns])
    return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def uniqueness_report(checks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Number of key values that occur more than once, per table."""
    parts = [duplicate_keys(df, keys).agg(F.lit(table).alias("table_name"), F.count("*").alias("duplicate_keys"))
             for table, (df, keys) in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def unexpected_values(df: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Values outside the list, with their row counts. NULL is left to the null check."""
    return (df.groupBy(column).agg(F.count("*").alias("rows"))
            .where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted)))


def orphan_report(references: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows whose foreign key has no parent.

    Children are counted per key before the anti join, so a key that a third of the rows share is one
    row in the join.
    """
    parts = []
    for name, (child, child_key, parent, parent_key) in references.items():
        keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(
            F.count("*").alias("rows"))
        orphans = keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")
        parts.append(orphans.agg(F.lit(name).alias("reference"),
                                 F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
                                 F.count("*").alias("orphan_keys")))
    return reduce(DataFrame.unionByName, parts)


def layout_violations(df: DataFrame, table: str, schema: StructType) -> DataFrame:
    """Breaches of NOT NULL and of the maximum text length per column, in one pass."""
    checks = []
    for field in schema:
        limit = field.metadata.get("max_length")
        missing = F.col(field.name).isNull() if not field.nullable else F.lit(False)
        too_long = F.length(F.col(field.name)) > limit if limit else F.lit(False)
        checks.append((field.name, F.count_if(missing), F.count_if(too_long)))
    counted = df.agg(*[F.struct(F.lit(name).alias("column_name"), missing.alias("missing"), long.alias("too_long"))
                       .alias(name) for name, missing, long in checks])
    return counted.select(F.lit(table).alias("table_name"),
                          F.inline(F.array(*[F.col(name) for name, _, _ in checks])))
