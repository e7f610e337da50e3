"""Tolerant CSV load: bad rows are set aside with a reason, good rows are typed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from wattloom.schemas import NULL_TOKENS

REASON = "_reject_reason"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, *, header: bool = True,
                     null_tokens: tuple[str, ...] = NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """Typed columns plus ``_reject_reason`` (NULL for a row that loads).

    Short rows are padded with NULL and extra columns are ignored, because every column is first read
    as text. ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    as_text = StructType([StructField(f.name, StringType()) for f in schema])
    raw = spark.read.csv(
        path, schema=as_text, header=header, mode="PERMISSIVE", quote='"', escape='"', multiLine=multi_line,
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    cleaned = raw.select(*[
        F.when(~F.col(name).isin(*null_tokens), F.col(name)).alias(name) for name in as_text.names])
    return cleaned.select(
        *[_typed(field).alias(field.name) for field in schema],
        reduce(lambda first, later: F.coalesce(first, later), map(_reason, schema)).alias(REASON))


def loaded_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull())


def load_report(checked_by_table: dict[str, DataFrame]) -> DataFrame:
    """Rows parsed, loaded and rejected per table."""
    parts = [
        checked.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("rows_parsed"),
            F.count_if(F.col(REASON).isNull()).alias("rows_loaded"),
            F.count_if(F.col(REASON).isNotNull()).alias("rows_rejected"))
        for name, checked in checked_by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def reject_reasons(checked: DataFrame) -> DataFrame:
    return rejected_rows(checked).groupBy(REASON).agg(F.count("*").alias("rows_rejected"))


def _typed(field: StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (IntegerType, LongType)):
        # "12.7" loads as 13 into a whole-number column
        value = F.round(value.try_cast("decimal(38,10)"), 0)
    return value if isinstance(field.dataType, StringType) else value.try_cast(field.dataType)


def _reason(field: StructField) -> Column:
    """Why this column rejects the row, or NULL."""
    value = F.col(field.name)
    reason = F.lit(None).cast("string")
    if not field.nullable:
        reason = F.when(value.isNull(), f"{field.name}: missing")
    limit = field.metadata.get("max_length")
    if limit:
        reason = F.coalesce(reason, F.when(F.length(value) > limit, f"{field.name}: too long"))
    if not isinstance(field.dataType, StringType):
        bad = value.isNotNull() & _typed(field).isNull()
        reason = F.coalesce(reason, F.when(bad, f"{field.name}: not a {field.dataType.simpleString()}"))
    return reason
