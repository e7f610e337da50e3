"""Order-independent sums and means.

A sum of doubles depends on the order in which tasks finish, and on re-runs after a lost executor.
Readings, prices and amounts are therefore summed as whole ten-thousandths: long arithmetic stays in
generated code, where a sum of decimals would build an object per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_UNIT = 10_000


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def units(value: Column | str) -> Column:
    """A value in whole ten-thousandths."""
    return F.rint(_column(value).cast("double") * PER_UNIT).cast("bigint")


def from_units(count: Column) -> Column:
    """Ten-thousandths back to a decimal; meant for sums, once per group."""
    return (count.cast("decimal(20,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(24,4)")


def total(value: Column | str) -> Column:
    return from_units(F.sum(units(value)))


def total_where(condition: Column, value: Column | str) -> Column:
    """Sum over the rows that meet the condition, 0 if none does."""
    return from_units(F.sum(F.when(condition, units(value)).otherwise(F.lit(0).cast("bigint"))))


def mean(value: Column | str) -> Column:
    """Mean as a double, NULL for a group without values."""
    return ratio(total(value), F.count(_column(value)))


def fine_mean(value: Column | str) -> Column:
    """Mean of values that have no last decimal, such as means: each is taken to nine decimals. Builds a decimal per row, so meant for reduced rows."""
    return ratio(F.sum(_column(value).cast("decimal(28,9)")), F.count(_column(value)))


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero on the decimal digits, not on the binary fraction."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")
