"""Price zones, battery actions and the dispatch bands that belong to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Target state of charge (percent) and grid flow (kW) per zone.
DISPATCH_BANDS = [
    ("NEGATIVE", 85.0, 95.0, 3.5, 5.0),
    ("LOW", 70.0, 92.0, 2.0, 4.5),
    ("MEDIUM", 40.0, 70.0, -1.5, 2.0),
    ("HIGH", 12.0, 35.0, -5.0, -2.0),
    ("NO_PRICE_DATA", 30.0, 70.0, -1.0, 3.0),
    ("NOT_ENROLLED", 20.0, 80.0, -2.0, 5.0),
]


def _by_price(price: Column, p25: Column, p75: Column, missing: str, below_zero: str, low: str, high: str,
              middle: str) -> Column:
    """One value per price class. The order matters: a price below zero is never merely low."""
    return (F.when(price.isNull(), missing)
            .when(price < 0, below_zero)
            .when(price < p25, low)
            .when(price > p75, high)
            .otherwise(middle))


def price_zone(price: Column, p25: Column, p75: Column) -> Column:
    return _by_price(price, p25, p75, "NO_PRICE_DATA", "NEGATIVE", "LOW", "HIGH", "MEDIUM")


def battery_action(price: Column, p25: Column, p75: Column) -> Column:
    return _by_price(price, p25, p75, "SELF_CONSUME", "MAX_CHARGE", "CHARGE", "DISCHARGE", "SELF_CONSUME")


def dispatch_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DISPATCH_BANDS,
        "dispatch_zone string, soc_min double, soc_max double, grid_min_kw double, grid_max_kw double")
