"""Registered queries: each pairs a Spark query over the test tables with SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, FloatType, IntegerType, ShortType

from catalog.tables_sql import with_tables
from wattloom.sources.testdata import Domain


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Domain], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, uses: str = ""):
    """Register the decorated function; ``uses`` names the domain tables that the SQL reads."""

    def add(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
        text = with_tables(sql, uses.split()) if sql else None
        CATALOG[build.__name__] = Query(build.__name__, covers, build, text)
        return build

    return add


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return plain(CATALOG[name].build(Domain(spark, sf_dir)))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as long, so that results compare across engines."""
    columns = []
    for f in df.schema:
        if isinstance(f.dataType, (DecimalType, FloatType)):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            columns.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)
