"""Words, tables and hashing shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import store

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: bytes) -> list[bytes]:
    """The words of UTF-8 bytes: ``bytes.split`` splits at ASCII white space only, as WORD does."""
    return text.split()


def text_bytes(value: str | None) -> bytes:
    """UTF-8 of a text; a null is empty, and lone surrogates cannot occur in Parquet strings."""
    return b"" if value is None else value.encode("utf-8")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key's decimal text, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def groups_for(rows: int, target: int) -> int:
    """So many hashed groups that each has about ``target`` rows."""
    return max(1, -(-rows // target))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str, nulls_last: bool = False) -> DataFrame:
    """``docs`` with a row number in column ``name``: unique, in the order of doc_id. Rows that share a doc_id are numbered as they are read.

    Where no row lacks a doc_id or shares one, the number is the doc_id; only other tables are sorted and stored, texts and all.
    """
    read = fresh(docs, "_read")
    own = F.col("doc_id").cast("long")
    if docs.groupBy(own.alias(name)).agg(F.count("*").alias(read)).where(F.col(name).isNull() | (F.col(read) > 1)).isEmpty():
        return docs.withColumn(name, own)
    order = (own.asc_nulls_last() if nulls_last else own.asc_nulls_first(), F.col(read))
    placed = docs.withColumn(read, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return store(placed.drop(read).withColumn(name, F.monotonically_increasing_id()), "rows")
