"""Stable key hashing and gateway names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_bucket(key: Column) -> Column:
    """A repeatable number 0..99 for a key: the first 32 bits of its MD5, modulo 100."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def gateway_id(customer_key: Column) -> Column:
    """Keys are padded to five digits and never cut."""
    key = customer_key.cast("string")
    return F.concat(F.lit("GW-"), F.when(F.length(key) > 5, key).otherwise(F.lpad(key, 5, "0")))
