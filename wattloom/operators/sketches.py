"""Mergeable sketches: price quantiles by day and sets of devices by hour, stored small and merged at any coarser grain.

A sketch is built once per group, combined inside each task, and merged later without reading a row again. Both kinds answer
exactly as long as few values are in them (the constants below) and within a known error beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.clock import hour_of
from wattloom.functions.exact import ratio, total

#: Values that a quantile sketch holds before it thins them out: more than a month has intervals. Beyond, the rank error is below 0.1 %.
QUANTILE_SIZE = 4096
#: A set of at most 2 ** SET_BITS members is exact; beyond, the relative error is about 1 / sqrt(2 ** SET_BITS), 1.6 %.
SET_BITS = 12


def day_quantiles(prices: DataFrame) -> DataFrame:
    """One row per day: a sketch of the interval prices with their exact number and sum. Fit to be stored by day."""
    price = F.col("price_eur_mwh").cast("double")
    return prices.groupBy(F.to_date("start_time").alias("price_day")).agg(
        F.count(price).alias("intervals"), F.coalesce(total(price), F.lit(0).cast("decimal(24,4)")).alias("price_sum"),
        F.kll_sketch_agg_double(price, F.lit(QUANTILE_SIZE)).alias("quantiles"))


def merged_quantiles(days: DataFrame, *by: Column | str) -> DataFrame:
    """Days as one row per group, or as one row in all; days without a price add nothing."""
    return days.where("intervals > 0").groupBy(*by).agg(
        F.sum("intervals").alias("intervals"), F.sum("price_sum").alias("price_sum"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"))


def quantile(sketch: Column | str, rank: float) -> Column:
    """Least value with at least this share of all values at or below it; needs a sketch with a value."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank)))


def bands_of(days: DataFrame) -> DataFrame:
    """Price bands as ``price_bands`` gives them, from stored days instead of prices. NULL without any price."""
    merged = merged_quantiles(days)
    some = F.col("intervals") > 0
    return merged.select(
        F.when(some, quantile("quantiles", 0.25)).alias("p25"), F.when(some, quantile("quantiles", 0.75)).alias("p75"),
        ratio(F.col("price_sum"), F.col("intervals")).alias("avg_price"))


def device_sets(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """The set of enrolled customers with a reading, per hour and region. Fit to be stored by day.

    Readings shrink to one row per hour and customer before the devices are joined, so a gateway that sends a third of them adds one row an hour.
    """
    enrolled = devices.where("is_vpp_enrolled").select("customer_key", "region")
    seen = readings.select(hour_of("ts").alias("hour"), "customer_key").distinct()
    return seen.join(enrolled, "customer_key").groupBy("hour", "region").agg(members("customer_key").alias("members"))


def members(key: Column | str) -> Column:
    """Aggregate: the set of keys in a group. A null key is no member."""
    return F.theta_sketch_agg(key, F.lit(SET_BITS))


def united(sets: Column | str) -> Column:
    """Aggregate: the union of the sets in a group."""
    return F.theta_union_agg(sets, F.lit(SET_BITS))


def size_of(members: Column | str) -> Column:
    return F.theta_sketch_estimate(members)


def day_turnover(sets: DataFrame) -> DataFrame:
    """Active customers per day and region, and how many of them were active the day before, are new or have gone.

    Days follow the calendar: after a day without any reading all are new.
    """
    days = sets.groupBy(F.to_date("hour").alias("day"), "region").agg(united("members").alias("members"))
    before = days.select(F.date_add("day", 1).alias("day"), "region", F.col("members").alias("earlier"))
    both = days.join(before, ["day", "region"], "left")
    known = F.col("earlier").isNotNull()
    active = size_of("members")
    returning = F.when(known, size_of(F.theta_intersection("members", "earlier"))).otherwise(F.lit(0))
    new = F.when(known, size_of(F.theta_difference("members", "earlier"))).otherwise(active)
    gone = F.when(known, size_of(F.theta_difference("earlier", "members"))).otherwise(F.lit(0))
    return both.select("day", "region", active.alias("active"), returning.alias("returning"), new.alias("new"), gone.alias("gone"))


def set_overlap(sets: DataFrame, name: str, first: str, second: str) -> DataFrame:
    """Sizes of two named sets, of what they share and of both together: one row. A set without a row is empty."""
    nothing = members(F.lit(None).cast("bigint"))
    pair = sets.where(F.col(name).isin(first, second)).groupBy().agg(*[
        F.coalesce(united(F.when(F.col(name) == side, F.col("members"))), nothing).alias(column)
        for side, column in ((first, "a"), (second, "b"))])
    return pair.select(
        size_of("a").alias("n_first"), size_of("b").alias("n_second"),
        size_of(F.theta_intersection("a", "b")).alias("n_both"), size_of(F.theta_union("a", "b", F.lit(SET_BITS))).alias("n_either"),
        size_of(F.theta_difference("a", "b")).alias("n_first_only"))
