"""Day-ahead prices: staging, mart, bands, hourly means and the monthly and daily price figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.clock import EPOCH, hour_of, month_of, unix_to_utc, weekday
from wattloom.functions.exact import fine_mean, mean, rounded
from wattloom.sources.price_documents import price_points

# Parts of the household price in ct/kWh.
GRID_FEE_CT = 8.50
ELECTRICITY_TAX_CT = 2.05
RENEWABLES_LEVY_CT = 0.00
MARKUP_CT = 2.50


def stage_prices(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """One row per 15-minute interval. A repeated interval keeps the document fetched last.

    De-duplication is a maximum per key, so it combines before the shuffle and a key that repeats
    often costs no more than any other.
    """
    points = price_points(raw).withColumn("start_time", unix_to_utc("unix_seconds"))
    if dedup:
        points = (points.groupBy("start_time")
                  .agg(F.max(F.struct("fetch_date", "fetch_timestamp", "position", "price_eur_mwh")).alias("last"))
                  .select("start_time", "last.*"))
    return points.select(
        "fetch_timestamp", "fetch_date", "start_time",
        (F.col("start_time") + F.expr("INTERVAL 15 MINUTES")).alias("end_time"),
        "price_eur_mwh")


def price_mart(staged: DataFrame) -> DataFrame:
    return staged.select(
        "fetch_date", "start_time", "end_time", "price_eur_mwh",
        per_kwh(F.col("price_eur_mwh")).alias("price_eur_kwh"),
        hour_of("start_time").alias("hour"),
        weekday("start_time").alias("day_of_week"),
        F.hour("start_time").alias("hour_of_day"))


def per_kwh(price_eur_mwh: Column) -> Column:
    return rounded(price_eur_mwh.cast("decimal(18,6)") / F.lit(1000), 4)


def price_bands(prices: DataFrame, exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """One row with the lower quartile, upper quartile and mean of all interval prices.

    The default is a sketch of bounded size. ``exact`` interpolates and holds every distinct price in
    one task; prices are quoted in cents within the exchange's limits, which bounds that set.
    """
    price = F.col("price_eur_mwh")
    if exact:
        counted = prices.where(price.isNotNull()).groupBy(price.alias("price_eur_mwh")).agg(F.count("*").alias("n"))
        weighted = F.sum(F.col("price_eur_mwh").cast("decimal(18,4)") * F.col("n"))
        return counted.agg(
            F.percentile("price_eur_mwh", F.lit(0.25), F.col("n")).alias("p25"),
            F.percentile("price_eur_mwh", F.lit(0.75), F.col("n")).alias("p75"),
            F.try_divide(weighted.cast("double"), F.sum("n").cast("double")).alias("avg_price"))
    quartiles = F.percentile_approx(price, [0.25, 0.75], accuracy)
    return prices.agg(quartiles.alias("q"), mean(price).alias("avg_price")).select(
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p75"), "avg_price")


def hourly_prices(prices: DataFrame) -> DataFrame:
    """Mean price per hour: at most one row per hour of the calendar, however many documents there are."""
    return (prices.groupBy(hour_of("start_time").alias("hour"))
            .agg(mean("price_eur_mwh").alias("price_eur_mwh"))
            .withColumn("price_eur_kwh", per_kwh(F.col("price_eur_mwh"))))


def prices_between(prices: DataFrame, as_of: str, days: int) -> DataFrame:
    """Intervals of the ``days`` days that end with ``as_of``; a plain range, so it reaches the scan."""
    last = F.to_date(F.lit(as_of))
    start, end = (day.cast("timestamp_ntz") for day in (F.date_sub(last, days - 1), F.date_add(last, 1)))
    return prices.where((F.col("start_time") >= start) & (F.col("start_time") < end))


def price_range_by_day(prices: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return (prices_between(prices, as_of, days).groupBy(F.to_date("start_time").alias("price_day"))
            .agg(F.min("price_eur_mwh").alias("min_price"), F.max("price_eur_mwh").alias("max_price"),
                 mean("price_eur_mwh").alias("avg_price")))


def highest_prices(prices: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Highest price of each day and when it first occurred."""
    # time is counted backwards from a fixed point, so that the earliest of equal prices wins the maximum
    earliest_first = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.expr(EPOCH))
    peak = F.max_by("start_time", F.struct("price_eur_mwh", earliest_first.alias("back")))
    return (prices_between(prices, as_of, days).where(F.col("price_eur_mwh").isNotNull())
            .groupBy(F.to_date("start_time").alias("price_day"))
            .agg(F.max("price_eur_mwh").alias("max_price"), peak.alias("peak_start")))


def negative_hours_by_month(prices: DataFrame) -> DataFrame:
    return (hourly_prices(prices).groupBy(month_of("hour").alias("month"))
            .agg(F.count_if(F.col("price_eur_mwh") < 0).alias("negative_hours"),
                 F.min("price_eur_mwh").alias("lowest_price")))


def base_and_peak_load(prices: DataFrame) -> DataFrame:
    """Daily mean of all hours and of the hours from 8 to 20 o'clock."""
    peak_price = F.when(F.hour("hour").between(8, 19), F.col("price_eur_mwh"))
    return (hourly_prices(prices).withColumn("peak_price", peak_price)
            .groupBy(F.to_date("hour").alias("price_day"))
            .agg(fine_mean("price_eur_mwh").alias("baseload"), fine_mean("peak_price").alias("peakload")))


def household_price(prices: DataFrame, grid_fee_ct: float = GRID_FEE_CT, tax_ct: float = ELECTRICITY_TAX_CT,
                    levy_ct: float = RENEWABLES_LEVY_CT, markup_ct: float = MARKUP_CT) -> DataFrame:
    """End price per interval in ct/kWh: spot price plus the fixed parts."""
    spot = F.col("price_eur_mwh").cast("decimal(18,6)") / F.lit(10)
    parts = sum((F.lit(part).cast("decimal(10,4)") for part in (grid_fee_ct, tax_ct, levy_ct, markup_ct)), F.lit(0))
    return prices.select("start_time", "price_eur_mwh", rounded(spot, 4).alias("spot_ct_kwh"),
                         rounded(spot + parts, 4).alias("end_price_ct_kwh"))


def incomplete_days(prices: DataFrame, expected: int = 96) -> DataFrame:
    """Delivery days that do not hold the expected number of intervals (92 or 100 on clock-change days)."""
    return (prices.groupBy("fetch_date").agg(F.count("start_time").alias("intervals"))
            .where(F.col("intervals") != expected)
            .withColumn("missing_intervals", F.lit(expected) - F.col("intervals")))
