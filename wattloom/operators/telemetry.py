"""Device telemetry: enrichment, hourly capacity, device-hour spine, coverage and battery figures.

Readings are reduced per hour and customer before the device table is joined. The reduction combines
inside each scan task, so a gateway that sends a third of all readings adds one row per hour to the
shuffle and the join never sees raw readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattloom.functions.clock import days_covered, hour_of
from wattloom.functions.exact import from_units, mean, ratio, rounded, total, total_where, units

READINGS = ("solar_yield_kw", "battery_soc_pct", "heatpump_consumption_kw", "grid_import_export_kw")

# State-of-charge zones (lower limit inclusive), full-cycle limit, daily demand windows.
SOC_ZONES = [("deep_discharge_guard", 0, 10), ("own_reserve", 10, 30), ("fleet_usable", 30, 90), ("top_buffer", 90, 101)]
MAX_CYCLES_PER_YEAR = 250
DEMAND_WINDOWS = [("morning", 6, 9), ("midday", 11, 14), ("evening", 17, 21)]


def enrich_readings(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Readings with customer attributes, joined on the customer; readings of unknown customers drop out."""
    who = devices.select("customer_key", "customer_name", "city", "region", "customer_type", "is_vpp_enrolled")
    return readings.join(who, "customer_key").select(
        "ts", "gateway_id", "customer_key", "customer_name", "city", "region", "customer_type", "is_vpp_enrolled",
        *READINGS)


def hourly_customer_totals(readings: DataFrame) -> DataFrame:
    """Sums and counts per hour and customer, from which means at any coarser grain follow exactly."""
    grid = F.col("grid_import_export_kw")
    return (readings.groupBy(hour_of("ts").alias("hour"), "customer_key").agg(
        F.count("*").alias("readings"),
        *[total(name).alias(f"{name}_sum") for name in READINGS],
        *[F.count(name).alias(f"{name}_n") for name in READINGS],
        total_where(grid > 0, grid).alias("import_kwh"),
        total_where(grid < 0, F.abs(grid)).alias("export_kwh")))


def mean_of(name: str) -> Column:
    """Mean of a reading over rows of ``hourly_customer_totals``."""
    return ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def capacity_hourly(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Hourly capacity of the enrolled fleet per region."""
    enrolled = devices.where("is_vpp_enrolled").select("customer_key", "region")
    per_customer = hourly_customer_totals(readings).join(enrolled, "customer_key")
    return per_customer.groupBy("hour", "region").agg(
        F.count("*").alias("active_vpp_devices"),  # one row per customer and hour
        rounded(F.sum("battery_soc_pct_sum"), 1).alias("total_battery_soc"),
        rounded(mean_of("battery_soc_pct"), 1).alias("avg_battery_soc_pct"),
        rounded(F.sum("solar_yield_kw_sum"), 2).alias("total_solar_yield_kw"),
        rounded(mean_of("solar_yield_kw"), 2).alias("avg_solar_yield_kw"),
        rounded(F.sum("grid_import_export_kw_sum"), 2).alias("net_grid_kw"))


def device_hours(devices: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """The device x hour spine, grown from each device row, so that no two tables are crossed."""
    hours = F.expr(f"sequence(timestamp_ntz'{first_day} 00:00:00', timestamp_ntz'{last_day} 23:00:00', interval 1 hour)")
    return devices.select("*", F.explode(hours).alias("hour"))


def coverage_gaps(readings: DataFrame, devices: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Device hours without any reading. A device's hours are listed after the join with its masks, so the spine is never shuffled."""
    every = hour_bits(hour_masks(readings), devices, first_day, last_day).select("customer_key", "gateway_id", F.posexplode("bits").alias("place", "bit"))
    origin = F.to_date(F.lit(first_day)).cast("timestamp_ntz")
    return every.where("bit = 0").select("customer_key", (origin + F.make_dt_interval(hours=F.col("place"))).alias("hour"), "gateway_id")


def hour_masks(readings: DataFrame) -> DataFrame:
    """One row per device and day: bit h of ``hours`` is set if hour h has a reading. Fit to be stored by day."""
    bit = F.call_function("shiftleft", F.lit(1), F.hour("ts"))
    return (readings.where(F.col("ts").isNotNull()).groupBy("customer_key", F.to_date("ts").alias("day"))
            .agg(F.bit_or(bit).alias("hours")))


def merged_masks(*masks: DataFrame) -> DataFrame:
    """Masks of several loads as one; loading the same readings twice changes nothing."""
    together = masks[0]
    for more in masks[1:]:
        together = together.unionByName(more)
    return together.groupBy("customer_key", "day").agg(F.bit_or("hours").alias("hours"))


def hour_bits(masks: DataFrame, devices: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """One row per device: ``bits`` has a 1 for each hour of the window with a reading, else a 0. The list is as long as the window, whatever the number of readings."""
    first, last = F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))
    per_device = (masks.where(F.col("day").between(first, last)).groupBy("customer_key", "day").agg(F.bit_or("hours").alias("hours"))
                  .groupBy("customer_key").agg(F.map_from_entries(F.collect_list(F.struct("day", "hours"))).alias("masks")))
    days = F.sequence(first, last)

    def bits(day: Column) -> Column:
        mask = F.coalesce(F.try_element_at("masks", day), F.lit(0))
        return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.getbit(mask.cast("bigint"), h))

    return devices.select("customer_key", "gateway_id").join(per_device, "customer_key", "left").select(
        "customer_key", "gateway_id", F.flatten(F.transform(days, bits)).alias("bits"))


def gap_islands(masks: DataFrame, devices: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Runs of hours without a reading, one row per device and run; a run may cross days.

    What is shuffled is a mask per device and day, not an hour of the spine.
    """
    covered = hour_bits(masks, devices, first_day, last_day)
    every = F.sequence(F.lit(0), F.size("bits") - 1)

    def gap(i: Column) -> Column:
        return F.coalesce(F.get("bits", i), F.lit(1)) == 0

    starts = F.filter(every, lambda i: gap(i) & ~gap(i - 1))
    ends = F.filter(every, lambda i: gap(i) & ~gap(i + 1))
    runs = covered.select("customer_key", "gateway_id", F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("run"))
    origin = F.to_date(F.lit(first_day)).cast("timestamp_ntz")
    return runs.select(
        "customer_key", "gateway_id", (origin + F.make_dt_interval(hours=F.col("run.a"))).alias("first_hour"),
        (origin + F.make_dt_interval(hours=F.col("run.b"))).alias("last_hour"),
        (F.col("run.b") - F.col("run.a") + 1).cast("bigint").alias("missing_hours"))


def coverage_summary(readings: DataFrame) -> DataFrame:
    span = readings.agg(F.count("*").alias("telemetry_records"),
                        F.to_date(F.min("ts")).alias("earliest_date"), F.to_date(F.max("ts")).alias("latest_date"))
    return span.withColumn("days_covered", days_covered(F.col("earliest_date"), F.col("latest_date")))


def backfill_days(readings: DataFrame, as_of: str, window_days: int = 60) -> DataFrame:
    """Days still to load: from the day after the last reading, or the whole window for an empty table."""
    today = F.to_date(F.lit(as_of))
    last = readings.agg(F.to_date(F.max("ts")).alias("last_day"))
    start = F.coalesce(F.date_add("last_day", 1), F.date_sub(today, window_days - 1))
    # a table that is up to date gives no days
    return (last.select(start.alias("start_day")).where(F.col("start_day") <= today)
            .select(F.explode(F.sequence("start_day", today)).alias("day_to_load")))


def solar_by_region(readings: DataFrame, devices: DataFrame) -> DataFrame:
    per_customer = hourly_customer_totals(readings).join(devices.select("customer_key", "region"), "customer_key")
    return per_customer.groupBy("region").agg(
        mean_of("solar_yield_kw").alias("avg_solar_yield"),
        F.sum("solar_yield_kw_sum").cast("double").alias("total_solar_yield"))


def grid_flow_by_hour(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Net grid flow of the enrolled fleet by hour of day."""
    enrolled = devices.where("is_vpp_enrolled").select("customer_key")
    per_customer = hourly_customer_totals(readings).join(enrolled, "customer_key", "left_semi")
    return per_customer.groupBy(F.hour("hour").alias("hour_of_day")).agg(
        F.sum("grid_import_export_kw_sum").cast("double").alias("net_grid_flow"),
        F.sum("export_kwh").cast("double").alias("export_kwh"))


def fleet_soc_by_hour(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Mean state of charge of the enrolled fleet per hour."""
    enrolled = devices.where("is_vpp_enrolled").select("customer_key")
    return (hourly_customer_totals(readings).join(enrolled, "customer_key", "left_semi")
            .groupBy("hour").agg(mean_of("battery_soc_pct").alias("avg_battery_soc_pct"),
                                 F.sum("battery_soc_pct_sum").alias("soc_sum"),
                                 F.sum("battery_soc_pct_n").alias("soc_n")))


def soc_zone_dwell(readings: DataFrame) -> DataFrame:
    """Share of each device's readings that lies in each state-of-charge zone."""
    soc = F.col("battery_soc_pct")
    zone = F.lit(None).cast("string")
    for name, low, high in SOC_ZONES:
        zone = F.when((soc >= low) & (soc < high), name).otherwise(zone)
    counts = (readings.where(soc.isNotNull()).groupBy("customer_key", zone.alias("soc_zone"))
              .agg(F.count("*").alias("readings")))
    return counts.select(
        "customer_key", "soc_zone", "readings",
        ratio(F.col("readings"), F.sum("readings").over(W.partitionBy("customer_key"))).alias("dwell_share"))


def full_cycles(readings: DataFrame, limit: int = MAX_CYCLES_PER_YEAR) -> DataFrame:
    """Equivalent full cycles per device and year: half the summed state-of-charge movement over 100 %.

    Neighbouring readings are compared inside device-hours, and the steps from one hour to the next
    come from the first and last reading of each hour. A very chatty device is thereby spread over
    its hours, instead of being sorted as a whole in one task, with the same result.
    """
    by_time = readings.where(F.col("battery_soc_pct").isNotNull()).select(
        "customer_key", "ts", hour_of("ts").alias("hour"), units("battery_soc_pct").alias("soc"))
    inside = W.partitionBy("customer_key", "hour").orderBy("ts", "soc")
    steps = by_time.withColumn("step", F.abs(F.col("soc") - F.lag("soc").over(inside)))
    hours = steps.groupBy("customer_key", "hour").agg(
        F.coalesce(F.sum("step"), F.lit(0)).alias("moved"),
        F.min(F.struct("ts", "soc")).alias("first"), F.max(F.struct("ts", "soc")).alias("last"))
    across = W.partitionBy("customer_key").orderBy("hour")
    joined = hours.withColumn(
        "bridge", F.coalesce(F.abs(F.col("first.soc") - F.lag("last.soc").over(across)), F.lit(0)))
    moved = from_units(F.sum(F.col("moved") + F.col("bridge")))
    return (joined.groupBy("customer_key", F.year("hour").alias("year"))
            .agg(ratio(moved, F.lit(200)).alias("full_cycles"))
            .withColumn("over_limit", F.col("full_cycles") > limit))


def demand_window_profile(readings: DataFrame) -> DataFrame:
    """Readings by daily demand window."""
    hour = F.hour("ts")
    window = F.lit("other")
    for name, start, end in DEMAND_WINDOWS:
        window = F.when((hour >= start) & (hour < end), name).otherwise(window)
    return readings.groupBy(window.alias("demand_window")).agg(
        F.count("*").alias("readings"), mean("grid_import_export_kw").alias("avg_grid_kw"),
        mean("battery_soc_pct").alias("avg_battery_soc_pct"), total("solar_yield_kw").cast("double").alias("solar_kw"))


def self_consumption(readings: DataFrame) -> DataFrame:
    """Share of a device's solar yield per day that was not exported."""
    grid = F.col("grid_import_export_kw")
    per_day = readings.groupBy("customer_key", F.to_date("ts").alias("day")).agg(
        total("solar_yield_kw").alias("solar"), total_where(grid < 0, F.abs(grid)).alias("exported"))
    return per_day.where(F.col("solar") > 0).select(
        "customer_key", "day", F.col("solar").cast("double").alias("solar_kwh"),
        F.col("exported").cast("double").alias("export_kwh"),
        ratio(F.greatest(F.col("solar") - F.col("exported"), F.lit(0)), F.col("solar")).alias("self_consumption_share"))
