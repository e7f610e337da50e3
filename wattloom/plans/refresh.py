"""Daily refresh: new price documents and readings, then the models that build on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import arbitrage, devices as device_ops, prices as price_ops, sketches, telemetry as telemetry_ops
from wattloom.session import small_side, store
from wattloom.sources.layers import append, layer_path, one_row_each, read_if_present, unseen_rows, upsert_partitions, write_full
from wattloom.sources.price_documents import checked_documents, new_documents, quarantined, usable


def bands_by_day(prices: DataFrame, renewed: DataFrame, path: str) -> DataFrame:
    """Price bands from a stored sketch per day: of the prices only the days in ``renewed``, or without a sketch yet, are read.

    Both frames have a column ``price_day``, by which stored prices are partitioned.
    """
    stored = read_if_present(prices.sparkSession, path)
    days = prices.select("price_day").distinct()
    if stored is not None:
        days = days.join(stored.select("price_day"), "price_day", "left_anti").union(renewed.select("price_day")).distinct()
    fresh = sketches.day_quantiles(prices.join(days, "price_day", "left_semi"))
    upsert_partitions(fresh, path, ["price_day"], "price_day")
    stored = read_if_present(prices.sparkSession, path)
    return sketches.bands_of(fresh if stored is None else stored)


def refresh(incoming: Mapping[str, DataFrame], root: str, bands: DataFrame | None = None, day_sketches: bool = False) -> dict[str, str]:
    """Bring the layers below ``root`` up to date; running it again with the same input changes nothing.

    ``incoming`` holds ``raw_day_ahead_prices``, ``telemetry``, ``customer_dim`` and
    ``device_registry``. Readings and price documents are taken up by key, so late and back-dated ones count, and a reading that a delivery repeats counts
    once. A document that can't be used goes to ``price_quarantine`` with the reason and does not keep a later one of its day away.
    Capacity and margins are computed anew for the hours that new readings or new prices touch, from all stored
    readings of those hours, and replace their rows. Quartiles come from all prices so far unless ``bands`` fixes them; with
    ``day_sketches`` they are merged from a stored sketch per day, so that a refresh reads the prices of new days only for them.
    """
    spark = incoming["telemetry"].sparkSession
    path = {
        "raw_prices": layer_path(root, "bronze", "raw_day_ahead_prices"),
        "price_quarantine": layer_path(root, "ops", "price_quarantine"),
        "telemetry": layer_path(root, "bronze", "telemetry"),
        "devices": layer_path(root, "silver", "devices"),
        "market_prices": layer_path(root, "silver", "market_prices"),
        "price_mart": layer_path(root, "gold", "price_mart"),
        "price_quantiles": layer_path(root, "ops", "price_quantiles"),
        "capacity": layer_path(root, "gold", "capacity_hourly"),
        "arbitrage": layer_path(root, "gold", "arbitrage"),
    }

    documents = incoming["raw_day_ahead_prices"]
    stored_documents = read_if_present(spark, path["raw_prices"])
    if stored_documents is not None:  # documents of a loaded day are not parsed again
        documents = documents.join(stored_documents.select(F.col("fetch_date").alias("_day")).distinct(), F.col("fetch_date") == F.col("_day"), "left_anti")
    checked = store(checked_documents(documents), "documents")
    append(new_documents(None, usable(checked)), path["raw_prices"])  # one small row per day
    append(quarantined(checked, read_if_present(spark, path["price_quarantine"])), path["price_quarantine"])

    stored_telemetry = read_if_present(spark, path["telemetry"])
    delivered = one_row_each(incoming["telemetry"], ["customer_key", "ts"]).withColumn("day", F.to_date("ts"))
    readings = store(unseen_rows(delivered, stored_telemetry, ["customer_key", "ts"], "day"), "readings")
    append(readings, path["telemetry"], ("day",))

    write_full(device_ops.enrich_devices(incoming["device_registry"], incoming["customer_dim"]), path["devices"])
    devices = small_side(spark.read.parquet(path["devices"]))  # a stored table, counted from its footers

    stored_prices = read_if_present(spark, path["market_prices"])
    to_stage = spark.read.parquet(path["raw_prices"])
    if stored_prices is not None:
        to_stage = to_stage.join(stored_prices.select("fetch_date").distinct(), "fetch_date", "left_anti")
    staged = store(price_ops.stage_prices(to_stage).withColumn("price_day", F.to_date("start_time")), "staged")
    upsert_partitions(staged, path["market_prices"], ["start_time"], "price_day")
    stored_prices = read_if_present(spark, path["market_prices"])
    prices = staged if stored_prices is None else stored_prices  # nothing is stored as long as no price came
    write_full(price_ops.price_mart(prices), path["price_mart"])

    stored_telemetry = read_if_present(spark, path["telemetry"])
    telemetry = readings if stored_telemetry is None else stored_telemetry

    hour_of = lambda column: F.date_trunc("hour", column).cast("timestamp_ntz").alias("_hour")
    hours = store(readings.select(hour_of("ts")).union(staged.select(hour_of("start_time"))).distinct(), "hours")
    days = hours.select(F.to_date("_hour").alias("day")).distinct()
    touched = telemetry.join(days, "day", "left_semi").withColumn("_hour", hour_of("ts")).join(
        hours, "_hour", "left_semi").drop("_hour")

    capacity = telemetry_ops.capacity_hourly(touched, devices)
    upsert_partitions(capacity.withColumn("day", F.to_date("hour")), path["capacity"], ["hour", "region"], "day")

    if bands is None and day_sketches:
        bands = bands_by_day(prices, staged, path["price_quantiles"])
    margins = arbitrage.arbitrage_margins(touched, devices, prices, bands=bands)
    upsert_partitions(margins.withColumn("day", F.to_date("hour")), path["arbitrage"], ["hour", "customer_key"], "day")
    return path
