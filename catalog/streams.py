"""Registered streaming queries: each runs to the end of the given files and reads its result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from wattloom.functions.exact import total
from wattloom.operators.prices import hourly_prices
from wattloom.operators.sketches import size_of, united
from wattloom.session import scratch_path
from wattloom.sources.testdata import LAYOUTS, Domain
from wattloom.streaming import jobs


class StreamDomain(Domain):
    """The domain with its events read as a stream."""

    def source(self, name: str):
        if name != "events":
            return super().source(name)
        return jobs.file_stream(self.spark, self.sf_dir, LAYOUTS[name], "events.parquet")


def _streamed(d):
    return StreamDomain(d.spark, d.sf_dir)["telemetry"]


def _drained(d, stream):
    """Run the stream to its end and read back what it wrote."""
    path, checkpoint = scratch_path(d.spark, "stream-out"), scratch_path(d.spark, "stream-state")
    jobs.run_available(stream, path, checkpoint)
    return d.spark.read.parquet(path)


@query("T1", """
    SELECT hour, region, CAST(sum(n) AS BIGINT) AS readings, CAST(sum(soc) AS DOUBLE) AS total_battery_soc,
           CAST(sum(solar) AS DOUBLE) AS total_solar_yield_kw, CAST(sum(grid) AS DOUBLE) AS net_grid_kw
    FROM customer_hours JOIN devices USING (customer_key)
    WHERE is_vpp_enrolled AND hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM telemetry)
    GROUP BY 1, 2""", "customer_hours devices telemetry")
def stream_capacity(d):
    """Hours that the watermark has closed; the sketch of distinct devices is left out of the comparison."""
    return _drained(d, jobs.capacity_stream(_streamed(d), d["devices"])).drop("approx_active_devices")


@query("T1 A2", """
    SELECT CAST(hour AS DATE) AS day, region, count(DISTINCT customer_key) AS active
    FROM customer_hours JOIN devices USING (customer_key)
    WHERE is_vpp_enrolled AND hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM telemetry)
    GROUP BY 1, 2""", "customer_hours devices telemetry")
def stream_device_sets(d):
    """Hourly sets from the stream, merged to days: distinct customers of the hours that the watermark has closed."""
    sets = _drained(d, jobs.device_set_stream(_streamed(d), d["devices"]))
    return sets.groupBy(F.to_date("hour").alias("day"), "region").agg(size_of(united("members")).alias("active"))


@query("T2", "SELECT count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events")
def stream_ingest(d):
    """Two runs over the same folder: the second finds nothing new."""
    events = StreamDomain(d.spark, d.sf_dir).source("events")
    path, checkpoint = scratch_path(d.spark, "stream-out"), scratch_path(d.spark, "stream-state")
    jobs.run_available(events, path, checkpoint)
    jobs.run_available(events, path, checkpoint)
    return d.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.sum("event_id").alias("id_sum"))


@query("T3 S12", """
    SELECT customer_key, CAST(ts AS DATE) AS day, max(ts) AS ts, arg_max(CAST(battery_soc_pct AS DOUBLE), ts) AS battery_soc_pct
    FROM telemetry GROUP BY 1, 2""", "telemetry")
def stream_upsert(d):
    """The last reading of each customer and day."""
    path, checkpoint = scratch_path(d.spark, "stream-out"), scratch_path(d.spark, "stream-state")
    stream = _streamed(d).select("customer_key", F.to_date("ts").alias("day"), "ts", "battery_soc_pct")
    jobs.upsert_available(stream, path, checkpoint, ["customer_key", "day"], "day", "ts")
    return d.spark.read.parquet(path).select("customer_key", "day", "ts", "battery_soc_pct")


@query("T4 J4", """
    SELECT t.ts, t.customer_key, CAST(t.grid_import_export_kw AS DOUBLE) AS grid_import_export_kw, p.price_eur_mwh
    FROM telemetry t LEFT JOIN hourly_prices p ON p.hour = date_trunc('hour', t.ts)""", "telemetry hourly_prices")
def stream_priced(d):
    priced = jobs.priced_stream(_streamed(d), hourly_prices(d["market_prices"]))
    return _drained(d, priced.select("ts", "customer_key", "grid_import_export_kw", "price_eur_mwh"))


@query("T6", """
    SELECT date_trunc('hour', ts) AS hour, count(*) AS readings FROM telemetry GROUP BY 1""", "telemetry")
def stream_deduplicated(d):
    """Every reading is delivered twice and counted once."""
    twice = _streamed(d).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    once = _drained(d, jobs.deduplicated_stream(twice, ["gateway_id", "ts"]))
    return once.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("readings"))


@query("T5 T6", """
    SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (WHERE NOT late) AS on_time_rows, count(*) FILTER (WHERE late) AS late_rows,
           CAST(sum(grid_import_export_kw) AS DOUBLE) AS net_grid_kw
    FROM (SELECT ts, grid_import_export_kw, customer_key % 20 = 0
                 AND ts < max(CASE WHEN customer_key % 20 <> 0 THEN ts END) OVER () - INTERVAL 2 HOUR AS late FROM telemetry)
    GROUP BY 1""", "telemetry")
def stream_late_rows(d):
    """Three deliveries: two by time, then the readings of some gateways that were cut off until the end."""
    source, path, checkpoint = (scratch_path(d.spark, name) for name in ("stream-in", "stream-out", "stream-state"))
    readings = d["telemetry"].select("ts", "customer_key", "grid_import_export_kw")
    cut_off, middle = F.col("customer_key") % 20 == 0, F.lit("2024-01-15").cast("timestamp_ntz")
    for delivery in (~cut_off & (F.col("ts") < middle), ~cut_off & (F.col("ts") >= middle), cut_off):
        readings.where(delivery).write.mode("append").parquet(source)
        jobs.route_late(jobs.file_stream(d.spark, source, readings.schema), path, checkpoint)
    found = jobs.routed(d.spark, path, readings.schema)
    return found.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count_if(~F.col("late")).alias("on_time_rows"), F.count_if("late").alias("late_rows"),
        total("grid_import_export_kw").alias("net_grid_kw"))
