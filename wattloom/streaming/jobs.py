"""Structured Streaming versions of the hourly aggregates and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattloom.functions.exact import total
from wattloom.operators.sketches import members
from wattloom.sources.layers import upsert_partitions


def file_stream(spark: SparkSession, path: str, schema: StructType | str, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder whose names match the pattern."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop. A later run with the same checkpoint takes only what is new."""
    (stream.writeStream.format("parquet").outputMode(mode)
     .option("path", path).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def capacity_stream(readings: DataFrame, devices: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly capacity per region from a telemetry stream; an hour is emitted once it can no longer change.

    The state holds one row per open hour and region. Distinct devices are a sketch, because an exact
    distinct count would keep every device key in the state.
    """
    enrolled = devices.where("is_vpp_enrolled").select("customer_key", "region")
    timed = readings.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)
    return (timed.join(enrolled, "customer_key")
            .groupBy(F.window("event_time", "1 hour").alias("w"), "region")
            .agg(F.count("*").alias("readings"),
                 F.approx_count_distinct("customer_key").alias("approx_active_devices"),
                 total("battery_soc_pct").alias("total_battery_soc"),
                 total("solar_yield_kw").alias("total_solar_yield_kw"),
                 total("grid_import_export_kw").alias("net_grid_kw"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "region", "readings",
                    "approx_active_devices", "total_battery_soc", "total_solar_yield_kw", "net_grid_kw"))


def device_set_stream(readings: DataFrame, devices: DataFrame, delay: str = "2 hours") -> DataFrame:
    """The set of enrolled customers per hour and region from a telemetry stream, as ``device_sets`` gives it for a table.

    The state holds one bounded sketch per open hour and region; stored hours merge to days without reading a row again.
    """
    enrolled = devices.where("is_vpp_enrolled").select("customer_key", "region")
    timed = readings.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)
    return (timed.join(enrolled, "customer_key").groupBy(F.window("event_time", "1 hour").alias("w"), "region")
            .agg(members("customer_key").alias("members"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "region", "members"))


def priced_stream(readings: DataFrame, hourly_prices: DataFrame) -> DataFrame:
    """Each reading of the stream with the price of its hour, NULL where none is known."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return readings.withColumn("hour", hour).join(hourly_prices, "hour", "left")


def deduplicated_stream(readings: DataFrame, keys: list[str], delay: str = "2 hours") -> DataFrame:
    """Drop redelivered rows that arrive within the delay of their first copy."""
    timed = readings.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("event_time")


def route_late(stream: DataFrame, path: str, checkpoint: str, delay: str = "2 hours") -> None:
    """Store on-time rows below ``path``/on_time and late ones below ``path``/late; nothing is dropped.

    A row is late if it is older than the newest time of all earlier batches less ``delay``, as with a watermark. Every
    batch keeps its newest time and writes folders of its own number, so a batch that is replayed finds the same mark
    and replaces what it wrote. Rows without a time are late.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        before = None
        if batch_id > 0:
            marks = spark.read.schema("newest long, routed_batch long").parquet(f"{path}/marks")
            before = marks.where(F.col("routed_batch") < batch_id).agg(F.max("newest")).first()[0]
        limit = F.timestamp_micros(F.lit(before).cast("bigint")) - F.expr(f"interval {delay}")
        late = F.coalesce(F.col("ts").cast("timestamp") < limit, F.col("ts").isNull())
        batch.where(~late).write.mode("overwrite").parquet(f"{path}/on_time/routed_batch={batch_id}")
        batch.where(late).write.mode("overwrite").parquet(f"{path}/late/routed_batch={batch_id}")
        newest = batch.agg(F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{path}/marks/routed_batch={batch_id}")
        batch.unpersist()

    (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def routed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What ``route_late`` stored, with a column ``late``."""
    parts = [spark.read.schema(schema).parquet(f"{path}/{name}").drop("routed_batch").withColumn("late", F.lit(name == "late"))
             for name in ("on_time", "late")]
    return parts[0].unionByName(parts[1])


def upsert_available(stream: DataFrame, path: str, checkpoint: str, keys: list[str], partition_column: str,
                     newest_by: str) -> None:
    """Upsert each micro-batch by key; of several rows for a key the newest stays, whatever their order.

    A replayed batch writes the same rows again, so nothing doubles.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        upsert_partitions(batch, path, keys, partition_column, newest_by=newest_by)

    (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
