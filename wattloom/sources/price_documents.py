"""Day-ahead price documents: raw ingest, re-run safety, missing days, delivery-day bucketing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.clock import local_time, unix_to_utc
from wattloom.schemas import PRICE_DOCUMENT

MARKET_ZONE = "Europe/Berlin"
ROLLOVER_HOUR = 22  # local hour from which an interval belongs to the next delivery day


def read_price_documents(spark: SparkSession, path: str) -> DataFrame:
    """One raw document per file; the delivery day is the last date in the file's path."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"))
    return files.select(
        F.current_timestamp().alias("fetch_timestamp"),
        F.try_to_date(F.regexp_extract("file_path", r"^.*(\d{4}-\d{2}-\d{2})", 1)).alias("fetch_date"),
        F.col("value").alias("raw_data"))


def parsed(raw_data: Column | str = "raw_data") -> Column:
    return F.from_json(raw_data, PRICE_DOCUMENT)


def field(document: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(document, f"$.{name}", kind)


def each(document: Column, name: str, kind: str) -> Column:
    """A list of a document; elements of another kind are NULL, what is no list is NULL."""
    return F.transform(field(document, name, "array<variant>"), lambda x: F.try_variant_get(x, "$", kind))


def document_fields(raw: DataFrame) -> Column:
    """The fields of a document, from the stored variant or, where there is none, from its text."""
    if "document" not in raw.columns:
        return parsed()
    document = F.col("document")
    return F.struct(
        field(document, "license_info", "string").alias("license_info"), each(document, "unix_seconds", "bigint").alias("unix_seconds"),
        each(document, "price", "double").alias("price"), field(document, "unit", "string").alias("unit"),
        field(document, "deprecated", "boolean").alias("deprecated"))


def checked_documents(raw: DataFrame) -> DataFrame:
    """Raw documents with ``document``, their content as a variant with every field they came with, and ``problem``, NULL for usable ones."""
    read = raw.withColumn("document", F.try_parse_json("raw_data"))
    times, prices = each(F.col("document"), "unix_seconds", "bigint"), field(F.col("document"), "price", "array<variant>")
    problem = (F.when(F.col("fetch_date").isNull(), "no day")
               .when(F.col("document").isNull(), "not JSON")
               .when(~F.coalesce(F.exists(times, lambda t: t.isNotNull()), F.lit(False)), "no times")
               .when(prices.isNull(), "no prices"))
    return read.withColumn("problem", problem)


def usable(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("problem").isNull()).drop("problem", "raw_data")


def quarantined(checked: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Documents that can't be used, with the reason, but for those that ``held`` has."""
    found = checked.where(F.col("problem").isNotNull()).select("fetch_timestamp", "fetch_date", "raw_data", "problem").withColumn(
        "content_hash", F.md5(F.coalesce("raw_data", F.lit(""))))
    found = found.dropDuplicates(["fetch_date", "content_hash"])
    if held is None:
        return found
    known = held.select(F.col("fetch_date").alias("_day"), F.col("content_hash").alias("_hash"))
    return found.join(known, F.col("fetch_date").eqNullSafe(F.col("_day")) & (F.col("content_hash") == F.col("_hash")), "left_anti")


def price_points(raw: DataFrame, described: bool = False) -> DataFrame:
    """One row per element of ``unix_seconds``, with the price at the same position.

    A price list that is too short gives NULL prices, one that is too long is cut to the times. The
    arrays are zipped first, so a row carries one pair and not the whole price list. ``described`` adds the document's licence, unit and deprecation.
    """
    documents = raw.select("fetch_timestamp", "fetch_date", document_fields(raw).alias("doc"))
    about = [F.struct("doc.license_info", "doc.unit", "doc.deprecated").alias("about")] if described else []
    times = F.col("doc.unix_seconds")
    prices = F.slice(F.coalesce(F.col("doc.price"), F.array().cast("array<double>")), F.lit(1), F.size(times))
    return (documents.where(times.isNotNull())
            .select("fetch_timestamp", "fetch_date", *about, F.posexplode(F.arrays_zip(
                times.alias("unix_seconds"), prices.alias("price"))).alias("position", "point"))
            .select("fetch_timestamp", "fetch_date", "position", *(["about"] if described else []),
                    F.col("point.unix_seconds").alias("unix_seconds"),
                    F.col("point.price").alias("price_eur_mwh"))
            .where(F.col("unix_seconds").isNotNull()))


def to_delivery_days(raw: DataFrame, rollover_hour: int = ROLLOVER_HOUR, zone: str = MARKET_ZONE) -> DataFrame:
    """Documents of any range to one document per delivery day.

    Points are first reduced to one per time (the later position wins), so the list that is collected
    for a day is never longer than the quarter hours of that day. Licence, unit and deprecation are those of the last document that gave a point.
    """
    local = local_time(unix_to_utc("unix_seconds"), zone)
    day = F.when(F.hour(local) >= rollover_hour, F.date_add(F.to_date(local), 1)).otherwise(F.to_date(local))
    points = (price_points(raw, described=True)
              .withColumn("delivery_day", day)
              .groupBy("delivery_day", "unix_seconds")
              .agg(F.max(F.struct("fetch_date", "position", "price_eur_mwh", "about")).alias("last")))
    sorted_points = F.array_sort(F.collect_list(F.struct("unix_seconds", F.col("last.price_eur_mwh").alias("price"))))
    latest = F.max(F.struct("last.fetch_date", "unix_seconds", "last.about")).alias("latest")
    days = points.groupBy("delivery_day").agg(sorted_points.alias("points"), latest).withColumn("about", F.col("latest.about"))
    document = F.struct(
        F.coalesce("about.license_info", F.lit("")).alias("license_info"),
        F.col("points.unix_seconds").alias("unix_seconds"),
        F.col("points.price").alias("price"),
        F.coalesce("about.unit", F.lit("EUR/MWh")).alias("unit"),
        F.coalesce("about.deprecated", F.lit(False)).alias("deprecated"))
    return days.select(
        F.col("delivery_day").alias("fetch_date"),
        F.to_json(document, {"ignoreNullFields": "false"}).alias("raw_data"))


def missing_days(existing: DataFrame, as_of: str, window_days: int = 60) -> DataFrame:
    """Days of the window that ends on ``as_of`` which no document covers."""
    spark = existing.sparkSession
    last = F.to_date(F.lit(as_of))
    window = spark.range(1).select(
        F.explode(F.sequence(F.date_sub(last, window_days - 1), last)).alias("fetch_date"))
    return window.join(existing.select("fetch_date").distinct(), "fetch_date", "left_anti")


def new_documents(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """One incoming document for each day that is not present yet, the last one fetched; running it twice adds nothing."""
    last = Window.partitionBy("fetch_date").orderBy(F.col("fetch_timestamp").desc_nulls_last(), F.desc(F.to_json("document") if "document" in incoming.columns else "raw_data"))
    one = incoming.withColumn("_turn", F.row_number().over(last)).where("_turn = 1").drop("_turn")
    return one if existing is None else one.join(existing.select("fetch_date").distinct(), "fetch_date", "left_anti")


def ingest_report(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    known = existing.select("fetch_date").distinct().withColumn("known", F.lit(True))
    return incoming.join(known, "fetch_date", "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"),
        F.count_if(F.col("known")).alias("skipped"))
