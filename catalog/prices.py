"""Registered price queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from wattloom.operators import arbitrage, prices, sketches
from wattloom.plans import models, questions
from wattloom.plans.refresh import bands_by_day
from wattloom.session import scratch_path, store
from wattloom.sources import price_documents as docs


def _described(documents):
    """Number, span and sum of the entries of each document."""
    parsed = documents.select("fetch_date", docs.parsed().alias("doc"))
    points = F.aggregate("doc.price", F.lit(0).cast("decimal(18,4)"),
                         lambda acc, p: (acc + p.cast("decimal(18,4)")).cast("decimal(18,4)"))
    return parsed.select("fetch_date", F.size("doc.unix_seconds").alias("entries"),
                         F.array_min("doc.unix_seconds").alias("first_unix"),
                         F.array_max("doc.unix_seconds").alias("last_unix"), points.alias("price_sum"), "doc.unit")


@query("S4 F12 F13", """
    SELECT fetch_date, count(*) AS entries, min(unix_seconds) AS first_unix, max(unix_seconds) AS last_unix,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) AS price_sum, 'EUR/MWh' AS unit
    FROM market_prices GROUP BY 1""", "market_prices")
def price_documents(d):
    return _described(d["raw_day_ahead_prices"])


@query("S7 F6 X2", """
    SELECT day AS fetch_date, count(*) AS entries, min(unix_seconds) AS first_unix, max(unix_seconds) AS last_unix,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) AS price_sum, 'EUR/MWh' AS unit
    FROM (SELECT *, CAST(berlin AS DATE) + CASE WHEN hour(berlin) >= 22 THEN 1 ELSE 0 END AS day
          FROM (SELECT *, start_time AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin' AS berlin FROM market_prices))
    GROUP BY 1""", "market_prices")
def delivery_day_documents(d):
    return _described(docs.to_delivery_days(d["raw_day_ahead_prices"]))


@query("S4 S5 F12", """
    SELECT problem, count(*) AS documents, CAST(sum(CASE WHEN problem = 'usable' THEN entries ELSE 0 END) AS BIGINT) AS entries
    FROM (SELECT CASE WHEN day(fetch_date) % 7 = 3 THEN 'not JSON' WHEN day(fetch_date) % 7 = 5 THEN 'no prices' ELSE 'usable' END AS problem, entries
          FROM (SELECT fetch_date, count(*) AS entries FROM market_prices GROUP BY 1)) GROUP BY 1""", "market_prices")
def price_file_report(d):
    """Price documents written as one file a day, some cut off or without prices, read back and checked."""
    folder = scratch_path(d.spark, "price-files")
    turn = F.dayofmonth("fetch_date") % 7
    broken = (F.when(turn == 3, F.expr("left(raw_data, length(raw_data) - 9)"))
              .when(turn == 5, F.replace("raw_data", F.lit('"price"'), F.lit('"cost"'))).otherwise(F.col("raw_data")))
    d["raw_day_ahead_prices"].select(broken.alias("value"), "fetch_date").repartition("fetch_date").write.partitionBy("fetch_date").text(folder)
    checked = docs.checked_documents(docs.read_price_documents(d.spark, f"{folder}/*"))
    return checked.groupBy(F.coalesce("problem", F.lit("usable")).alias("problem")).agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.when(F.col("problem").isNull(), F.size(docs.each(F.col("document"), "unix_seconds", "bigint")))), F.lit(0)).alias("entries"))


@query("S6 U2 J12", """
    SELECT CAST(day AS DATE) AS fetch_date
    FROM generate_series(TIMESTAMP '2023-12-13', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) AS s(day)
    WHERE CAST(day AS DATE) NOT IN (SELECT fetch_date FROM market_prices)""", "market_prices")
def missing_price_days(d):
    return docs.missing_days(d["raw_day_ahead_prices"], "2024-02-10")


@query("S5 X1 X2", """
    SELECT CAST(count_if(fetch_date > DATE '2024-01-15') AS BIGINT) AS inserted,
           CAST(count_if(fetch_date <= DATE '2024-01-15') AS BIGINT) AS skipped
    FROM (SELECT DISTINCT fetch_date FROM market_prices)""", "market_prices")
def price_ingest_report(d):
    loaded_before = d["raw_day_ahead_prices"].where("fetch_date <= date'2024-01-15'")
    return docs.ingest_report(loaded_before, d["raw_day_ahead_prices"])


@query("S5", "SELECT DISTINCT fetch_date FROM market_prices WHERE fetch_date > DATE '2024-01-15'", "market_prices")
def price_days_to_insert(d):
    loaded_before = d["raw_day_ahead_prices"].where("fetch_date <= date'2024-01-15'")
    return docs.new_documents(loaded_before, d["raw_day_ahead_prices"]).select("fetch_date")


@query("G3 J8 F2 F5", "SELECT fetch_date, start_time, end_time, price_eur_mwh FROM market_prices", "market_prices")
def staged_prices(d):
    return d["market_prices"].drop("fetch_timestamp")


@query("G4 F1 F4 F7", """
    SELECT fetch_date, start_time, end_time, price_eur_mwh,
           CAST(CAST(CAST(price_eur_mwh AS DECIMAL(18,6)) * 0.001 AS DECIMAL(18,4)) AS DOUBLE) AS price_eur_kwh,
           date_trunc('hour', start_time) AS hour, left(dayname(start_time), 3) AS day_of_week,
           CAST(hour(start_time) AS BIGINT) AS hour_of_day
    FROM market_prices""", "market_prices")
def price_mart(d):
    return d["prices_mart"]


@query("A3", """
    SELECT p25, p75, (SELECT CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) FROM market_prices)
             AS avg_price FROM bands""", "bands market_prices")
def price_bands(d):
    return prices.price_bands(d["market_prices"], exact=True)


@query("A3", """
    SELECT quantile_disc(price_eur_mwh, 0.25) AS p25, quantile_disc(price_eur_mwh, 0.75) AS p75,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price FROM market_prices""",
       "market_prices")
def price_bands_sketch(d):
    """The sketch holds 10,000 values, more than the month has intervals, so it still answers exactly."""
    return prices.price_bands(d["market_prices"])


@query("A3", """
    SELECT p25, p75, CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price
    FROM (SELECT price_eur_mwh, quantile_disc(price_eur_mwh, 0.25) OVER () AS p25, quantile_disc(price_eur_mwh, 0.75) OVER () AS p75
          FROM market_prices) GROUP BY 1, 2""", "market_prices")
def price_bands_by_day(d):
    """Stored day sketches after two refreshes: the second reads the days from the 20th on only, one of them again."""
    path = scratch_path(d.spark, "quantiles")
    staged = store(d["market_prices"].withColumn("price_day", F.to_date("start_time")), "staged")
    before = staged.where("start_time < timestamp_ntz'2024-01-20 10:00:00'")
    bands_by_day(before, before, path)
    return bands_by_day(staged, staged.where("price_day >= date'2024-01-20'"), path)


@query("A3", """
    SELECT CAST(date_trunc('month', start_time) AS DATE) AS month, count(*) AS intervals, quantile_disc(price_eur_mwh, 0.1) AS p10,
           quantile_disc(price_eur_mwh, 0.5) AS median_price, quantile_disc(price_eur_mwh, 0.9) AS p90,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price
    FROM market_prices GROUP BY 1""", "market_prices")
def price_month_quantiles(d):
    """Months merged from stored day sketches; a month has fewer intervals than a sketch holds, so it answers exactly."""
    months = sketches.merged_quantiles(store(sketches.day_quantiles(d["market_prices"]), "quantiles"), F.trunc("price_day", "month").alias("month"))
    return months.select("month", "intervals", sketches.quantile("quantiles", 0.1).alias("p10"), sketches.quantile("quantiles", 0.5).alias("median_price"),
                         sketches.quantile("quantiles", 0.9).alias("p90"), (F.col("price_sum").cast("double") / F.col("intervals")).alias("avg_price"))


@query("A4 F1", "SELECT * FROM hourly_prices", "hourly_prices")
def hourly_prices(d):
    return prices.hourly_prices(d["market_prices"])


@query("P8 P9 J5", """
    SELECT price_zone, battery_action, count(*) AS intervals
    FROM (SELECT CASE WHEN price_eur_mwh IS NULL THEN 'NO_PRICE_DATA' WHEN price_eur_mwh < 0 THEN 'NEGATIVE'
                      WHEN price_eur_mwh < p25 THEN 'LOW' WHEN price_eur_mwh > p75 THEN 'HIGH' ELSE 'MEDIUM' END AS price_zone,
                 CASE WHEN price_eur_mwh IS NULL THEN 'SELF_CONSUME' WHEN price_eur_mwh < 0 THEN 'MAX_CHARGE'
                      WHEN price_eur_mwh < p25 THEN 'CHARGE' WHEN price_eur_mwh > p75 THEN 'DISCHARGE'
                      ELSE 'SELF_CONSUME' END AS battery_action
          FROM market_prices, bands) GROUP BY 1, 2""", "market_prices bands")
def price_zones(d):
    zoned = arbitrage.zoned_prices(d["market_prices"], prices.price_bands(d["market_prices"], exact=True))
    return zoned.groupBy("price_zone", "battery_action").agg(F.count("*").alias("intervals"))


@query("DQ5", """
    SELECT fetch_date, count(*) AS intervals, 96 - count(*) AS missing_intervals FROM market_prices
    GROUP BY 1 HAVING count(*) <> 96""", "market_prices")
def incomplete_price_days(d):
    return prices.incomplete_days(d["market_prices"])


@query("B8 P6", """
    SELECT CAST(start_time AS DATE) AS price_day, min(price_eur_mwh) AS min_price, max(price_eur_mwh) AS max_price,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price
    FROM market_prices WHERE CAST(start_time AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-29' GROUP BY 1""",
       "market_prices")
def price_range_last_week(d):
    return questions.recent_prices(d, "2024-01-29", 7)


@query("B22 L4", """
    SELECT CAST(start_time AS DATE) AS price_day, max(price_eur_mwh) AS max_price,
           arg_max(start_time, (price_eur_mwh, -epoch_us(start_time))) AS peak_start
    FROM market_prices WHERE CAST(start_time AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1""",
       "market_prices")
def highest_prices(d):
    return prices.highest_prices(d["market_prices"], "2024-01-30", 30)


@query("K1", """
    SELECT CAST(date_trunc('month', hour) AS DATE) AS month, CAST(count_if(price_eur_mwh < 0) AS BIGINT) AS negative_hours,
           min(price_eur_mwh) AS lowest_price FROM hourly_prices GROUP BY 1""", "hourly_prices")
def negative_hours_by_month(d):
    return prices.negative_hours_by_month(d["market_prices"])


@query("K2", """
    SELECT CAST(hour AS DATE) AS price_day,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(28,9))) AS DOUBLE) / count(*) AS baseload,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(28,9))) FILTER (hour(hour) BETWEEN 8 AND 19) AS DOUBLE)
             / nullif(count(*) FILTER (hour(hour) BETWEEN 8 AND 19), 0) AS peakload
    FROM hourly_prices GROUP BY 1""", "hourly_prices")
def base_and_peak_load(d):
    return prices.base_and_peak_load(d["market_prices"])


@query("K3", """
    SELECT start_time, price_eur_mwh,
           CAST(CAST(CAST(price_eur_mwh AS DECIMAL(18,6)) * 0.1 AS DECIMAL(18,4)) AS DOUBLE) AS spot_ct_kwh,
           CAST(CAST(CAST(price_eur_mwh AS DECIMAL(18,6)) * 0.1 + 13.05 AS DECIMAL(18,4)) AS DOUBLE) AS end_price_ct_kwh
    FROM market_prices""", "market_prices")
def household_price(d):
    return prices.household_price(d["market_prices"])


@query("M0 M13", """
    SELECT CAST(start_time AS DATE) AS price_day,
           CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price,
           max(price_eur_mwh) AS max_price, min(price_eur_mwh) AS min_price FROM market_prices GROUP BY 1""",
       "market_prices")
def market_price_metrics(d):
    return models.market_price_model(d).query(["avg_price", "max_price", "min_price"], ["price_day"])


@query("A7", """
    SELECT count(DISTINCT fetch_date) AS total_days, min(fetch_date) AS earliest_date, max(fetch_date) AS latest_date
    FROM market_prices""", "market_prices")
def price_coverage(d):
    return d["raw_day_ahead_prices"].agg(
        F.count("*").alias("total_days"), F.min("fetch_date").alias("earliest_date"),
        F.max("fetch_date").alias("latest_date"))
