"""Registered queries on ownership, devices, telemetry and arbitrage."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from wattloom.operators import arbitrage, devices, prices, sketches, telemetry
from wattloom.operators.accounts import share_of_total
from wattloom.plans import models, questions
from wattloom.session import store
from wattloom.sources.testdata import HEATPUMP, SOLAR


def _bands(d):
    return prices.price_bands(d["market_prices"], exact=True)


def _margins(d, grain="hour"):
    return arbitrage.arbitrage_margins(
        d["telemetry"], d["devices"], d["market_prices"], price_grain=grain, exact_bands=True)


@query("G8 W1 J3", "SELECT * FROM customer_products", "customer_products")
def first_acquisitions(d):
    return d["customer_products"]


@query("G7 A5 F9 F10 F11 P2 P3 P4", "SELECT * FROM registry", "registry")
def device_registry(d):
    return d["device_registry"]


@query("G1 J1 P1", "SELECT * FROM devices", "devices")
def devices_enriched(d):
    return d["devices"]


@query("A6", """
    SELECT count(*) AS devices, CAST(count_if(is_vpp_enrolled) AS BIGINT) AS vpp_enrolled FROM registry""", "registry")
def enrolment_summary(d):
    return devices.enrolment_summary(d["device_registry"])


@query("B7", """
    SELECT region, count(*) AS devices, CAST(count_if(is_vpp_enrolled) AS BIGINT) AS enrolled FROM devices GROUP BY 1""",
       "devices")
def enrolled_by_region(d):
    return devices.enrolled_by_region(d["devices"])


@query("U3", """
    SELECT CAST(count_if(a) AS BIGINT) AS first_owners, CAST(count_if(b) AS BIGINT) AS second_owners,
           CAST(count_if(a AND b) AS BIGINT) AS both_owners, CAST(count_if(a AND NOT b) AS BIGINT) AS only_first
    FROM (SELECT customer_key, bool_or(category_name = 'PROMO') AS a, bool_or(category_name = 'ECONOMY') AS b
          FROM customer_products GROUP BY 1)""", "customer_products")
def owner_overlap(d):
    return devices.ownership_overlap(d["customer_products"], SOLAR, HEATPUMP)


@query("U3", """
    SELECT CAST(count_if(a) AS BIGINT) AS n_first, CAST(count_if(b) AS BIGINT) AS n_second, CAST(count_if(a AND b) AS BIGINT) AS n_both,
           CAST(count_if(a OR b) AS BIGINT) AS n_either, CAST(count_if(a AND NOT b) AS BIGINT) AS n_first_only
    FROM (SELECT customer_key, coalesce(bool_or(category_name = 'PROMO'), false) AS a, coalesce(bool_or(category_name = 'ECONOMY'), false) AS b
          FROM customer_products GROUP BY 1)""", "customer_products")
def owner_set_overlap(d):
    """The overlap of owners from one stored set per category, without grouping by customer."""
    sets = d["customer_products"].groupBy("category_name").agg(sketches.members("customer_key").alias("members"))
    return sketches.set_overlap(store(sets, "sets"), "category_name", SOLAR, HEATPUMP)


TURNOVER_SQL = """
    SELECT day, region, count(*) AS active, CAST(count_if(known) AS BIGINT) AS returning, CAST(count_if(NOT known) AS BIGINT) AS new,
           coalesce(any_value(n_before), 0) - CAST(count_if(known) AS BIGINT) AS gone
    FROM (SELECT a.*, b.customer_key IS NOT NULL AS known, s.n_before
          FROM seen a LEFT JOIN seen b ON b.customer_key = a.customer_key AND b.region = a.region AND b.day = a.day - 1
          LEFT JOIN (SELECT day, region, count(*) AS n_before FROM seen GROUP BY 1, 2) s ON s.region = a.region AND s.day = a.day - 1)
    GROUP BY 1, 2"""


@query("A2 U3", """
    SELECT * FROM (WITH seen AS MATERIALIZED (SELECT DISTINCT CAST(hour AS DATE) AS day, region, customer_key FROM customer_hours
                               JOIN devices USING (customer_key) WHERE is_vpp_enrolled)""" + TURNOVER_SQL + ")", "customer_hours devices")
def device_turnover(d):
    """Days merged from stored hourly sets; regions have fewer customers here than a set holds exactly."""
    return sketches.day_turnover(store(sketches.device_sets(d["telemetry"], d["devices"]), "sets"))


@query("J11", """
    SELECT customer_key, customer_name, city FROM customer_dim
    WHERE customer_key IN (SELECT customer_key FROM customer_products WHERE category_name = 'PROMO')""",
       "customer_dim customer_products")
def solar_owners(d):
    return devices.owners_only(d["customer_dim"], d["customer_products"], SOLAR).select(
        "customer_key", "customer_name", "city")


@query("J12", """
    SELECT customer_key, customer_name, city FROM customer_dim
    WHERE customer_key NOT IN (SELECT customer_key FROM customer_products WHERE category_name = 'ECONOMY')""",
       "customer_dim customer_products")
def customers_without_heatpump(d):
    return devices.non_owners_only(d["customer_dim"], d["customer_products"], HEATPUMP).select(
        "customer_key", "customer_name", "city")


@query("A9", """
    SELECT region, city, customers, CAST(customers AS DOUBLE) / CAST(sum(customers) OVER (PARTITION BY region) AS DOUBLE)
             AS share_of_region
    FROM (SELECT state AS region, city, count(*) AS customers FROM customer_dim GROUP BY 1, 2)""", "customer_dim")
def city_weights(d):
    counts = d["customer_dim"].groupBy(F.col("state").alias("region"), "city").agg(F.count("*").alias("customers"))
    return share_of_total(counts, "customers", "share_of_region", within=["region"])


@query("A8", "SELECT DISTINCT city FROM customer_dim", "customer_dim")
def distinct_cities(d):
    return d["customer_dim"].select("city").distinct()


@query("G2 J2", """
    SELECT ts, t.gateway_id, t.customer_key, customer_name, city, region, customer_type, is_vpp_enrolled,
           CAST(solar_yield_kw AS DOUBLE) AS solar_yield_kw, CAST(battery_soc_pct AS DOUBLE) AS battery_soc_pct,
           CAST(heatpump_consumption_kw AS DOUBLE) AS heatpump_consumption_kw,
           CAST(grid_import_export_kw AS DOUBLE) AS grid_import_export_kw
    FROM telemetry t JOIN devices d ON t.customer_key = d.customer_key""", "telemetry devices")
def telemetry_enriched(d):
    return telemetry.enrich_readings(d["telemetry"], d["devices"])


@query("G5 A2", """
    SELECT hour, region, count(*) AS active_vpp_devices,
           CAST(CAST(sum(soc) AS DECIMAL(18,1)) AS DOUBLE) AS total_battery_soc,
           CAST(CAST(CAST(CAST(sum(soc) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS DECIMAL(28,10)) AS DECIMAL(18,1)) AS DOUBLE)
             AS avg_battery_soc_pct,
           CAST(CAST(sum(solar) AS DECIMAL(18,2)) AS DOUBLE) AS total_solar_yield_kw,
           CAST(CAST(CAST(CAST(sum(solar) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS DECIMAL(28,10)) AS DECIMAL(18,2)) AS DOUBLE)
             AS avg_solar_yield_kw,
           CAST(CAST(sum(grid) AS DECIMAL(18,2)) AS DOUBLE) AS net_grid_kw
    FROM customer_hours JOIN devices USING (customer_key) WHERE is_vpp_enrolled GROUP BY 1, 2""",
       "customer_hours devices")
def capacity_hourly(d):
    return telemetry.capacity_hourly(d["telemetry"], d["devices"])


@query("A1 P10", """
    SELECT hour, customer_key, n AS readings, CAST(import_kwh AS DOUBLE) AS import_kwh,
           CAST(export_kwh AS DOUBLE) AS export_kwh FROM customer_hours""", "customer_hours")
def import_export_split(d):
    return telemetry.hourly_customer_totals(d["telemetry"]).select(
        "hour", "customer_key", "readings", "import_kwh", "export_kwh")


@query("P7", """
    SELECT CAST(hour(ts) AS BIGINT) AS hour_of_day, count(*) AS readings, CAST(sum(solar_yield_kw) AS DOUBLE) AS solar_kw
    FROM telemetry WHERE hour(ts) BETWEEN 6 AND 20 GROUP BY 1""", "telemetry")
def daylight_yield(d):
    return (d["telemetry"].where(F.hour("ts").between(6, 20)).groupBy(F.hour("ts").alias("hour_of_day"))
            .agg(F.count("*").alias("readings"), F.sum("solar_yield_kw").alias("solar_kw")))


@query("J6 F16", """
    SELECT customer_key, gateway_id, CAST(31 * 24 AS BIGINT) AS hours, TIMESTAMP '2024-01-01 00:00:00' AS first_hour,
           TIMESTAMP '2024-01-31 23:00:00' AS last_hour FROM devices""", "devices")
def device_hour_spine(d):
    spine = telemetry.device_hours(d["devices"].select("customer_key", "gateway_id"), "2024-01-01", "2024-01-31")
    return spine.groupBy("customer_key", "gateway_id").agg(
        F.count("*").alias("hours"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))


@query("DQ5 S14 J12", """
    SELECT d.customer_key, 30 * 24 - count(h.hour) AS missing_hours
    FROM devices d LEFT JOIN customer_hours h ON h.customer_key = d.customer_key
     AND h.hour BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-30 23:00:00'
    GROUP BY 1 HAVING count(h.hour) < 720""", "devices customer_hours")
def coverage_gaps(d):
    gaps = telemetry.coverage_gaps(d["telemetry"], d["devices"], "2024-01-01", "2024-01-30")
    return gaps.groupBy("customer_key").agg(F.count("*").alias("missing_hours"))


@query("DQ5 S14 A7", """
    SELECT customer_key, gateway_id, min(hour) AS first_hour, max(hour) AS last_hour, count(*) AS missing_hours
    FROM (SELECT *, hour - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY customer_key ORDER BY hour) AS island
          FROM (SELECT d.customer_key, d.gateway_id, s.hour
                FROM devices d, (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00',
                                                               INTERVAL 1 HOUR)) AS hour) s
                WHERE NOT EXISTS (SELECT 1 FROM customer_hours h WHERE h.customer_key = d.customer_key AND h.hour = s.hour)))
    GROUP BY customer_key, gateway_id, island""", "devices customer_hours")
def coverage_islands(d):
    """Masks of two loads, by even and odd customers and an overlap, merged."""
    readings = d["telemetry"]
    loads = readings.where("customer_key % 2 = 0"), readings.where("customer_key % 2 = 1 or customer_key % 3 = 0")
    masks = telemetry.merged_masks(*map(telemetry.hour_masks, loads))
    return telemetry.gap_islands(masks, d["devices"], "2024-01-01", "2024-01-30")


@query("A7 F3", """
    SELECT count(*) AS telemetry_records, CAST(min(ts) AS DATE) AS earliest_date, CAST(max(ts) AS DATE) AS latest_date,
           CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 AS BIGINT) AS days_covered
    FROM telemetry""", "telemetry")
def telemetry_coverage(d):
    return telemetry.coverage_summary(d["telemetry"])


@query("S14 X3", """
    SELECT CAST(day AS DATE) AS day_to_load
    FROM (SELECT unnest(generate_series(CAST(max(ts) AS DATE) + 1, DATE '2024-02-05', INTERVAL 1 DAY)) AS day
          FROM telemetry)""", "telemetry")
def backfill_days(d):
    return telemetry.backfill_days(d["telemetry"], "2024-02-05")


@query("B21 M14", """
    SELECT region, CAST(sum(solar) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_solar_yield,
           CAST(sum(solar) AS DOUBLE) AS total_solar_yield
    FROM customer_hours JOIN devices USING (customer_key) GROUP BY 1""", "customer_hours devices")
def solar_by_region(d):
    return telemetry.solar_by_region(d["telemetry"], d["devices"])


@query("B23 M16", """
    SELECT CAST(hour(hour) AS BIGINT) AS hour_of_day, CAST(sum(grid) AS DOUBLE) AS net_grid_flow,
           CAST(sum(export_kwh) AS DOUBLE) AS export_kwh
    FROM customer_hours JOIN devices USING (customer_key) WHERE is_vpp_enrolled GROUP BY 1""", "customer_hours devices")
def grid_flow_by_hour(d):
    return telemetry.grid_flow_by_hour(d["telemetry"], d["devices"])


@query("K5", """
    SELECT customer_key, soc_zone, readings,
           CAST(readings AS DOUBLE) / CAST(sum(readings) OVER (PARTITION BY customer_key) AS DOUBLE) AS dwell_share
    FROM (SELECT customer_key, CASE WHEN battery_soc_pct < 10 THEN 'deep_discharge_guard'
                   WHEN battery_soc_pct < 30 THEN 'own_reserve' WHEN battery_soc_pct < 90 THEN 'fleet_usable'
                   ELSE 'top_buffer' END AS soc_zone, count(*) AS readings
          FROM telemetry GROUP BY 1, 2)""", "telemetry")
def soc_zone_dwell(d):
    return telemetry.soc_zone_dwell(d["telemetry"])


@query("K6", """
    SELECT customer_key, CAST(year(ts) AS BIGINT) AS year,
           CAST(sum(coalesce(abs(battery_soc_pct - before), 0)) AS DOUBLE) / 200 AS full_cycles,
           CAST(sum(coalesce(abs(battery_soc_pct - before), 0)) AS DOUBLE) / 200 > 250 AS over_limit
    FROM (SELECT *, lag(battery_soc_pct) OVER (PARTITION BY customer_key ORDER BY ts, battery_soc_pct) AS before
          FROM telemetry) GROUP BY 1, 2""", "telemetry")
def full_cycles(d):
    return telemetry.full_cycles(d["telemetry"])


@query("K7", """
    SELECT CASE WHEN hour(ts) IN (6, 7, 8) THEN 'morning' WHEN hour(ts) IN (11, 12, 13) THEN 'midday'
                WHEN hour(ts) IN (17, 18, 19, 20) THEN 'evening' ELSE 'other' END AS demand_window,
           count(*) AS readings, CAST(sum(grid_import_export_kw) AS DOUBLE) / count(*) AS avg_grid_kw,
           CAST(sum(battery_soc_pct) AS DOUBLE) / count(*) AS avg_battery_soc_pct,
           CAST(sum(solar_yield_kw) AS DOUBLE) AS solar_kw
    FROM telemetry GROUP BY 1""", "telemetry")
def demand_window_profile(d):
    return telemetry.demand_window_profile(d["telemetry"])


@query("K12", """
    SELECT customer_key, day, CAST(solar AS DOUBLE) AS solar_kwh, CAST(exported AS DOUBLE) AS export_kwh,
           CAST(greatest(solar - exported, 0) AS DOUBLE) / CAST(solar AS DOUBLE) AS self_consumption_share
    FROM (SELECT customer_key, CAST(hour AS DATE) AS day, CAST(sum(solar) AS DECIMAL(18,4)) AS solar,
                 CAST(sum(export_kwh) AS DECIMAL(18,4)) AS exported FROM customer_hours GROUP BY 1, 2)
    WHERE solar > 0""", "customer_hours")
def self_consumption(d):
    return telemetry.self_consumption(d["telemetry"])


@query("B29 M15 M17", """
    SELECT CAST(sum(soc) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_battery_soc, CAST(sum(n) AS BIGINT) AS reading_count
    FROM customer_hours JOIN devices USING (customer_key) WHERE is_vpp_enrolled""", "customer_hours devices")
def fleet_mean_soc(d):
    return questions.fleet_mean_soc(d)


@query("M0 M14 M15 M16 M17", """
    SELECT region, CAST(sum(solar) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_solar_yield,
           CAST(sum(solar) AS DOUBLE) AS total_solar_yield,
           CAST(sum(soc) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_battery_soc,
           CAST(sum(heat) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_heatpump_consumption,
           CAST(sum(grid) AS DOUBLE) AS net_grid_flow, CAST(sum(n) AS BIGINT) AS reading_count
    FROM customer_hours LEFT JOIN devices USING (customer_key) GROUP BY 1""", "customer_hours devices")
def telemetry_metrics(d):
    return models.telemetry_model(d).query(
        ["avg_solar_yield", "total_solar_yield", "avg_battery_soc", "avg_heatpump_consumption", "net_grid_flow",
         "reading_count"], ["region"])


@query("B9", """
    SELECT round(corr(CAST(soc AS DOUBLE) / n, price_eur_mwh), 6) AS soc_price_corr, count(*) AS hours
    FROM fleet_soc JOIN zones USING (hour)""", "fleet_soc zones")
def soc_price_correlation(d):
    found = arbitrage.soc_price_correlation(questions.soc_and_price(d))
    return found.select(F.round("soc_price_corr", 6).alias("soc_price_corr"), "hours")


@query("B9", """
    SELECT price_zone, CAST(sum(soc) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_battery_soc_pct, count(*) AS hours
    FROM fleet_soc JOIN zones USING (hour) GROUP BY 1""", "fleet_soc zones")
def soc_by_price_zone(d):
    return arbitrage.soc_by_zone(questions.soc_and_price(d))


@query("B10", """
    SELECT hour, CAST(soc AS DOUBLE) / n AS avg_battery_soc_pct, price_eur_mwh
    FROM fleet_soc LEFT JOIN hourly_prices USING (hour)
    WHERE hour >= TIMESTAMP '2024-01-29' AND hour < TIMESTAMP '2024-01-30'""", "fleet_soc hourly_prices")
def last_day_series(d):
    return questions.last_day_series(d, "2024-01-30 00:00:00")


@query("B24", """
    SELECT CAST(sum(soc) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_battery_soc_pct, count(*) AS hours
    FROM fleet_soc JOIN zones USING (hour) WHERE price_eur_mwh < 0""", "fleet_soc zones")
def soc_in_negative_hours(d):
    return questions.soc_in_negative_hours(d)


@query("G6 A1 J4 J5 P8 P9 P11 F8", "SELECT * EXCLUDE (grain) FROM margins WHERE grain = 'hour'", "margins")
def arbitrage_hourly(d):
    return _margins(d)


@query("G6 J4", "SELECT * EXCLUDE (grain) FROM margins WHERE grain = 'interval'", "margins")
def arbitrage_interval(d):
    return _margins(d, "interval")


ZONE_SQL = """
    SELECT price_zone, count(*) AS device_hours,
           CAST(sum(CAST(net_margin_eur AS DECIMAL(18,4))) AS DOUBLE) AS net_margin_eur,
           CAST(sum(CAST(customer_margin_eur AS DECIMAL(18,4))) AS DOUBLE) AS customer_margin_eur,
           CAST(sum(CAST(operator_margin_eur AS DECIMAL(18,4))) AS DOUBLE) AS operator_margin_eur
    FROM margins WHERE grain = 'hour' GROUP BY 1"""


@query("B11", ZONE_SQL, "margins")
def margin_by_zone(d):
    return arbitrage.margin_by_zone(_margins(d))


@query("B12", """
    SELECT *, avg_daily_customer_eur * 365 AS annual_customer_eur, avg_daily_operator_eur * 365 AS annual_operator_eur
    FROM (SELECT CAST(sum(c) AS DOUBLE) / count(*) AS avg_daily_customer_eur,
                 CAST(sum(o) AS DOUBLE) / count(*) AS avg_daily_operator_eur
          FROM (SELECT customer_key, CAST(hour AS DATE) AS day, sum(CAST(customer_margin_eur AS DECIMAL(18,4))) AS c,
                       sum(CAST(operator_margin_eur AS DECIMAL(18,4))) AS o
                FROM margins WHERE grain = 'hour' GROUP BY 1, 2))""", "margins")
def daily_customer_value(d):
    return arbitrage.daily_customer_value(_margins(d))


PLAN_SQL = """
    SELECT dispatch_zone, hour, d.customer_key, d.gateway_id, d.is_vpp_enrolled, price_eur_mwh, CAST(soc_min AS DOUBLE) AS soc_min,
           CAST(soc_max AS DOUBLE) AS soc_max, CAST(grid_min_kw AS DOUBLE) AS grid_min_kw,
           CAST(grid_max_kw AS DOUBLE) AS grid_max_kw
    FROM (SELECT d.*, h.hour, z.price_eur_mwh,
                 CASE WHEN NOT is_vpp_enrolled THEN 'NOT_ENROLLED' ELSE coalesce(price_zone, 'NO_PRICE_DATA') END AS dispatch_zone
          FROM devices d CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{} 00:00:00', TIMESTAMP '{} 23:00:00',
                                                                   INTERVAL 1 HOUR)) AS hour) h
          LEFT JOIN zones z ON z.hour = h.hour WHERE has_battery) d
    JOIN dispatch_bands USING (dispatch_zone)"""


@query("P12 J6 J7", "SELECT dispatch_zone, customer_key, count(*) AS hours, min(hour) AS first_hour, max(hour) AS last_hour, "
       "min(soc_min) AS soc_min, max(soc_max) AS soc_max, min(price_eur_mwh) AS lowest_price FROM ("
       + PLAN_SQL.format("2024-01-01", "2024-01-31") + ") GROUP BY 1, 2", "devices zones dispatch_bands")
def dispatch_plan(d):
    """A month's plan: hours per device and zone, with the limits that apply."""
    plan = arbitrage.dispatch_plan(d["devices"], d["market_prices"], _bands(d), "2024-01-01", "2024-01-31")
    return plan.groupBy("dispatch_zone", "customer_key").agg(
        F.count("*").alias("hours"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"),
        F.min("soc_min").alias("soc_min"), F.max("soc_max").alias("soc_max"),
        F.min("price_eur_mwh").alias("lowest_price"))


@query("P12 J6 J7", PLAN_SQL.format("2024-01-29", "2024-01-30"), "devices zones dispatch_bands")
def dispatch_plan_two_days(d):
    """Every device and hour of the last priced day and the unpriced day after it."""
    return arbitrage.dispatch_plan(d["devices"], d["market_prices"], _bands(d), "2024-01-29", "2024-01-30")


@query("DQ6", """
    SELECT dispatch_zone, count(*) AS readings,
           CAST(count_if(battery_soc_pct BETWEEN soc_min AND soc_max) AS DOUBLE) / count(*) AS soc_conformance,
           CAST(count_if(grid_import_export_kw BETWEEN grid_min_kw AND grid_max_kw) AS DOUBLE) / count(*) AS grid_conformance
    FROM (SELECT t.*, CASE WHEN NOT is_vpp_enrolled THEN 'NOT_ENROLLED' ELSE coalesce(price_zone, 'NO_PRICE_DATA') END
                   AS dispatch_zone
          FROM telemetry t JOIN devices d ON t.customer_key = d.customer_key AND has_battery
          LEFT JOIN zones z ON z.hour = date_trunc('hour', ts)) JOIN dispatch_bands USING (dispatch_zone)
    GROUP BY 1""", "telemetry devices zones dispatch_bands")
def dispatch_conformance(d):
    return arbitrage.dispatch_conformance(d["telemetry"], d["devices"], d["market_prices"], _bands(d))


@query("K4", """
    SELECT customer_key, year, 50.0::DOUBLE AS base_pay_eur, CAST(CAST(kwh * 0.05 AS DECIMAL(18,4)) AS DOUBLE) AS energy_pay_eur,
           CAST(CAST(saving * 0.50 AS DECIMAL(18,4)) AS DOUBLE) AS bonus_eur,
           CAST(CAST(kwh * 0.05 + saving * 0.50 + 50 AS DECIMAL(18,4)) AS DOUBLE) AS total_pay_eur
    FROM (SELECT customer_key, CAST(year(hour) AS BIGINT) AS year,
                 CAST(sum(CAST(total_export_kwh AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS kwh,
                 CAST(sum(CASE WHEN price_eur_mwh < 0 THEN abs(CAST(import_cost_eur AS DECIMAL(18,4))) ELSE 0 END)
                   AS DECIMAL(18,4)) AS saving
          FROM margins WHERE grain = 'hour' GROUP BY 1, 2)""", "margins")
def participation_pay(d):
    return arbitrage.participation_pay(_margins(d))
