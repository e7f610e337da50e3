"""Registered queries on loading, storage, data checks and the daily refresh."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog.fleet import ZONE_SQL
from catalog.registry import query
from wattloom.operators import arbitrage, prices, quality, telemetry
from wattloom.plans.declared import MODEL_TESTS
from wattloom.plans.refresh import refresh
from wattloom.schemas import BATTERY_ACTIONS, DATE, INT, LONG, PRICE_ZONES, col, key, money, text
from wattloom.session import scratch_path
from wattloom.sources import csv_files, gateway, layers

ORDER_LINES = StructType([
    col("line_key", LONG, True), text("status", 12), col("order_date", DATE, True), money("amount", 12, True),
    col("priority", INT)])


def _order_file(d) -> str:
    """The orders as an untidy CSV folder: blanks, quotes, null words, bad numbers, short and long rows.

    Which flaw a row gets follows from its own columns, so the flaws grow with the table.
    """
    o = d.source("orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    number = F.substring("o_orderpriority", 1, 1)
    line = (F.when(F.col("o_orderstatus") == "P", F.concat_ws(",", "o_orderkey", F.lit(" N/A "), day, price, number))
            .when(F.col("o_orderpriority") == "1-URGENT",
                  F.concat_ws(",", "o_orderkey", F.lit('"a, ""b"""'), day, F.lit("12x"), number))
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat_ws(",", "o_orderkey", "o_orderstatus", day, price))
            .when(F.col("o_orderpriority") == "3-MEDIUM",
                  F.concat_ws(",", "o_orderkey", F.lit('  "x, y"'), day, price, number, F.lit("extra")))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
                  F.concat_ws(",", "o_orderkey", "o_orderpriority", day, price, number))
            .otherwise(F.concat_ws(",", "o_orderkey", "o_orderstatus", F.lit("null"), price, number)))
    path = scratch_path(d.spark, "orders-csv")
    o.select(line).write.text(path)
    return path


def _checked_orders(d):
    return csv_files.read_csv_checked(d.spark, _order_file(d), ORDER_LINES, header=False)


# the flaw of each order and what the loader must make of it
FLAWS = """
    WITH flawed AS (
      SELECT o_orderkey AS line_key, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
             CAST(left(o_orderpriority, 1) AS BIGINT) AS number, o_orderstatus AS code,
             CASE WHEN o_orderstatus = 'P' THEN 'null_word' ELSE left(o_orderpriority, 1) END AS flaw FROM orders)
"""


@query("S1 F11", FLAWS + """
    SELECT line_key, CASE flaw WHEN 'null_word' THEN NULL WHEN '3' THEN 'x, y' ELSE code END AS status, day AS order_date,
           CAST(price AS DOUBLE) AS amount, CASE WHEN flaw <> '2' THEN number END AS priority
    FROM flawed WHERE flaw IN ('null_word', '2', '3')""")
def csv_load(d):
    return csv_files.loaded_rows(_checked_orders(d))


@query("S2", FLAWS + """
    SELECT 'order_lines' AS table_name, count(*) AS rows_parsed,
           CAST(count_if(flaw IN ('null_word', '2', '3')) AS BIGINT) AS rows_loaded,
           CAST(count_if(flaw NOT IN ('null_word', '2', '3')) AS BIGINT) AS rows_rejected FROM flawed""")
def csv_load_report(d):
    return csv_files.load_report({"order_lines": _checked_orders(d)})


@query("S1 DQ7", FLAWS + """
    SELECT CASE flaw WHEN '1' THEN 'amount: not a decimal(12,2)' WHEN '4' THEN 'status: too long'
                     ELSE 'order_date: missing' END AS _reject_reason, count(*) AS rows_rejected
    FROM flawed WHERE flaw NOT IN ('null_word', '2', '3') GROUP BY 1""")
def csv_reject_reasons(d):
    return csv_files.reject_reasons(_checked_orders(d))


TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
               "conversations").split()


@query("S3 U1 L1", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLE_NAMES))
def row_counts(d):
    return layers.row_counts({name: d.source(name) for name in TABLE_NAMES})


@query("S15", """
    SELECT gateway_id, ts, CAST(battery_soc_pct AS DOUBLE) AS battery_soc_pct, 0.0::DOUBLE AS battery_power_kw,
           CAST(solar_yield_kw AS DOUBLE) AS solar_yield_kw, CAST(grid_import_export_kw AS DOUBLE) AS grid_import_export_kw,
           CAST(heatpump_consumption_kw AS DOUBLE) AS heatpump_consumption_kw, true AS online, true AS vpp_enabled,
           CAST(NULL AS VARCHAR) AS error_code FROM telemetry""", "telemetry")
def gateway_flatten(d):
    return gateway.flatten_messages(d["gateway_messages"])


def _prices_until(prices, day: str):
    staged = prices.withColumn("price_day", F.to_date("start_time"))
    return staged.where(F.col("price_day") <= F.lit(day).cast("date"))


@query("S11 Q-2", """
    SELECT fetch_date, start_time, price_eur_mwh FROM market_prices WHERE fetch_date > DATE '2024-01-20'""",
       "market_prices")
def prices_after_high_water(d):
    stored = _prices_until(d["market_prices"], "2024-01-20")
    return layers.after_high_water(d["market_prices"], stored, "fetch_date").select(
        "fetch_date", "start_time", "price_eur_mwh")


@query("T5", """
    SELECT start_time, price_eur_mwh FROM every_price WHERE CAST(start_time AS DATE) = DATE '2024-01-10'""",
       "every_price")
def late_price_rows(d):
    """10 January arrives after the 20th was stored: a plain append would lose it. Every hour counts."""
    stored = _prices_until(d["every_price"], "2024-01-20").where("price_day <> date'2024-01-10'")
    return layers.late_rows(d["every_price"], stored, "fetch_date", ["start_time"]).select(
        "start_time", "price_eur_mwh")


@query("S9 S10 S12", """
    SELECT start_time, CASE WHEN CAST(start_time AS DATE) >= DATE '2024-01-20' THEN price_eur_mwh + 1 ELSE price_eur_mwh END
             AS price_eur_mwh FROM market_prices""", "market_prices")
def upserted_prices(d):
    """Prices up to the 25th are stored; corrected ones from the 20th on replace and extend them."""
    columns = ["start_time", "price_eur_mwh", "price_day"]
    path = layers.layer_path(scratch_path(d.spark, "upsert"), "silver", "market_prices")
    layers.write_full(_prices_until(d["market_prices"], "2024-01-25").select(*columns), path, ("price_day",))
    corrected = (_prices_until(d["market_prices"], "2024-12-31").select(*columns).where("price_day >= date'2024-01-20'")
                 .withColumn("price_eur_mwh", F.col("price_eur_mwh") + 1))
    layers.upsert_partitions(corrected, path, ["start_time"], "price_day")
    return d.spark.read.parquet(path).select("start_time", "price_eur_mwh")


@query("S12 S13", """
    SELECT customer_key, CASE WHEN city = 'NATION_7' THEN 'moved' ELSE city END AS city,
           CASE WHEN city = 'NATION_7' THEN 'checked' END AS note FROM customer_dim""", "customer_dim")
def merged_with_new_column(d):
    """The update adds ``note`` and no longer has ``customer_name``; unmatched rows follow its layout."""
    stored = d["customer_dim"].select("customer_key", "customer_name", "city")
    moved = stored.where("city = 'NATION_7'").select("customer_key", F.lit("moved").alias("city"),
                                                     F.lit("checked").alias("note"))
    return layers.merge_rows(stored, moved, ["customer_key"])


def _test_sql(table: str, source: str, column: str, test) -> str:
    """One declared test as SQL that counts."""
    head = f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
    if test == quality.NOT_NULL:
        return head + f"""'not_null' AS test, count(*) AS failing_rows, least(count(*), 1) AS failing_values
    FROM {source} WHERE {column} IS NULL"""
    if test == quality.UNIQUE:
        return head + f"""'unique' AS test, CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows, count(*) AS failing_values
    FROM (SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""
    values = ", ".join(f"'{v}'" for v in test)
    return head + f"""'accepted_values' AS test, count(*) AS failing_rows, count(DISTINCT {column}) AS failing_values
    FROM {source} WHERE {column} NOT IN ({values})"""


TESTED = {
    "staged_prices": "market_prices", "price_mart": "market_prices", "devices": "devices", "telemetry": "telemetry",
    "capacity_hourly": "(SELECT DISTINCT hour, region FROM customer_hours JOIN devices USING (customer_key) WHERE is_vpp_enrolled)",
    "arbitrage": "(SELECT * FROM margins WHERE grain = 'hour')", "order_lines": "lineitem"}

#: What the models promise, and some promises that the test tables break.
DECLARED = {**MODEL_TESTS, "order_lines": {"l_orderkey": (quality.UNIQUE, quality.NOT_NULL), "l_returnflag": (("A", "N"),)}}


@query("DQ1 DQ2 DQ3", " UNION ALL ".join(
    _test_sql(table, TESTED[table], column, test) for table, columns in DECLARED.items() for column, tests in columns.items() for test in tests),
       "market_prices devices telemetry customer_hours margins")
def declared_tests(d):
    """The column tests of every model, one row each. Regions of the test tables have other names than the listed ones, so that test fails."""
    margins = arbitrage.arbitrage_margins(d["telemetry"], d["devices"], d["market_prices"], exact_bands=True)
    tables = {"staged_prices": d["market_prices"], "price_mart": d["prices_mart"], "devices": d["devices"], "telemetry": d["telemetry"],
              "capacity_hourly": telemetry.capacity_hourly(d["telemetry"], d["devices"]), "arbitrage": margins, "order_lines": d.source("lineitem")}
    return quality.declared_report(tables, DECLARED)


@query("DQ1", """
    SELECT 'market_prices' AS table_name, c.column_name, CAST(0 AS BIGINT) AS null_rows
    FROM (VALUES ('start_time'), ('end_time'), ('price_eur_mwh')) AS c(column_name)
    UNION ALL SELECT 'devices', c.column_name, CAST(CASE c.column_name WHEN 'enrollment_date'
                THEN (SELECT count_if(enrollment_date IS NULL) FROM devices) ELSE 0 END AS BIGINT)
    FROM (VALUES ('customer_key'), ('gateway_id'), ('is_vpp_enrolled'), ('enrollment_date')) AS c(column_name)
    UNION ALL SELECT 'arbitrage', c.column_name, CAST(CASE c.column_name WHEN 'price_eur_mwh'
                THEN (SELECT count_if(price_eur_mwh IS NULL) FROM margins WHERE grain = 'hour') ELSE 0 END AS BIGINT)
    FROM (VALUES ('hour'), ('customer_key'), ('price_eur_mwh')) AS c(column_name)""", "devices margins")
def null_report(d):
    margins = arbitrage.arbitrage_margins(d["telemetry"], d["devices"], d["market_prices"], exact_bands=True)
    return (quality.null_counts(d["market_prices"], "market_prices", ["start_time", "end_time", "price_eur_mwh"])
            .unionByName(quality.null_counts(d["devices"], "devices", [
                "customer_key", "gateway_id", "is_vpp_enrolled", "enrollment_date"]))
            .unionByName(quality.null_counts(margins, "arbitrage", ["hour", "customer_key", "price_eur_mwh"])))


@query("DQ2", """
    SELECT 'market_prices' AS table_name, CAST(0 AS BIGINT) AS duplicate_keys UNION ALL
    SELECT 'devices', (SELECT count(*) FROM (SELECT gateway_id FROM devices GROUP BY 1 HAVING count(*) > 1)) UNION ALL
    SELECT 'sales_lines', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2
                                                 HAVING count(*) > 1))""", "devices")
def uniqueness_report(d):
    return quality.uniqueness_report({
        "market_prices": (d["market_prices"], ["start_time"]),
        "devices": (d["devices"], ["gateway_id"]),
        "sales_lines": (d.source("lineitem"), ["l_orderkey", "l_linenumber"])})


@query("DQ3", """
    SELECT 'payment_status' AS column_name, payment_status AS value, count(*) AS rows FROM billing_history
    WHERE payment_status NOT IN ('paid', 'open') GROUP BY 2""", "billing_history")
def unexpected_values(d):
    """Zones and actions of the margins must be known; the bills show one status outside the short list."""
    zoned = arbitrage.zoned_prices(d["market_prices"], prices.price_bands(d["market_prices"], exact=True))
    checked = [("price_zone", zoned, PRICE_ZONES), ("battery_action", zoned, BATTERY_ACTIONS),
               ("payment_status", d["billing_history"], ("paid", "open"))]
    found = [quality.unexpected_values(df, name, accepted)
             .select(F.lit(name).alias("column_name"), F.col(name).alias("value"), "rows")
             for name, df, accepted in checked]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("DQ4 J12", """
    SELECT 'sales to customer' AS reference, count(*) AS orphan_rows, count(DISTINCT customer_key) AS orphan_keys
    FROM sales_fact WHERE customer_key NOT IN (SELECT customer_key FROM customer_dim) UNION ALL
    SELECT 'sales to product', count(*), count(DISTINCT product_key) FROM sales_fact
    WHERE product_key NOT IN (SELECT product_key FROM product_dim) UNION ALL
    SELECT 'telemetry to device', count(*), count(DISTINCT customer_key) FROM telemetry
    WHERE customer_key NOT IN (SELECT customer_key FROM devices) UNION ALL
    SELECT 'bill to device', count(*), count(DISTINCT customer_key) FROM billing_history
    WHERE customer_key NOT IN (SELECT customer_key FROM devices)""",
       "sales_fact customer_dim product_dim telemetry devices billing_history")
def orphan_report(d):
    return quality.orphan_report({
        "sales to customer": (d["sales_fact"], "customer_key", d["customer_dim"], "customer_key"),
        "sales to product": (d["sales_fact"], "product_key", d["product_dim"], "product_key"),
        "telemetry to device": (d["telemetry"], "customer_key", d["devices"], "customer_key"),
        "bill to device": (d["billing_history"], "customer_key", d["devices"], "customer_key")})


@query("DQ7", """
    SELECT 'customers' AS table_name, v.column_name, CAST(0 AS BIGINT) AS missing,
           CASE v.column_name WHEN 'c_mktsegment' THEN (SELECT CAST(count_if(length(c_mktsegment) > 8) AS BIGINT) FROM customer)
                ELSE 0 END AS too_long
    FROM (VALUES ('c_custkey'), ('c_name'), ('c_mktsegment')) AS v(column_name)""")
def layout_violations(d):
    layout = StructType([key("c_custkey"), text("c_name", 200, True), text("c_mktsegment", 8)])
    return quality.layout_violations(d.source("customer"), "customers", layout)


@query("X5 S9 S10 S11 S12 G6", ZONE_SQL, "margins")
def daily_refresh(d):
    """Two refreshes, up to the 20th and up to the end, must give the margins of one full run."""
    root = scratch_path(d.spark, "layers")
    bands = prices.price_bands(d["market_prices"], exact=True)
    tables = {"customer_dim": d["customer_dim"], "device_registry": d["device_registry"]}
    first = {"raw_day_ahead_prices": d["raw_day_ahead_prices"].where("fetch_date <= date'2024-01-20'"),
             "telemetry": d["telemetry"].where("ts < timestamp_ntz'2024-01-21 00:00:00'")}
    refresh({**tables, **first}, root, bands)
    paths = refresh({**tables, "raw_day_ahead_prices": d["raw_day_ahead_prices"], "telemetry": d["telemetry"]},
                    root, bands)
    return arbitrage.margin_by_zone(d.spark.read.parquet(paths["arbitrage"]))
