import json
from datetime import date, datetime, timezone


def price_document(spark, *days):
    """Raw documents from (fetch_date, unix_seconds, price) triples."""
    rows = [(None, date.fromisoformat(day), json.dumps({
        "license_info": "", "unix_seconds": times, "price": prices, "unit": "EUR/MWh", "deprecated": False}))
        for day, times, prices in days]
    return spark.createDataFrame(rows, "fetch_timestamp timestamp, fetch_date date, raw_data string")


def unix(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def prices_at(spark, *rows):
    """Staged prices from (start, price) pairs."""
    data = [(date.fromisoformat(start[:10]), datetime.fromisoformat(start), price) for start, price in rows]
    return spark.createDataFrame(data, "fetch_date date, start_time timestamp_ntz, price_eur_mwh double")


def readings_at(spark, *rows):
    """Telemetry from (ts, customer, solar, soc, heat pump, grid) tuples."""
    data = [(datetime.fromisoformat(ts), f"GW-{customer:05d}", customer, *[None if v is None else float(v) for v in values])
            for ts, customer, *values in rows]
    return spark.createDataFrame(
        data, "ts timestamp_ntz, gateway_id string, customer_key long, solar_yield_kw double, battery_soc_pct double, "
              "heatpump_consumption_kw double, grid_import_export_kw double")


def fleet(spark, *rows):
    """Enriched devices from (customer, region, enrolled) tuples; all own a battery."""
    data = [(c, f"C{c}", "Town", region, "private", f"GW-{c:05d}", True, True, False, enrolled, None)
            for c, region, enrolled in rows]
    return spark.createDataFrame(
        data, "customer_key long, customer_name string, city string, region string, customer_type string, "
              "gateway_id string, has_solar boolean, has_battery boolean, has_heatpump boolean, "
              "is_vpp_enrolled boolean, enrollment_date date")


def by(df, *keys):
    """Rows as a dict from key (or key tuple) to row."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
