"""Battery arbitrage: margins by price zone, dispatch plan, conformance and participation pay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.clock import hour_of
from wattloom.functions.exact import mean, ratio, rounded, total, total_where
from wattloom.functions.zones import DISPATCH_BANDS, battery_action, dispatch_bands, price_zone
from wattloom.operators.prices import hourly_prices, per_kwh, price_bands
from wattloom.operators.telemetry import device_hours, hourly_customer_totals

# Split of the margin and the pay for taking part.
CUSTOMER_SHARE = 0.70
BASE_PAY_EUR_PER_YEAR = 50
PAY_EUR_PER_KWH = 0.05
NEGATIVE_PRICE_SHARE = 0.50


def with_bands(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Add the quartiles of the one-row band table as a scalar subquery, so that nothing is crossed."""
    return (df.withColumn("_bands", bands.select(F.struct("p25", "p75")).scalar())
            .select("*", F.col("_bands.p25").alias("p25"), F.col("_bands.p75").alias("p75")).drop("_bands"))


def zoned_prices(prices: DataFrame, bands: DataFrame) -> DataFrame:
    """Prices with their zone and the battery action that belongs to it."""
    price = F.col("price_eur_mwh")
    return (with_bands(prices, bands)
            .withColumn("price_zone", price_zone(price, F.col("p25"), F.col("p75")))
            .withColumn("battery_action", battery_action(price, F.col("p25"), F.col("p75")))
            .drop("p25", "p75"))


def arbitrage_margins(readings: DataFrame, devices: DataFrame, prices: DataFrame, *, price_grain: str = "hour",
                      bands: DataFrame | None = None, exact_bands: bool = False,
                      customer_share: float = CUSTOMER_SHARE) -> DataFrame:
    """Hourly margin of each enrolled customer.

    ``price_grain="hour"`` prices each hour with its mean price: one row per hour and customer.
    ``"interval"`` keeps every 15-minute price of the hour, so that an hour gives up to four rows which
    each price the full hour. ``bands`` fixes the quartiles from outside, for runs in increments.
    """
    bands = bands if bands is not None else price_bands(prices, exact=exact_bands)
    if price_grain == "hour":
        offered = hourly_prices(prices)
    elif price_grain == "interval":
        offered = prices.select(hour_of("start_time").alias("hour"), "price_eur_mwh",
                                per_kwh(F.col("price_eur_mwh")).alias("price_eur_kwh"))
    else:
        raise ValueError("price_grain is 'hour' or 'interval'")
    who = devices.where("is_vpp_enrolled").select("customer_key", "customer_name", "city", "region")
    hours = hourly_customer_totals(readings).join(who, "customer_key")
    rows = with_bands(hours.join(offered, "hour", "left"), bands)

    price, p25, p75 = F.col("price_eur_mwh"), F.col("p25"), F.col("p75")
    # narrow decimals keep every digit of the products
    paid = F.coalesce(F.col("price_eur_kwh").cast("decimal(10,4)"), F.lit(0).cast("decimal(10,4)"))
    cost, revenue = (F.col(kwh).cast("decimal(14,4)") * paid for kwh in ("import_kwh", "export_kwh"))
    share = F.lit(customer_share).cast("decimal(4,2)")
    return rows.select(
        "hour", "customer_key", "customer_name", "city", "region",
        _hour_mean("solar_yield_kw").alias("avg_solar_kw"),
        _hour_mean("battery_soc_pct").alias("avg_battery_soc_pct"),
        _hour_mean("heatpump_consumption_kw").alias("avg_heatpump_kw"),
        _hour_mean("grid_import_export_kw").alias("avg_grid_kw"),
        F.col("import_kwh").cast("double").alias("total_import_kwh"),
        F.col("export_kwh").cast("double").alias("total_export_kwh"),
        "price_eur_mwh", "price_eur_kwh",
        price_zone(price, p25, p75).alias("price_zone"),
        battery_action(price, p25, p75).alias("battery_action"),
        rounded(cost, 4).alias("import_cost_eur"),
        rounded(revenue, 4).alias("export_revenue_eur"),
        rounded(revenue - cost, 4).alias("net_margin_eur"),
        rounded((revenue - cost) * share, 4).alias("customer_margin_eur"),
        rounded((revenue - cost) * (F.lit(1) - share), 4).alias("operator_margin_eur"))


def margin_by_zone(margins: DataFrame) -> DataFrame:
    return margins.groupBy("price_zone").agg(
        F.count("*").alias("device_hours"),
        total("net_margin_eur").cast("double").alias("net_margin_eur"),
        total("customer_margin_eur").cast("double").alias("customer_margin_eur"),
        total("operator_margin_eur").cast("double").alias("operator_margin_eur"))


def daily_customer_value(margins: DataFrame) -> DataFrame:
    """Mean daily margin per customer, the operator's part, and both projected to a year."""
    per_day = margins.groupBy("customer_key", F.to_date("hour").alias("day")).agg(
        total("customer_margin_eur").alias("customer"), total("operator_margin_eur").alias("operator"))
    return per_day.agg(mean("customer").alias("avg_daily_customer_eur"), mean("operator").alias("avg_daily_operator_eur")) \
        .select("*", (F.col("avg_daily_customer_eur") * 365).alias("annual_customer_eur"),
                (F.col("avg_daily_operator_eur") * 365).alias("annual_operator_eur"))


def dispatch_plan(devices: DataFrame, prices: DataFrame, bands: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Charge and grid-flow limits for every battery device and hour.

    The zone of an hour is worked out once per hour; devices meet it through a join on the hour. Hours
    without a price and devices outside the fleet have bands of their own.
    """
    spine = device_hours(devices.where("has_battery").select("customer_key", "gateway_id", "is_vpp_enrolled"),
                         first_day, last_day)
    zones = zoned_prices(hourly_prices(prices), bands).select("hour", "price_eur_mwh", "price_zone")
    zone = (F.when(~F.col("is_vpp_enrolled"), "NOT_ENROLLED")
            .otherwise(F.coalesce("price_zone", F.lit("NO_PRICE_DATA"))))
    planned = spine.join(zones, "hour", "left").withColumn("dispatch_zone", zone).drop("price_zone")
    return planned.join(F.broadcast(dispatch_bands(planned.sparkSession)), "dispatch_zone")  # six fixed rows


def dispatch_conformance(readings: DataFrame, devices: DataFrame, prices: DataFrame, bands: DataFrame) -> DataFrame:
    """Share of readings inside the dispatch band, by zone.

    Readings collapse to a count per hour, customer, charge and flow only as far as needed: the bands
    depend on the hour and the enrolment, so each reading is tested against every band in its own scan
    task, and only the six counters per customer-hour travel.
    """
    soc, flow = F.col("battery_soc_pct"), F.col("grid_import_export_kw")
    tested = {zone: (soc.between(soc_min, soc_max), flow.between(flow_min, flow_max))
              for zone, soc_min, soc_max, flow_min, flow_max in DISPATCH_BANDS}
    counters = [F.count("*").alias("readings")]
    for name, (soc_in, flow_in) in tested.items():
        counters += [F.count_if(soc_in).alias(f"{name}_soc"), F.count_if(flow_in).alias(f"{name}_flow")]
    hours = readings.groupBy(hour_of("ts").alias("hour"), "customer_key").agg(*counters)
    who = devices.where("has_battery").select("customer_key", "is_vpp_enrolled")
    zones = zoned_prices(hourly_prices(prices), bands).select("hour", "price_zone")
    placed = hours.join(who, "customer_key").join(zones, "hour", "left").withColumn(
        "dispatch_zone", F.when(~F.col("is_vpp_enrolled"), "NOT_ENROLLED")
        .otherwise(F.coalesce("price_zone", F.lit("NO_PRICE_DATA"))))

    def of_zone(suffix: str) -> Column:
        return F.coalesce(*[F.when(F.col("dispatch_zone") == name, F.col(f"{name}_{suffix}")) for name in tested])

    return placed.groupBy("dispatch_zone").agg(
        F.sum("readings").alias("readings"),
        ratio(F.sum(of_zone("soc")), F.sum("readings")).alias("soc_conformance"),
        ratio(F.sum(of_zone("flow")), F.sum("readings")).alias("grid_conformance"))


def participation_pay(margins: DataFrame) -> DataFrame:
    """Pay per customer and year: a base sum, a rate per exported kWh, half of the negative-price saving.

    This is the programme's other pay model; it stands beside the split of the margin.
    """
    saving = total_where(F.col("price_eur_mwh") < 0, F.abs("import_cost_eur"))
    yearly = margins.groupBy("customer_key", F.year("hour").alias("year")).agg(
        total("total_export_kwh").alias("export_kwh"), saving.alias("saving"))
    pay = F.col("export_kwh") * F.lit(PAY_EUR_PER_KWH).cast("decimal(4,2)")
    bonus = F.col("saving") * F.lit(NEGATIVE_PRICE_SHARE).cast("decimal(4,2)")
    return yearly.select(
        "customer_key", "year", F.lit(BASE_PAY_EUR_PER_YEAR).cast("double").alias("base_pay_eur"),
        rounded(pay, 4).alias("energy_pay_eur"), rounded(bonus, 4).alias("bonus_eur"),
        rounded(pay + bonus + F.lit(BASE_PAY_EUR_PER_YEAR), 4).alias("total_pay_eur"))


def soc_and_price(fleet_soc: DataFrame, prices: DataFrame, bands: DataFrame) -> DataFrame:
    """Hourly fleet charge beside the hour's price and zone; hours without a price drop out."""
    return fleet_soc.join(zoned_prices(hourly_prices(prices), bands), "hour")


def soc_price_correlation(series: DataFrame) -> DataFrame:
    return series.agg(F.corr("avg_battery_soc_pct", "price_eur_mwh").alias("soc_price_corr"),
                      F.count("*").alias("hours"))


def soc_by_zone(series: DataFrame) -> DataFrame:
    return series.groupBy("price_zone").agg(
        ratio(F.sum("soc_sum"), F.sum("soc_n")).alias("avg_battery_soc_pct"), F.count("*").alias("hours"))


def _hour_mean(name: str) -> Column:
    return ratio(F.col(f"{name}_sum"), F.col(f"{name}_n"))
