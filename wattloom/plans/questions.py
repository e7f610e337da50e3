"""The catalog of business questions, each one parameterised query over the domain tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattloom.operators import arbitrage, prices as price_ops, telemetry
from wattloom.operators.accounts import heavy_users, share_of_total
from wattloom.plans import models

Tables = Mapping[str, DataFrame]


def equals(value):
    return lambda column: column == value


def one_of(*values):
    return lambda column: column.isin(*values)


def in_year(year: int):
    return lambda date: (date >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & \
        (date < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1)))


def in_month(first_day: str):
    start = F.to_date(F.lit(first_day))
    return lambda date: (date >= start) & (date < F.add_months(start, 1))


def in_quarter(first_day: str):
    start = F.to_date(F.lit(first_day))
    return lambda date: (date >= start) & (date < F.add_months(start, 3))


def top(df: DataFrame, by: str, *ties: str, k: int) -> DataFrame:
    """Largest ``k`` rows, equal values ordered by the tie columns."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def top_per_group(df: DataFrame, group: str, by: str, *ties: str, k: int) -> DataFrame:
    """Largest ``k`` rows of each group with their rank. Each task keeps ``k`` rows a group before the shuffle, so a hot group
    sends no more rows than any other."""
    order = W.partitionBy(group).orderBy(F.desc_nulls_last(by), *ties)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# sales


def top_products(t: Tables, year: int, k: int = 5) -> DataFrame:
    sales = models.sales_model(t).query(
        ["total_revenue"], ["product_key", "product_name"], where={"contract_date": in_year(year)})
    return top(sales, "total_revenue", "product_key", k=k)


def top_products_by_region(t: Tables, role: str = "contract", k: int = 5) -> DataFrame:
    """Best-selling products of each region, by the contract's or the customer's region."""
    sales = models.sales_model(t).query(["total_revenue"], [f"{role}:region_name", "product_key"])
    return top_per_group(sales, f"{role}_region_name", "total_revenue", "product_key", k=k)


def sales_by_region_roles(t: Tables) -> DataFrame:
    """Revenue by where a contract was signed and where its customer lives."""
    return models.sales_model(t).query(["total_revenue", "total_contracts"], ["contract:region_name", "customer:region_name"])


def customer_segments(t: Tables) -> DataFrame:
    both = models.sales_model(t).query(["customer_count", "total_revenue"], ["customer_type"])
    return share_of_total(both, "total_revenue", "revenue_share")


def best_region(t: Tables, category: str, k: int = 1) -> DataFrame:
    sales = models.sales_model(t).query(
        ["total_revenue"], ["region_name"], where={"category_name": equals(category)})
    return top(sales, "total_revenue", "region_name", k=k)


def monthly_contracts(t: Tables, year: int) -> DataFrame:
    return models.sales_model(t).query(
        ["total_contracts"], ["contract_month"], where={"contract_date": in_year(year)})


def contract_value(t: Tables, *categories: str) -> DataFrame:
    return models.sales_model(t).query(
        ["avg_contract_value"], ["category_name"], where={"category_name": one_of(*categories)})


def region_sales(t: Tables, month: str) -> DataFrame:
    return models.sales_model(t).query(
        ["total_revenue", "total_contracts"], ["region_name"], where={"contract_date": in_month(month)})


def best_sellers(t: Tables, month: str, k: int = 5) -> DataFrame:
    sold = models.sales_model(t).query(
        ["total_units", "total_contracts"], ["product_key", "product_name"],
        where={"contract_date": in_month(month)})
    return top(sold, "total_units", "product_key", k=k)


# billing and consumption


def owner_consumption(t: Tables, category: str) -> DataFrame:
    """Mean bill consumption of customers with and without products of a category."""
    energy = models.customer_energy_model(t)
    has = {"category_name": equals(category)}
    with_it = energy.query(["avg_consumption", "total_invoices"], where=has)
    without = energy.query(["avg_consumption", "total_invoices"], without=has)
    return (with_it.withColumn("owner_group", F.lit("with"))
            .unionByName(without.withColumn("owner_group", F.lit("without"))))


def heavy_user_list(t: Tables, min_kwh: int) -> DataFrame:
    return heavy_users(t["billing_history"], min_kwh)


def top_owner_consumption(t: Tables, category: str, k: int = 10) -> DataFrame:
    used = models.customer_energy_model(t).query(
        ["total_consumption"], ["customer_key"], where={"category_name": equals(category)})
    return top(used, "total_consumption", "customer_key", k=k)


def quarter_leaders(t: Tables, quarter_start: str, billing_type: str = "Electricity", k: int = 10) -> DataFrame:
    used = models.billing_model(t).query(
        ["total_consumption"], ["customer_key"],
        where={"billing_date": in_quarter(quarter_start), "billing_type": equals(billing_type)})
    return top(used, "total_consumption", "customer_key", k=k)


def payment_status_split(t: Tables) -> DataFrame:
    counted = models.billing_model(t).query(["total_invoices", "total_billing_amount"], ["payment_status"])
    return share_of_total(counted, "total_invoices", "invoice_share")


def city_owner_consumption(t: Tables, city: str, category: str) -> DataFrame:
    return models.customer_energy_model(t).query(
        ["avg_consumption", "total_invoices"], ["city"],
        where={"city": equals(city), "category_name": equals(category)})


# service


def complaint_topics(t: Tables, negative: str, k: int = 10) -> DataFrame:
    counted = models.service_model(t, negative).query(
        ["total_tickets"], ["topic"], where={"sentiment": equals(negative)})
    return top(counted, "total_tickets", "topic", k=k)


def topic_tickets(t: Tables, topic: str, sentiment: str) -> DataFrame:
    return (t["service_logs"].where((F.col("topic") == topic) & (F.col("sentiment") == sentiment))
            .select("log_id", "customer_key", "log_date", "topic", "priority"))


# workforce


def headcount_and_attrition(t: Tables) -> DataFrame:
    staff = models.workforce_model(t).query(["headcount", "attrition_count"], ["department_name"])
    rate = F.try_divide(F.col("attrition_count").cast("double"), F.col("headcount").cast("double"))
    return staff.withColumn("attrition_rate", rate)


def department_salaries(t: Tables) -> DataFrame:
    return models.workforce_model(t).query(["avg_salary", "total_salary"], ["department_name"])


# market and fleet


def recent_prices(t: Tables, as_of: str, days: int = 7) -> DataFrame:
    return price_ops.price_range_by_day(t["market_prices"], as_of, days)


def fleet_mean_soc(t: Tables) -> DataFrame:
    return models.telemetry_model(t).query(
        ["avg_battery_soc", "reading_count"], where={"is_vpp_enrolled": lambda flag: flag})


def soc_and_price(t: Tables) -> DataFrame:
    """Hourly fleet charge with price and zone, the base of the correlation questions."""
    bands = price_ops.price_bands(t["market_prices"], exact=True)
    return arbitrage.soc_and_price(telemetry.fleet_soc_by_hour(t["telemetry"], t["devices"]), t["market_prices"], bands)


def last_day_series(t: Tables, until: str) -> DataFrame:
    """Charge and price of the 24 hours that end at ``until``, in time order."""
    end = F.lit(until).cast("timestamp_ntz")
    recent = t["telemetry"].where((F.col("ts") >= end - F.expr("INTERVAL 24 HOURS")) & (F.col("ts") < end))
    soc = telemetry.fleet_soc_by_hour(recent, t["devices"])
    return (soc.join(price_ops.hourly_prices(t["market_prices"]), "hour", "left")
            .select("hour", "avg_battery_soc_pct", "price_eur_mwh").orderBy("hour"))


def soc_in_negative_hours(t: Tables) -> DataFrame:
    series = soc_and_price(t).where(F.col("price_eur_mwh") < 0)
    return series.agg(F.try_divide(F.sum("soc_sum").cast("double"), F.sum("soc_n").cast("double"))
                      .alias("avg_battery_soc_pct"), F.count("*").alias("hours"))
