"""Product ownership and the device registry that follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.sampling import gateway_id, percent_bucket

# Category and product names that mark the hardware a customer owns.
SOLAR_CATEGORY = "Solar & Storage"
HEATPUMP_CATEGORY = "Heat Pumps"
BATTERY_PATTERN = "%Speicher%"
ENROLLED_PERCENT = 90
ENROLLMENT_DELAY_DAYS = 30


def first_acquisitions(contracts: DataFrame, products: DataFrame) -> DataFrame:
    """The first contract per customer and product, in sale order, becomes the ownership row.

    Written as a minimum per key instead of a ranked window: it combines before the shuffle, so a
    customer with a large share of all contracts does not end up sorted in one task.
    """
    first = contracts.groupBy("customer_key", "product_key").agg(
        F.min_by("date", "sale_id").alias("acquisition_date"),
        F.min_by(F.col("status") == "Active", "sale_id").alias("active"))  # a flag keeps the hash aggregate
    return (first.join(products.select("product_key", "category_name"), "product_key", "left")
            .select("customer_key", "product_key", "category_name", "acquisition_date",
                    F.when(F.col("active"), "Active").otherwise("Inactive").alias("status")))


def device_registry(ownership: DataFrame, products: DataFrame, solar_category: str = SOLAR_CATEGORY,
                    heatpump_category: str = HEATPUMP_CATEGORY, battery_pattern: str = BATTERY_PATTERN,
                    enrolled_percent: int = ENROLLED_PERCENT) -> DataFrame:
    """One row per customer that owns hardware, with its flags, gateway and fleet enrolment."""
    hardware = (ownership.where(F.col("status") == "Active")
                .join(products.select("product_key", "product_name"), "product_key", "left")
                .groupBy("customer_key")
                .agg(F.bool_or(F.col("category_name") == solar_category).alias("has_solar"),
                     F.coalesce(F.bool_or(F.col("product_name").like(battery_pattern)), F.lit(False))
                     .alias("has_battery"),
                     F.bool_or(F.col("category_name") == heatpump_category).alias("has_heatpump"),
                     F.min("acquisition_date").alias("first_acquisition")))
    enrolled = F.col("has_battery") & (percent_bucket(F.col("customer_key")) < enrolled_percent)
    return (hardware.where(F.col("has_solar") | F.col("has_battery") | F.col("has_heatpump"))
            .select("customer_key", gateway_id(F.col("customer_key")).alias("gateway_id"),
                    "has_solar", "has_battery", "has_heatpump", enrolled.alias("is_vpp_enrolled"),
                    F.when(enrolled, F.date_add("first_acquisition", ENROLLMENT_DELAY_DAYS))
                    .alias("enrollment_date")))


def enrich_devices(registry: DataFrame, customers: DataFrame) -> DataFrame:
    """Registry rows with the customer's name, city, region and type."""
    who = customers.select("customer_key", "customer_name", "city", F.col("state").alias("region"), "customer_type")
    return registry.join(who, "customer_key").select(
        "customer_key", "customer_name", "city", "region", "customer_type", "gateway_id",
        "has_solar", "has_battery", "has_heatpump", "is_vpp_enrolled", "enrollment_date")


def enrolled_by_region(devices: DataFrame) -> DataFrame:
    return devices.groupBy("region").agg(
        F.count("*").alias("devices"), F.count_if("is_vpp_enrolled").alias("enrolled"))


def enrolment_summary(registry: DataFrame) -> DataFrame:
    return registry.agg(F.count("*").alias("devices"), F.count_if("is_vpp_enrolled").alias("vpp_enrolled"))


def owners_of(ownership: DataFrame, category: str) -> DataFrame:
    return ownership.where(F.col("category_name") == category).select("customer_key").distinct()


def owners_only(df: DataFrame, ownership: DataFrame, category: str) -> DataFrame:
    return df.join(owners_of(ownership, category), "customer_key", "left_semi")


def non_owners_only(df: DataFrame, ownership: DataFrame, category: str) -> DataFrame:
    return df.join(owners_of(ownership, category), "customer_key", "left_anti")


def ownership_overlap(ownership: DataFrame, first: str, second: str) -> DataFrame:
    """How many customers own the first category, the second, both, or only one of them."""
    per_customer = ownership.groupBy("customer_key").agg(
        F.bool_or(F.col("category_name") == first).alias("a"), F.bool_or(F.col("category_name") == second).alias("b"))
    return per_customer.agg(
        F.count_if("a").alias("first_owners"), F.count_if("b").alias("second_owners"),
        F.count_if(F.col("a") & F.col("b")).alias("both_owners"),
        F.count_if(F.col("a") & ~F.col("b")).alias("only_first"))
