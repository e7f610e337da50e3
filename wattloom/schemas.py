"""Column layouts of the bronze and gold tables, and the value domains the checks use."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

INT, LONG, DATE, DOUBLE, BOOL = IntegerType(), LongType(), DateType(), DoubleType(), BooleanType()


def col(name: str, dtype: DataType, required: bool = False) -> StructField:
    return StructField(name, dtype, not required)


def text(name: str, max_length: int, required: bool = False) -> StructField:
    """A string column with a length limit, which the file loader and the layout check enforce."""
    return StructField(name, StringType(), not required, {"max_length": max_length})


def key(name: str) -> StructField:
    return StructField(name, INT, False)


def money(name: str, precision: int = 12, required: bool = False) -> StructField:
    return StructField(name, DecimalType(precision, 2), not required)


# Table layouts that files must match.
TABLES: dict[str, StructType] = {
    "product_category_dim": StructType([
        key("category_key"), text("category_name", 100, True), text("vertical", 50, True)]),
    "product_dim": StructType([
        key("product_key"), text("product_name", 200, True), col("category_key", INT, True),
        text("category_name", 100), text("vertical", 50), money("capex_eur"), money("opex_eur_year", 10)]),
    "customer_dim": StructType([
        key("customer_key"), text("customer_name", 200, True), text("customer_type", 50),
        text("housing_type", 100), text("vertical", 50), text("address", 200), text("city", 100),
        text("state", 50), text("zip", 20), col("region_key", INT)]),
    "vendor_dim": StructType([
        key("vendor_key"), text("vendor_name", 200, True), text("vendor_type", 100), text("vertical", 50),
        text("address", 200), text("city", 100), text("state", 50), text("zip", 20)]),
    "account_dim": StructType([key("account_key"), text("account_name", 100, True), text("account_type", 50)]),
    "department_dim": StructType([key("department_key"), text("department_name", 100, True)]),
    "region_dim": StructType([key("region_key"), text("region_name", 100, True)]),
    "sales_rep_dim": StructType([key("sales_rep_key"), text("rep_name", 200, True), col("hire_date", DATE)]),
    "campaign_dim": StructType([key("campaign_key"), text("campaign_name", 300, True), text("objective", 100)]),
    "channel_dim": StructType([key("channel_key"), text("channel_name", 100, True)]),
    "employee_dim": StructType([
        key("employee_key"), text("employee_name", 200, True), text("gender", 1), col("hire_date", DATE)]),
    "job_dim": StructType([key("job_key"), text("job_title", 100, True), col("job_level", INT)]),
    "location_dim": StructType([key("location_key"), text("location_name", 200, True)]),
    "sales_fact": StructType([
        key("sale_id"), col("date", DATE, True), key("customer_key"), key("product_key"), key("sales_rep_key"),
        key("region_key"), key("vendor_key"), money("amount", 12, True), col("units", INT, True)]),
    "billing_history": StructType([
        key("billing_id"), key("customer_key"), col("billing_date", DATE, True), text("billing_type", 50, True),
        col("consumption_kwh", INT, True), money("amount", 10, True), text("payment_status", 50)]),
    "service_logs": StructType([
        key("log_id"), key("customer_key"), col("log_date", DATE, True), text("topic", 100, True),
        text("category", 100), text("description", 500), text("sentiment", 50), text("channel", 50),
        text("priority", 50), col("resolution_date", DATE), col("agent_key", INT)]),
    "finance_transactions": StructType([
        key("transaction_id"), col("date", DATE, True), key("account_key"), key("department_key"),
        key("vendor_key"), key("product_key"), key("customer_key"), money("amount", 12, True),
        text("approval_status", 20), text("procurement_method", 50), col("approver_id", INT),
        col("approval_date", DATE), text("purchase_order_number", 50), text("contract_reference", 100)]),
    "marketing_campaign_fact": StructType([
        key("campaign_fact_id"), col("date", DATE, True), key("campaign_key"), key("product_key"),
        key("channel_key"), key("region_key"), money("spend", 10, True), col("leads_generated", INT, True),
        col("impressions", INT, True)]),
    "hr_employee_fact": StructType([
        key("hr_fact_id"), col("date", DATE, True), key("employee_key"), key("department_key"), key("job_key"),
        key("location_key"), money("salary", 10, True), col("attrition_flag", INT, True)]),
    "customer_products": StructType([
        key("customer_product_id"), key("customer_key"), key("product_key"), key("category_key"),
        text("category_name", 100, True), col("acquisition_date", DATE, True), text("status", 20)]),
    "sf_accounts": StructType([
        text("account_id", 20, True), text("account_name", 200, True), key("customer_key"), text("industry", 100),
        text("vertical", 50), text("billing_street", 200), text("billing_city", 100), text("billing_state", 50),
        text("billing_postal_code", 20), text("account_type", 50), money("annual_revenue", 15),
        col("employees", INT), col("created_date", DATE)]),
    "sf_opportunities": StructType([
        text("opportunity_id", 20, True), col("sale_id", INT), text("account_id", 20, True),
        text("opportunity_name", 200, True), text("stage_name", 100, True), money("amount", 15, True),
        money("probability", 5), col("close_date", DATE), col("created_date", DATE), text("lead_source", 100),
        text("type", 100), col("campaign_id", INT)]),
    "sf_contacts": StructType([
        text("contact_id", 20, True), text("opportunity_id", 20, True), text("account_id", 20, True),
        text("first_name", 100), text("last_name", 100), text("email", 200), text("phone", 50), text("title", 100),
        text("department", 100), text("lead_source", 100), col("campaign_no", INT), col("created_date", DATE)]),
}

RAW_PRICES = StructType([
    col("fetch_timestamp", TimestampType()), col("fetch_date", DATE), col("raw_data", StringType())])

PRICE_DOCUMENT = StructType([
    col("license_info", StringType()),
    col("unix_seconds", ArrayType(LONG)),
    col("price", ArrayType(DOUBLE)),
    col("unit", StringType()),
    col("deprecated", BOOL),
])

DEVICE_REGISTRY = StructType([
    col("customer_key", INT), col("gateway_id", StringType()), col("has_solar", BOOL), col("has_battery", BOOL),
    col("has_heatpump", BOOL), col("is_vpp_enrolled", BOOL), col("enrollment_date", DATE)])

TELEMETRY = StructType([
    col("ts", TimestampNTZType()), col("gateway_id", StringType()), col("customer_key", INT),
    col("solar_yield_kw", DOUBLE), col("battery_soc_pct", DOUBLE), col("heatpump_consumption_kw", DOUBLE),
    col("grid_import_export_kw", DOUBLE)])

GATEWAY_MESSAGE = StructType([
    col("gateway_id", StringType()),
    col("timestamp", StringType()),
    col("telemetry", StructType([
        col("battery_soc_pct", DOUBLE), col("battery_power_kw", DOUBLE), col("solar_yield_kw", DOUBLE),
        col("grid_import_export_kw", DOUBLE), col("heatpump_consumption_kw", DOUBLE)])),
    col("status", StructType([
        col("online", BOOL), col("vpp_enabled", BOOL), col("error_code", StringType())])),
])

# Null markers in files and the domains that the data checks accept.
NULL_TOKENS = ("NULL", "null", "", "N/A", "n/a")
PRICE_ZONES = ("NEGATIVE", "LOW", "MEDIUM", "HIGH", "NO_PRICE_DATA")
BATTERY_ACTIONS = ("MAX_CHARGE", "CHARGE", "DISCHARGE", "SELF_CONSUME")
REGIONS = ("North", "South", "West", "East")
