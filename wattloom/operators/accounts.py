"""Billing, finance, marketing and opportunity figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattloom.functions.clock import month_of
from wattloom.functions.exact import mean, ratio, total

# Who approves up to which amount, and the climate contribution per 1,000 kWh.
APPROVAL_LEVELS = [(5_000, "department_head"), (25_000, "division_head"), (100_000, "management")]
TOP_APPROVAL_LEVEL = "board"
CLIMATE_EUR_PER_MWH = 5


def share_of_total(df: DataFrame, value: str, alias: str, within: list[str] | None = None) -> DataFrame:
    """Each row's part of the total, or of its group's total. Meant for aggregated frames."""
    if within:
        whole = F.sum(value).over(W.partitionBy(*within))
    else:
        whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(alias, ratio(F.col(value), whole))


def approval_level(amount: Column) -> Column:
    level = F.lit(TOP_APPROVAL_LEVEL)
    for limit, name in reversed(APPROVAL_LEVELS):
        level = F.when(amount <= limit, name).otherwise(level)
    return level


def finance_by_approval_level(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(approval_level(F.col("amount")).alias("approval_level")).agg(
        F.count("*").alias("transactions"), total("amount").cast("double").alias("total_amount"))


def finance_totals(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("account_key", "department_key", "approval_status").agg(
        F.count("*").alias("transactions"), total("amount").cast("double").alias("total_amount"))


def campaign_cost_per_lead(campaign_facts: DataFrame) -> DataFrame:
    return (campaign_facts.groupBy("channel_key")
            .agg(total("spend").alias("spend"), F.sum("leads_generated").alias("leads"))
            .select("channel_key", F.col("spend").cast("double").alias("total_spend"), "leads",
                    ratio(F.col("spend"), F.col("leads")).alias("cost_per_lead")))


def open_sales_funnel(opportunities: DataFrame) -> DataFrame:
    return opportunities.groupBy("stage_name").agg(
        F.count("*").alias("opportunities"), total("amount").cast("double").alias("total_amount"))


def opportunity_contracts(opportunities: DataFrame, contracts: DataFrame) -> DataFrame:
    """Each stage's opportunities with the contract value they led to. Contracts are summed per sale first."""
    value = contracts.groupBy("sale_id").agg(total("amount").alias("contract_amount"), F.count("*").alias("lines"))
    linked = opportunities.join(value, "sale_id", "left")
    return linked.groupBy("stage_name").agg(
        F.count("*").alias("opportunities"), F.count("lines").alias("with_contract"),
        F.sum("contract_amount").cast("double").alias("contract_amount"))


def seasonality_index(billing: DataFrame) -> DataFrame:
    """Mean consumption of a calendar month over the mean of the whole year, per energy type."""
    monthly = billing.groupBy("billing_type", F.month("billing_date").alias("month")).agg(
        F.sum("consumption_kwh").alias("kwh"), F.count("consumption_kwh").alias("n"))
    year = W.partitionBy("billing_type")  # twelve rows per type
    overall = ratio(F.sum("kwh").over(year), F.sum("n").over(year))
    return monthly.select("billing_type", "month",
                          (ratio(F.col("kwh"), F.col("n")) / overall).alias("seasonality_index"))


def invoice_summary(billing: DataFrame) -> DataFrame:
    """Consumption per customer, energy type and month, with the same month of the year before."""
    monthly = billing.groupBy("customer_key", "billing_type", month_of("billing_date").alias("month")).agg(
        F.sum("consumption_kwh").alias("kwh"))
    same_month = W.partitionBy("customer_key", "billing_type", F.month("month")).orderBy("month")
    all_months = W.partitionBy("customer_key", "billing_type")
    before = F.when(F.lag("month").over(same_month) == F.add_months("month", -12), F.lag("kwh").over(same_month))
    return monthly.select(
        "customer_key", "billing_type", "month", "kwh", before.alias("kwh_year_before"),
        (F.col("kwh") - before).alias("change_kwh"),
        ratio(F.sum("kwh").over(all_months), F.count("kwh").over(all_months)).alias("mean_monthly_kwh"))


def climate_contribution(billing: DataFrame) -> DataFrame:
    return (billing.groupBy("customer_key", F.year("billing_date").alias("year"))
            .agg(F.sum("consumption_kwh").alias("kwh"))
            .withColumn("contribution_eur", ratio(F.col("kwh") * CLIMATE_EUR_PER_MWH, F.lit(1000))))


def heavy_users(billing: DataFrame, min_kwh: int = 6000) -> DataFrame:
    return (billing.groupBy("customer_key").agg(F.sum("consumption_kwh").alias("kwh"))
            .where(F.col("kwh") > min_kwh))


def portfolio_by_category(products: DataFrame) -> DataFrame:
    return products.groupBy("category_name").agg(
        F.count("*").alias("products"), mean("capex_eur").alias("avg_capex"),
        F.min("capex_eur").cast("double").alias("min_capex"), F.max("capex_eur").cast("double").alias("max_capex"),
        mean("opex_eur_year").alias("avg_opex"))
