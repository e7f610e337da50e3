"""The domain tables derived from the provided test tables.

Money becomes an exact decimal. Readings are doubles of at most four decimals, made by whole-number
arithmetic on cents, so both engines start from equal values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.clock import unix_to_utc
from wattloom.functions.sampling import gateway_id, percent_bucket
from wattloom.operators import devices as device_ops
from wattloom.operators.prices import price_mart, stage_prices

# How the test tables play the domain's roles.
SOLAR, HEATPUMP, BATTERY = "PROMO", "ECONOMY", "%red widget%"
HARDWARE_SIZE = 3
HOURS_WITHOUT_PRICE_PERCENT = 5

# Layout of the given files. Naming it spares a job per table that would infer it.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def money(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")


def _ten_thousandths(count: Column) -> Column:
    return count.cast("double") / 10_000


class Domain(Mapping):
    """Domain tables by name, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(LAYOUTS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


BUILDERS: dict[str, Callable[[Domain], DataFrame]] = {}


def table(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    BUILDERS[build.__name__] = build
    return build


def _places(d: Domain) -> DataFrame:
    return d.source("nation").join(d.source("region"), F.col("n_regionkey") == F.col("r_regionkey"))


@table
def region_dim(d: Domain) -> DataFrame:
    return d.source("region").select(F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("region_name"))


@table
def customer_dim(d: Domain) -> DataFrame:
    return d.source("customer").join(_places(d), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"), F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.col("n_regionkey").alias("region_key"))


def _products(d: Domain, category: Column) -> DataFrame:
    return d.source("part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name"), category.alias("category_name"),
        F.col("p_brand").alias("vertical"),
        money("p_retailprice").alias("capex_eur"), money("p_size").alias("opex_eur_year"))


@table
def product_dim(d: Domain) -> DataFrame:
    """Of the two hardware categories, only small parts are whole devices."""
    parts = F.col("p_type").isin(SOLAR, HEATPUMP) & (F.col("p_size") > HARDWARE_SIZE)
    return _products(d, F.when(parts, F.concat("p_type", F.lit(" PARTS"))).otherwise(F.col("p_type")))


@table
def whole_categories(d: Domain) -> DataFrame:
    """Products as in ``product_dim``, but parts of every size stay in their category."""
    return _products(d, F.col("p_type"))


@table
def vendor_dim(d: Domain) -> DataFrame:
    return d.source("supplier").join(_places(d), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("vendor_key"), F.col("s_name").alias("vendor_name"), F.col("n_name").alias("city"),
        F.col("r_name").alias("state"))


@table
def sales_rep_dim(d: Domain) -> DataFrame:
    return d.source("nation").select(
        F.col("n_nationkey").cast("bigint").alias("sales_rep_key"),
        F.concat(F.lit("Rep "), F.col("n_name")).alias("rep_name"))


def _contract_lines(d: Domain) -> DataFrame:
    return d.source("lineitem").join(d.source("orders"), F.col("l_orderkey") == F.col("o_orderkey"))


@table
def sales_fact(d: Domain) -> DataFrame:
    amount = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return _contract_lines(d).select(
        F.col("l_orderkey").alias("sale_id"), F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").alias("customer_key"), F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("vendor_key"), (F.col("l_suppkey") % 25).alias("sales_rep_key"),
        (F.col("l_orderkey") % 5).cast("int").alias("region_key"),
        amount.cast("decimal(18,4)").alias("amount"), F.col("l_quantity").cast("bigint").alias("units"))


@table
def contracts(d: Domain) -> DataFrame:
    """One contract per order line."""
    return _contract_lines(d).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sale_id"), F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").alias("customer_key"), F.col("l_partkey").alias("product_key"),
        F.when(F.col("o_orderstatus") == "P", "Inactive").otherwise("Active").alias("status"))


@table
def customer_products(d: Domain) -> DataFrame:
    return device_ops.first_acquisitions(d["contracts"], d["product_dim"])


@table
def device_registry(d: Domain) -> DataFrame:
    return device_ops.device_registry(d["customer_products"], d["product_dim"], SOLAR, HEATPUMP, BATTERY)


@table
def devices(d: Domain) -> DataFrame:
    return device_ops.enrich_devices(d["device_registry"], d["customer_dim"])


def _event_columns(d: Domain) -> DataFrame:
    return d.source("events").select(
        "*", F.rint(F.col("value") * 100).cast("bigint").alias("cents"),
        F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int").alias("k"))


@table
def telemetry(d: Domain) -> DataFrame:
    """Readings: solar value/25 by day, charge k, heat pump value/100, flow value/20 out or in."""
    by_day = F.hour("ts").between(6, 20)
    exports = F.col("event_type").isin("purchase", "error")
    return _event_columns(d).select(
        "ts", gateway_id(F.col("user_id")).alias("gateway_id"), F.col("user_id").alias("customer_key"),
        _ten_thousandths(F.when(by_day, F.col("cents") * 4).otherwise(0)).alias("solar_yield_kw"),
        F.col("k").cast("double").alias("battery_soc_pct"),
        _ten_thousandths(F.when(F.col("event_type") == "click", F.col("cents")).otherwise(0))
        .alias("heatpump_consumption_kw"),
        _ten_thousandths(F.when(exports, F.col("cents") * -5).otherwise(F.col("cents") * 5))
        .alias("grid_import_export_kw"))


def _slot_prices(d: Domain) -> DataFrame:
    """Prices per quarter hour, from all events; cheaper around noon."""
    slot = (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 900) * 900).cast("bigint")
    per_slot = _event_columns(d).groupBy(slot.alias("unix_seconds")).agg(F.expr("sum(cents) div count(*)").alias("mean_cents"))
    discount = F.when(F.hour(unix_to_utc("unix_seconds")).isin(12, 13), 7000).otherwise(1000)
    return per_slot.select("unix_seconds", ((F.col("mean_cents") - discount) / 100).cast("double").alias("price"))


def _day_documents(slots: DataFrame) -> DataFrame:
    """One JSON document per UTC day; a day has at most 96 slots."""
    points = F.array_sort(F.collect_list(F.struct("unix_seconds", "price")))
    days = slots.groupBy(F.to_date(unix_to_utc("unix_seconds")).alias("fetch_date")).agg(points.alias("p"))
    document = F.struct(F.lit("").alias("license_info"), F.col("p.unix_seconds").alias("unix_seconds"),
                        F.col("p.price").alias("price"), F.lit("EUR/MWh").alias("unit"),
                        F.lit(False).alias("deprecated"))
    return days.select(F.col("fetch_date").cast("timestamp").alias("fetch_timestamp"), "fetch_date",
                       F.to_json(document).alias("raw_data"))


@table
def price_slots(d: Domain) -> DataFrame:
    """Prices per quarter hour; some hours, by their hash, have none."""
    return _slot_prices(d).where(percent_bucket(F.expr("unix_seconds div 3600")) >= HOURS_WITHOUT_PRICE_PERCENT)


@table
def raw_day_ahead_prices(d: Domain) -> DataFrame:
    return _day_documents(d["price_slots"])


@table
def market_prices(d: Domain) -> DataFrame:
    return stage_prices(d["raw_day_ahead_prices"])


@table
def every_price(d: Domain) -> DataFrame:
    """Prices as in ``market_prices``, of every hour."""
    return stage_prices(_day_documents(_slot_prices(d)))


@table
def prices_mart(d: Domain) -> DataFrame:
    return price_mart(d["market_prices"])


@table
def gateway_messages(d: Domain) -> DataFrame:
    t = d["telemetry"]
    body = F.struct(
        "gateway_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("timestamp"),
        F.struct("battery_soc_pct", F.lit(0.0).alias("battery_power_kw"), "solar_yield_kw", "grid_import_export_kw",
                 "heatpump_consumption_kw").alias("telemetry"),
        F.struct(F.lit(True).alias("online"), F.lit(True).alias("vpp_enabled"),
                 F.lit(None).cast("string").alias("error_code")).alias("status"))
    return t.select(F.to_json(body).alias("value"))


@table
def billing_history(d: Domain) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "open").otherwise("overdue")
    return d.source("orders").select(
        F.col("o_orderkey").alias("billing_id"), F.col("o_custkey").alias("customer_key"),
        F.to_date("o_orderdate").alias("billing_date"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Electricity").otherwise("Gas").alias("billing_type"),
        F.floor(F.col("o_totalprice") / 20).cast("bigint").alias("consumption_kwh"),
        money("o_totalprice").alias("amount"), status.alias("payment_status"))


@table
def service_logs(d: Domain) -> DataFrame:
    k, day = F.col("k"), F.to_date("ts")
    priority = F.element_at(F.array(*map(F.lit, ("low", "medium", "high", "critical"))), k % 4 + 1)
    return _event_columns(d).select(
        F.col("event_id").alias("log_id"), F.col("user_id").alias("customer_key"), day.alias("log_date"),
        F.col("event_type").alias("topic"), priority.alias("priority"),
        F.when(k < 30, "negative").when(k < 85, "neutral").otherwise("positive").alias("sentiment"),
        F.when(k < 90, F.date_add(day, k % 15)).alias("resolution_date"))


@table
def hr_employee_fact(d: Domain) -> DataFrame:
    return d.source("customer").select(
        F.col("c_custkey").alias("hr_fact_id"), F.col("c_custkey").alias("employee_key"),
        F.col("c_mktsegment").alias("department_key"), F.col("c_nationkey").alias("job_key"),
        money("c_acctbal").alias("salary"), (F.col("c_custkey") % 7 == 0).cast("int").alias("attrition_flag"))


@table
def employee_dim(d: Domain) -> DataFrame:
    return d.source("customer").select(F.col("c_custkey").alias("employee_key"), F.col("c_name").alias("employee_name"))


@table
def department_dim(d: Domain) -> DataFrame:
    return d.source("customer").select(F.col("c_mktsegment").alias("department_key")).distinct().select(
        "department_key", F.initcap("department_key").alias("department_name"))


@table
def job_dim(d: Domain) -> DataFrame:
    return d.source("nation").select(F.col("n_nationkey").alias("job_key"), F.col("n_name").alias("job_title"))


@table
def finance_transactions(d: Domain) -> DataFrame:
    return d.source("lineitem").select(
        F.col("l_orderkey").alias("transaction_id"), F.col("l_returnflag").alias("account_key"),
        F.col("l_linenumber").alias("department_key"), F.col("l_linestatus").alias("approval_status"),
        F.col("l_suppkey").alias("vendor_key"), money("l_extendedprice").alias("amount"))


@table
def marketing_campaign_fact(d: Domain) -> DataFrame:
    return _event_columns(d).select(
        F.col("event_id").alias("campaign_fact_id"), F.to_date("ts").alias("date"),
        F.col("event_type").alias("channel_key"), F.col("user_id").alias("campaign_key"),
        money("value").alias("spend"), F.col("k").cast("bigint").alias("leads_generated"))


@table
def sf_opportunities(d: Domain) -> DataFrame:
    return d.source("orders").select(
        F.col("o_orderkey").alias("opportunity_id"), F.col("o_orderkey").alias("sale_id"),
        F.col("o_orderstatus").alias("stage_name"), money("o_totalprice").alias("amount"))


@table
def parsed_content(d: Domain) -> DataFrame:
    """Documents as Markdown files in three folders, by the number of their source."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    folder = F.element_at(F.array(*map(F.lit, ("energy", "products", "service"))), number % 3 + 1)
    path = F.concat(F.lit("docs/"), folder, F.lit("/"), F.col("source"), F.lit("-"), F.col("doc_id"), F.lit(".md"))
    content = F.concat(F.lit("# Document "), F.col("doc_id"), F.lit("\n"), F.col("text"), F.lit("\n## Origin\n"),
                       F.col("source"), F.lit(" "), F.col("lang"))
    return d.source("documents").select("doc_id", path.alias("relative_path"),
                                        F.concat(F.lit("file:///"), path).alias("file_url"), content.alias("content"))


@table
def ticket_texts(d: Domain) -> DataFrame:
    """What users wrote, one row per turn, with a topic, priority and sentiment by their numbers."""
    def one_of(number, *names):
        return F.element_at(F.array(*map(F.lit, names)), (number % len(names) + 1).cast("int"))

    return d.source("conversations").where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("log_id"), "conv_id", "turn", F.col("text").alias("description"),
        one_of(F.col("conv_id"), "billing", "outage", "contract", "device").alias("topic"),
        one_of(F.col("conv_id") + F.col("turn"), "low", "medium", "high", "critical").alias("priority"),
        one_of(F.col("conv_id") * 2 + F.col("turn"), "negative", "neutral", "positive").alias("sentiment"))
