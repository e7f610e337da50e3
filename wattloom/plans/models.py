"""The seven metric models: sales, billing, service, customer energy, workforce, market prices, telemetry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wattloom.functions.exact import PER_UNIT
from wattloom.plans.metrics import Dimension, Entity, Link, Metric, SemanticModel

Tables = Mapping[str, DataFrame]


def _dims(entity: str, *names: str) -> list[Dimension]:
    return [Dimension(n, entity, n) for n in names]


def _exact(name: str, entity: str, function: str, column: str) -> Metric:
    """Sum or mean of a double column, counted in ten-thousandths."""
    return Metric(name, entity, function, f"cast(rint({column} * {PER_UNIT}) as bigint)", in_units=True)


def sales_model(t: Tables) -> SemanticModel:
    return SemanticModel(
        name="sales",
        entities=[
            Entity("customers", t["customer_dim"], "customer_key", ("Kunden",)),
            Entity("products", t["product_dim"], "product_key", ("Produkte", "tariffs")),
            Entity("regions", t["region_dim"], "region_key", ("Regionen",)),
            Entity("contracts", t["sales_fact"], "sale_id", ("Verträge", "sales")),
            Entity("reps", t["sales_rep_dim"], "sales_rep_key", ("Berater", "consultants")),
            Entity("vendors", t["vendor_dim"], "vendor_key", ("Lieferanten", "partners")),
        ],
        links=[
            Link("contracts", "customer_key", "customers"), Link("contracts", "product_key", "products"),
            Link("contracts", "sales_rep_key", "reps"), Link("contracts", "vendor_key", "vendors"),
            Link("customers", "region_key", "regions", "customer"), Link("contracts", "region_key", "regions", "contract"),
        ],
        dimensions=[
            Dimension("customer_name", "customers", "customer_name", ("Kunde",)),
            Dimension("customer_type", "customers", "customer_type", ("Kundentyp", "segment")),
            Dimension("city", "customers", "city", ("Stadt", "Ort")),
            Dimension("product_key", "products", "product_key"),
            Dimension("product_name", "products", "product_name", ("Produkt", "Tarif")),
            Dimension("category_name", "products", "category_name", ("Kategorie", "product_category")),
            Dimension("vertical", "products", "vertical", ("Bereich",)),
            Dimension("region_name", "regions", "region_name", ("Region", "Gebiet"), role="customer"),
            Dimension("contract_date", "contracts", "date", ("Vertragsdatum",)),
            Dimension("contract_month", "contracts", "cast(trunc(date, 'month') as date)"),
            Dimension("contract_year", "contracts", "year(date)"),
            Dimension("rep_name", "reps", "rep_name", ("Vertriebsmitarbeiter",)),
            Dimension("vendor_name", "vendors", "vendor_name", ("Installateur",)),
        ],
        metrics=[
            Metric("total_revenue", "contracts", "sum", "amount", ("Umsatz", "revenue")),
            Metric("total_contracts", "contracts", "count", "sale_id", ("contract_count",)),
            Metric("avg_contract_value", "contracts", "avg", "amount", ("average_contract_value",)),
            Metric("total_units", "contracts", "sum", "units"),
            Metric("contract_records", "contracts", "sum", "1"),
            Metric("avg_capex", "products", "avg", "capex_eur"),
            Metric("avg_opex", "products", "avg", "opex_eur_year"),
            Metric("product_count", "products", "count", "product_key"),
            Metric("customer_count", "customers", "count", "customer_key", ("Kundenzahl",)),
        ])


def _billing_parts() -> tuple[list[Dimension], list[Metric]]:
    dimensions = [
        Dimension("billing_date", "billing", "billing_date", ("Rechnungsdatum",)),
        Dimension("billing_type", "billing", "billing_type", ("Energieart",)),
        Dimension("payment_status", "billing", "payment_status", ("Zahlungsstatus",)),
        Dimension("customer_name", "customers", "customer_name"),
        Dimension("customer_key", "customers", "customer_key"),
        Dimension("city", "customers", "city"),
    ]
    metrics = [
        Metric("total_consumption", "billing", "sum", "consumption_kwh", ("Verbrauch",)),
        Metric("avg_consumption", "billing", "avg", "consumption_kwh", ("average_consumption",)),
        Metric("total_billing_amount", "billing", "sum", "amount"),
        Metric("total_invoices", "billing", "count", "billing_id", ("Rechnungen",)),
    ]
    return dimensions, metrics


def billing_model(t: Tables) -> SemanticModel:
    dimensions, metrics = _billing_parts()
    return SemanticModel(
        name="billing",
        entities=[Entity("customers", t["customer_dim"], "customer_key"),
                  Entity("billing", t["billing_history"], "billing_id", ("Rechnungen", "invoices"))],
        links=[Link("billing", "customer_key", "customers")],
        dimensions=dimensions, metrics=metrics)


def service_model(t: Tables, negative: str = "Negativ") -> SemanticModel:
    return SemanticModel(
        name="service",
        entities=[Entity("customers", t["customer_dim"], "customer_key"),
                  Entity("tickets", t["service_logs"], "log_id", ("Anfragen",))],
        links=[Link("tickets", "customer_key", "customers")],
        dimensions=[*_dims("tickets", "log_date", "topic", "sentiment", "priority"),
                    *_dims("customers", "customer_name", "city")],
        metrics=[Metric("total_tickets", "tickets", "count", "log_id"),
                 Metric("negative_tickets", "tickets", "count_if", f"sentiment = '{negative}'")])


def customer_energy_model(t: Tables) -> SemanticModel:
    """Bills, ownership and devices all hang off the customer; none may multiply another."""
    dimensions, metrics = _billing_parts()
    return SemanticModel(
        name="customer energy",
        entities=[Entity("customers", t["customer_dim"], "customer_key"),
                  Entity("billing", t["billing_history"], "billing_id"),
                  Entity("ownership", t["customer_products"], "customer_product_id"),
                  Entity("devices", t["device_registry"], "customer_key", ("VPP", "Geräte"))],
        links=[Link("billing", "customer_key", "customers"), Link("ownership", "customer_key", "customers"),
               Link("devices", "customer_key", "customers")],
        dimensions=[*dimensions, Dimension("category_name", "ownership", "category_name"),
                    *_dims("devices", "gateway_id", "has_solar", "has_battery", "has_heatpump", "is_vpp_enrolled",
                           "enrollment_date")],
        metrics=[*metrics, Metric("owned_products", "ownership", "count", "product_key"),
                 Metric("device_count", "devices", "count", "gateway_id")])


def workforce_model(t: Tables) -> SemanticModel:
    return SemanticModel(
        name="workforce",
        entities=[Entity("departments", t["department_dim"], "department_key", ("Abteilungen",)),
                  Entity("employees", t["employee_dim"], "employee_key", ("Mitarbeiter",)),
                  Entity("records", t["hr_employee_fact"], "hr_fact_id"),
                  Entity("jobs", t["job_dim"], "job_key", ("Stellen",))],
        links=[Link("records", "department_key", "departments"), Link("records", "employee_key", "employees"),
               Link("records", "job_key", "jobs")],
        dimensions=[Dimension("department_name", "departments", "department_name", ("Abteilung",)),
                    Dimension("employee_name", "employees", "employee_name"),
                    Dimension("job_title", "jobs", "job_title", ("Position", "Stelle"))],
        metrics=[Metric("total_salary", "records", "sum", "salary"),
                 Metric("avg_salary", "records", "avg", "salary", ("Gehalt",)),
                 Metric("attrition_count", "records", "sum", "attrition_flag", ("Fluktuation",)),
                 Metric("headcount", "records", "count", "employee_key"),
                 Metric("total_employees", "employees", "count", "employee_key")])


def market_price_model(t: Tables) -> SemanticModel:
    return SemanticModel(
        name="market prices",
        entities=[Entity("prices", t["market_prices"], "start_time",
                         ("Strompreise", "day-ahead", "Börsenpreise", "spot prices", "Marktpreise"))],
        links=[],
        dimensions=[*_dims("prices", "start_time", "end_time", "fetch_date"),
                    Dimension("price_day", "prices", "to_date(start_time)")],
        metrics=[_exact("avg_price", "prices", "avg", "price_eur_mwh"),
                 Metric("max_price", "prices", "max", "price_eur_mwh"),
                 Metric("min_price", "prices", "min", "price_eur_mwh")])


def telemetry_model(t: Tables) -> SemanticModel:
    """Readings link to the device table instead of carrying its columns, so they reduce before the join."""
    return SemanticModel(
        name="telemetry",
        entities=[Entity("telemetry", t["telemetry"], "ts",
                         ("VPP Telemetrie", "virtual power plant", "IoT", "Batteriespeicher", "battery storage")),
                  Entity("devices", t["devices"], "customer_key")],
        links=[Link("telemetry", "customer_key", "devices")],
        dimensions=[*_dims("telemetry", "ts", "gateway_id"),
                    Dimension("hour_of_day", "telemetry", "hour(ts)"),
                    *_dims("devices", "customer_key", "customer_name", "city", "region", "customer_type",
                           "is_vpp_enrolled")],
        metrics=[_exact("avg_solar_yield", "telemetry", "avg", "solar_yield_kw"),
                 _exact("total_solar_yield", "telemetry", "sum", "solar_yield_kw"),
                 _exact("avg_battery_soc", "telemetry", "avg", "battery_soc_pct"),
                 _exact("avg_heatpump_consumption", "telemetry", "avg", "heatpump_consumption_kw"),
                 _exact("net_grid_flow", "telemetry", "sum", "grid_import_export_kw"),
                 Metric("reading_count", "telemetry", "count", "ts")])
