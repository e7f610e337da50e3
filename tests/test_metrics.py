from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattloom.plans import models
from wattloom.plans.metrics import Entity, Link, MetricError, SemanticModel


@pytest.fixture(scope="module")
def tables(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "customer_dim": frame([(1, "A", "private", "Bonn", 10), (2, "B", "firm", "Ulm", 11), (3, "C", "firm", "Ulm", 11)],
                              "customer_key long, customer_name string, customer_type string, city string, region_key long"),
        "product_dim": frame([(1, "P1", "solar", "v", 100.0, 1.0), (2, "P2", "heat", "v", 300.0, 3.0),
                              (3, "P3", "heat", "v", 500.0, 5.0)],
                             "product_key long, product_name string, category_name string, vertical string, "
                             "capex_eur double, opex_eur_year double"),
        "region_dim": frame([(10, "West"), (11, "South")], "region_key long, region_name string"),
        "sales_rep_dim": frame([(1, "R")], "sales_rep_key long, rep_name string"),
        "vendor_dim": frame([(1, "V")], "vendor_key long, vendor_name string"),
        "sales_fact": frame([(1, date(2024, 1, 1), 1, 1, 1, 1, 10.0, 1), (2, date(2024, 1, 2), 1, 2, 1, 1, 20.0, 2),
                             (3, date(2024, 2, 1), 2, 2, 1, 1, 30.0, 3), (4, date(2024, 2, 1), 99, 2, 1, 1, 5.0, 1)],
                            "sale_id long, date date, customer_key long, product_key long, sales_rep_key long, "
                            "vendor_key long, amount double, units long"),
        "billing_history": frame([(1, 1, date(2024, 1, 1), "Electricity", 100, 10.0, "paid"),
                                  (2, 1, date(2024, 2, 1), "Electricity", 300, 30.0, "open"),
                                  (3, 2, date(2024, 1, 1), "Gas", 50, 5.0, "paid")],
                                 "billing_id long, customer_key long, billing_date date, billing_type string, "
                                 "consumption_kwh long, amount double, payment_status string"),
        "customer_products": frame([(1, 1, 1, "solar"), (2, 1, 2, "heat"), (3, 1, 3, "heat"), (4, 3, 1, "solar")],
                                   "customer_product_id long, customer_key long, product_key long, category_name string"),
        "device_registry": frame([(1, "GW-1", True, True, True, True, None)],
                                 "customer_key long, gateway_id string, has_solar boolean, has_battery boolean, "
                                 "has_heatpump boolean, is_vpp_enrolled boolean, enrollment_date date"),
    }


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_product_metrics_average_products_not_contracts(tables):
    sales = models.sales_model(tables)
    both = sales.query(["total_contracts", "avg_capex"], ["category_name"])
    assert values(both) == [("heat", 3, 400.0), ("solar", 1, 100.0)]  # the unsold product counts too


def test_two_step_dimension_and_missing_parent(tables):
    by_region = models.sales_model(tables).query(["total_revenue"], ["region_name"])
    assert {r["region_name"]: r["total_revenue"] for r in by_region.collect()} == {"West": 30.0, "South": 30.0, None: 5.0}


def test_filters_on_own_and_parent_columns(tables):
    sales = models.sales_model(tables)
    january = sales.query(["total_revenue"], where={"contract_date": lambda d: d < date(2024, 2, 1)})
    assert values(january) == [(30.0,)]
    ulm_heat = sales.query(["total_units"], where={"city": lambda c: c == "Ulm", "category_name": lambda c: c == "heat"})
    assert values(ulm_heat) == [(3,)]
    elsewhere = sales.query(["total_units"], without={"city": lambda c: c == "Ulm"})
    assert values(elsewhere) == [(4,)]  # a contract without a known customer stays


def test_ownership_filter_does_not_multiply_bills(tables):
    energy = models.customer_energy_model(tables)
    heat = {"category_name": lambda c: c == "heat"}
    assert values(energy.query(["avg_consumption", "total_invoices"], where=heat)) == [(200.0, 2)]
    assert values(energy.query(["avg_consumption", "total_invoices"], without=heat)) == [(50.0, 1)]
    assert values(energy.query(["total_invoices"], where={"is_vpp_enrolled": lambda flag: flag})) == [(2,)]


def test_metrics_of_two_facts_meet_on_the_shared_dimension(tables):
    energy = models.customer_energy_model(tables)
    found = energy.query(["total_billing_amount", "owned_products"], ["customer_name"])
    assert values(found) == [("A", 40.0, 3), ("B", 5.0, None), ("C", None, 1)]
    assert values(energy.query(["total_billing_amount", "owned_products"])) == [(45.0, 4)]


def test_unreachable_dimension_is_refused(tables):
    with pytest.raises(MetricError, match="repeat"):
        models.customer_energy_model(tables).query(["total_invoices"], ["category_name"])
    with pytest.raises(MetricError):
        models.sales_model(tables).query(["avg_capex"], ["region_name"])


def test_names_ignore_case_and_follow_synonyms(tables):
    sales = models.sales_model(tables)
    assert sales.find_metric("UMSATZ").name == "total_revenue"
    assert sales.find_dimension("kategorie").name == "category_name"
    with pytest.raises(MetricError, match="unknown"):
        sales.find_metric("profit")


def test_ambiguous_synonym_is_refused(spark):
    from wattloom.plans.metrics import Dimension, Metric

    df = spark.createDataFrame([(1, "x", "y")], "k long, a string, b string")
    model = SemanticModel([Entity("t", df, "k")], [], [Dimension("a", "t", "a", ("n",)), Dimension("b", "t", "b", ("n",))],
                          [Metric("m", "t", "count", "k")])
    with pytest.raises(MetricError, match="ambiguous"):
        model.query(["m"], ["n"])


def test_membership_through_two_links(spark):
    from wattloom.plans.metrics import Dimension, Metric

    bills = spark.createDataFrame([(1, 10, 5), (2, 20, 7)], "bill long, household long, amount long")
    homes = spark.createDataFrame([(10,), (20,)], "household long")
    people = spark.createDataFrame([(100, 10), (200, 20)], "person long, household long")
    visits = spark.createDataFrame([(1, 100, "red"), (2, 100, "red"), (3, 200, "blue")], "visit long, person long, kind string")
    model = SemanticModel(
        [Entity("bills", bills, "bill"), Entity("homes", homes, "household"), Entity("people", people, "person"),
         Entity("visits", visits, "visit")],
        [Link("bills", "household", "homes"), Link("people", "household", "homes"), Link("visits", "person", "people")],
        [Dimension("kind", "visits", "kind")], [Metric("amount", "bills", "sum", "amount")])
    assert values(model.query(["amount"], where={"kind": lambda k: k == "red"})) == [(5,)]


def test_two_ways_to_a_table_need_a_role(tables):
    signed = tables["sales_fact"].withColumn("region_key", F.when(F.col("sale_id") < 4, 10).cast("long"))
    sales = models.sales_model({**tables, "sales_fact": signed})
    both = sales.query(["total_revenue"], ["contract:region_name", "customer:region_name"])
    assert both.columns == ["contract_region_name", "customer_region_name", "total_revenue"]
    assert {tuple(r) for r in both.collect()} == {("West", "West", 30.0), ("West", "South", 30.0), (None, None, 5.0)}
    kept = sales.query(["total_revenue"], where={"Contract:Region": lambda r: r == "West", "region_name": lambda r: r == "South"})
    assert values(kept) == [(30.0,)]
    with pytest.raises(MetricError, match="unknown role"):
        sales.query(["total_revenue"], ["vendor:region_name"])
    plain = replace(sales.find_dimension("region_name"), role="")
    blind = SemanticModel(sales.entities, sales.links, [plain], sales.metrics)
    with pytest.raises(MetricError, match=r"2 ways: name one of the roles \['contract', 'customer'\]"):
        blind.query(["total_revenue"], ["region_name"])
    assert values(blind.query(["customer_count"], ["region_name"])) == [("South", 2), ("West", 1)]  # one way only


def test_table_synonyms_and_folded_names(tables):
    sales = models.sales_model(tables)
    assert sales.find_entity("VERTRAEGE").name == "contracts"
    assert sales.find_dimension("Kunden.Stadt").name == "city"
    assert sales.find_dimension("Region Name") == sales.find_dimension("regionen.region_name")
    with pytest.raises(MetricError):
        sales.find_dimension("Produkte.city")
