"""Refreshes fed with repeated, late, broken and reshaped input."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import fleet, price_document, readings_at, unix
from wattloom.plans.refresh import refresh
from wattloom.sources import layers
from wattloom.sources import price_documents as docs

AT = "2024-01-01 10:00:00"


def shared(spark):
    devices = fleet(spark, (1, "North", True))
    return {"customer_dim": devices.select("customer_key", "customer_name", "city", F.col("region").alias("state"), "customer_type"),
            "device_registry": devices.select("customer_key", "gateway_id", "has_solar", "has_battery", "has_heatpump", "is_vpp_enrolled",
                                              "enrollment_date"),
            }


def raw(spark, *rows):
    return spark.createDataFrame([(fetched, date.fromisoformat(day), text) for fetched, day, text in rows],
                                 "fetch_timestamp timestamp, fetch_date date, raw_data string")


def body(price, **more):
    return json.dumps({"license_info": "L", "unix_seconds": [unix(AT)], "price": [price], "unit": "EUR/MWh", "deprecated": False, **more})


def run(spark, root, documents, readings):
    bands = spark.createDataFrame([(0.0, 1000.0)], "p25 double, p75 double")
    return refresh({**shared(spark), "raw_day_ahead_prices": documents, "telemetry": readings}, root, bands)


def margins(spark, paths):
    return {r["hour"]: (r["net_margin_eur"], r["price_zone"]) for r in spark.read.parquet(paths["arbitrage"]).collect()}


def test_a_reading_that_a_delivery_repeats_counts_once(spark, tmp_path):
    readings = readings_at(spark, *[("2024-01-01 10:05:00", 1, 0, 50, 0, -1)] * 3)
    paths = run(spark, str(tmp_path), price_document(spark, ("2024-01-01", [unix(AT)], [100.0])), readings)
    assert spark.read.parquet(paths["telemetry"]).count() == 1
    assert margins(spark, paths) == {datetime(2024, 1, 1, 10): (0.1, "MEDIUM")}


def test_two_documents_of_a_day_the_last_one_counts(spark, tmp_path):
    readings = readings_at(spark, ("2024-01-01 10:05:00", 1, 0, 50, 0, -1))
    two = raw(spark, (datetime(2024, 1, 1, 9), "2024-01-01", body(300.0)), (datetime(2024, 1, 1, 8), "2024-01-01", body(100.0)))
    paths = run(spark, str(tmp_path), two, readings)
    assert spark.read.parquet(paths["raw_prices"]).count() == 1
    assert margins(spark, paths)[datetime(2024, 1, 1, 10)] == (0.3, "MEDIUM")


def test_a_broken_document_is_counted_and_blocks_nothing(spark, tmp_path):
    readings = readings_at(spark, ("2024-01-01 10:05:00", 1, 0, 50, 0, -1))
    broken = raw(spark, (None, "2024-01-01", '{"unix_seconds": ['), (None, "2024-01-02", '{"price": [1]}'), (None, "2024-01-03", None))
    for _ in range(2):
        paths = run(spark, str(tmp_path), broken, readings)
        held = spark.read.parquet(paths["price_quarantine"])
        assert {(r.fetch_date.day, r.problem) for r in held.collect()} == {(1, "not JSON"), (2, "no times"), (3, "not JSON")}
        assert held.count() == 3 and margins(spark, paths)[datetime(2024, 1, 1, 10)][1] == "NO_PRICE_DATA"
    paths = run(spark, str(tmp_path), broken.union(raw(spark, (None, "2024-01-01", body(200.0)))), readings)
    assert margins(spark, paths)[datetime(2024, 1, 1, 10)] == (0.2, "MEDIUM")
    assert spark.read.parquet(paths["price_quarantine"]).count() == 3


def test_fields_that_nobody_expected_survive(spark, tmp_path):
    readings = readings_at(spark, ("2024-01-01 10:05:00", 1, 0, 50, 0, -1))
    paths = run(spark, str(tmp_path), raw(spark, (None, "2024-01-01", body(100.0, source={"name": "x", "version": 3}))), readings)
    stored = spark.read.parquet(paths["raw_prices"])
    assert stored.select(F.try_variant_get("document", "$.source.version", "int")).first()[0] == 3


def test_elements_of_another_kind_are_null(spark):
    checked = docs.checked_documents(raw(spark, (None, "2024-01-01", '{"unix_seconds": [900, "x", 1800], "price": [1.5, 2, "y"]}')))
    points = docs.price_points(docs.usable(checked)).select("unix_seconds", "price_eur_mwh").collect()
    assert [tuple(p) for p in points] == [(900, 1.5), (1800, None)]


def test_licence_unit_and_deprecation_are_carried(spark):
    days = docs.to_delivery_days(raw(spark, (None, "2024-01-01", body(1.0, license_info="CC", unit="ct/kWh", deprecated=True))))
    doc = days.select(docs.parsed().alias("doc")).first()["doc"]
    assert (doc.license_info, doc.unit, doc.deprecated) == ("CC", "ct/kWh", True)


def test_updates_that_repeat_a_key_are_refused(spark, tmp_path):
    path, rows = str(tmp_path / "t"), [(1, "a", 1), (1, "b", 1)]
    twice = spark.createDataFrame(rows, "k long, v string, p int")
    with pytest.raises(ValueError):
        layers.upsert_partitions(twice, path, ["k"], "p")
    layers.upsert_partitions(twice, path, ["k"], "p", newest_by="v")
    with pytest.raises(ValueError):
        layers.upsert_partitions(twice, path, ["k"], "p")
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()] == [(1, "b")]


def test_a_column_comes_and_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    layers.upsert_partitions(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, p int"), path, ["k"], "p")
    layers.upsert_partitions(spark.createDataFrame([(3, "c", 9.5, 2)], "k long, v string, fresh double, p int"), path, ["k"], "p")
    found = layers.read_if_present(spark, path)
    assert {(r.k, r.v, r.fresh) for r in found.collect()} == {(1, "a", None), (2, "b", None), (3, "c", 9.5)}
    layers.upsert_partitions(spark.createDataFrame([(4, "d", 1)], "k long, v string, p int"), path, ["k"], "p")
    assert {(r.k, r.fresh) for r in layers.read_if_present(spark, path).collect()} == {(1, None), (2, None), (3, 9.5), (4, None)}


def test_bands_from_day_sketches_see_every_stored_day(spark, tmp_path):
    """The second day alone has its upper quartile at 700, both days together at 600: its mean of 650 is high only if the first day counts."""
    root = str(tmp_path)
    quarters = lambda day: [unix(f"{day} 10:{minute}:00") for minute in ("00", "15", "30", "45")]
    days = [("2024-01-01", quarters("2024-01-01"), [10.0, 20.0, 30.0, 40.0]), ("2024-01-02", quarters("2024-01-02"), [500.0, 600.0, 700.0, 800.0])]
    readings = readings_at(spark, ("2024-01-01 10:05:00", 1, 0, 50, 0, -1), ("2024-01-02 10:05:00", 1, 0, 50, 0, -1))
    nothing = refresh({**shared(spark), "raw_day_ahead_prices": price_document(spark, days[0]).limit(0), "telemetry": readings}, root, day_sketches=True)
    assert {zone for _, zone in margins(spark, nothing).values()} == {"NO_PRICE_DATA"}
    for known in (days[:1], days, days):
        paths = refresh({**shared(spark), "raw_day_ahead_prices": price_document(spark, *known), "telemetry": readings}, root, day_sketches=True)
    assert {hour.day: zone for hour, (_, zone) in margins(spark, paths).items()} == {1: "MEDIUM", 2: "HIGH"}
    assert sorted(r.price_day.day for r in spark.read.parquet(paths["price_quantiles"]).collect()) == [1, 2]
