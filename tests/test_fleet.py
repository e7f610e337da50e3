import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import by, fleet, prices_at, readings_at
from wattloom.functions.sampling import gateway_id
from wattloom.operators import arbitrage, devices, prices, telemetry


def test_device_registry_from_ownership(spark):
    products = spark.createDataFrame(
        [(1, "Solar Paket", "Solar & Storage"), (2, "Speicher 10", "Solar & Storage"), (3, "Pumpe", "Heat Pumps"),
         (4, "Strom", "Electricity")], "product_key long, product_name string, category_name string")
    contracts = spark.createDataFrame([
        (5, date(2024, 1, 5), 1, 2, "Active"), (3, date(2024, 1, 9), 1, 2, "Active"),  # sale 3 came first
        (6, date(2024, 1, 1), 2, 3, "Active"), (7, date(2024, 1, 1), 3, 4, "Active"),
        (8, date(2024, 1, 1), 4, 2, "Inactive"), (9, date(2024, 1, 1), 5, 99, "Active"),
    ], "sale_id long, date date, customer_key long, product_key long, status string")
    owned = devices.first_acquisitions(contracts, products)
    assert by(owned, "customer_key")[1]["acquisition_date"] == date(2024, 1, 9)
    found = by(devices.device_registry(owned, products, enrolled_percent=100), "customer_key")
    assert set(found) == {1, 2}  # no hardware, inactive and unknown product drop out
    assert found[1][1:] == ("GW-00001", True, True, False, True, date(2024, 2, 8))
    assert found[2][1:] == ("GW-00002", False, False, True, False, None)
    assert not by(devices.device_registry(owned, products, enrolled_percent=0), "customer_key")[1]["is_vpp_enrolled"]


def test_gateway_of_a_long_key(spark):
    keys = spark.createDataFrame([(7,), (123456,), (7_654_321,)], "k long")
    assert [r[0] for r in keys.select(gateway_id(F.col("k"))).collect()] == ["GW-00007", "GW-123456", "GW-7654321"]


def test_ownership_sets(spark):
    owned = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b"), (4, "c")],
                                  "customer_key long, category_name string")
    assert devices.ownership_overlap(owned, "a", "b").first()[:] == (2, 2, 1, 1)
    everyone = spark.createDataFrame([(i,) for i in range(1, 6)], "customer_key long")
    assert sorted(r[0] for r in devices.owners_only(everyone, owned, "a").collect()) == [1, 2]
    assert sorted(r[0] for r in devices.non_owners_only(everyone, owned, "a").collect()) == [3, 4, 5]


def test_readings_of_unknown_customers_drop_out(spark):
    r = readings_at(spark, ("2024-01-01 00:00:00", 1, 0, 50, 0, 1), ("2024-01-01 00:00:00", 9, 0, 50, 0, 1))
    assert [x["customer_key"] for x in telemetry.enrich_readings(r, fleet(spark, (1, "North", True))).collect()] == [1]


def test_capacity_counts_devices_not_readings(spark):
    r = readings_at(spark, ("2024-01-01 00:00:00", 1, 1.0, 50.0, 0, 1.0), ("2024-01-01 00:30:00", 1, 2.0, 51.0, 0, 1.0),
                    ("2024-01-01 00:10:00", 2, 4.0, 10.0, 0, -5.0), ("2024-01-01 00:10:00", 3, 4.0, 10.0, 0, -5.0))
    d = fleet(spark, (1, "North", True), (2, "North", True), (3, "North", False))
    row = telemetry.capacity_hourly(r, d).first()
    assert row[:] == (datetime(2024, 1, 1), "North", 2, 111.0, 37.0, 7.0, 2.33, -3.0)


def test_margins_in_both_grains(spark):
    r = readings_at(spark, ("2024-01-01 10:20:00", 1, 1.0, 50.0, 0.5, -4.0), ("2024-01-01 11:20:00", 1, 0, 40.0, 0, 2.0))
    p = prices_at(spark, *[(f"2024-01-01 10:{m}:00", v) for m, v in (("00", 100.0), ("15", 200.0), ("30", 300.0), ("45", 400.0))])
    d = fleet(spark, (1, "North", True))
    bands = spark.createDataFrame([(150.0, 350.0)], "p25 double, p75 double")
    hourly = by(arbitrage.arbitrage_margins(r, d, p, bands=bands), "hour")
    sold = hourly[datetime(2024, 1, 1, 10)]
    assert (sold["price_eur_mwh"], sold["price_zone"], sold["net_margin_eur"]) == (250.0, "MEDIUM", 1.0)
    assert (sold["customer_margin_eur"], sold["operator_margin_eur"]) == (0.7, 0.3)
    unpriced = hourly[datetime(2024, 1, 1, 11)]
    assert (unpriced["price_zone"], unpriced["battery_action"]) == ("NO_PRICE_DATA", "SELF_CONSUME")
    assert (unpriced["price_eur_mwh"], unpriced["net_margin_eur"]) == (None, 0.0)
    interval = arbitrage.arbitrage_margins(r, d, p, price_grain="interval", bands=bands)
    assert sorted((x["price_zone"], x["net_margin_eur"]) for x in interval.collect()) == [
        ("HIGH", 1.6), ("LOW", 0.4), ("MEDIUM", 0.8), ("MEDIUM", 1.2), ("NO_PRICE_DATA", 0.0)]
    with pytest.raises(ValueError):
        arbitrage.arbitrage_margins(r, d, p, price_grain="day")


def test_shares_add_up_to_the_margin(spark):
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = [(str(start + timedelta(minutes=7 * i)), i % 3, 0.0, 50.0, 0.0, round(rng.uniform(-5, 5), 2)) for i in range(300)]
    p = prices_at(spark, *[(str(start + timedelta(minutes=15 * i)), round(rng.uniform(-50, 300), 2)) for i in range(140)])
    m = arbitrage.arbitrage_margins(readings_at(spark, *rows), fleet(spark, *[(i, "North", True) for i in range(3)]), p)
    assert m.count() == m.select("hour", "customer_key").distinct().count()
    gap = F.abs(F.col("customer_margin_eur") + F.col("operator_margin_eur") - F.col("net_margin_eur"))
    assert m.agg(F.max(gap)).first()[0] < 2e-4
    assert arbitrage.margin_by_zone(m).agg(F.sum("device_hours")).first()[0] == m.count()


def test_spine_and_gaps(spark):
    d = fleet(spark, (1, "North", True), (2, "North", False))
    assert telemetry.device_hours(d, "2024-01-01", "2024-01-03").count() == 2 * 72
    r = readings_at(spark, ("2024-01-01 05:59:00", 1, 0, 1, 0, 0), ("2024-01-01 05:01:00", 1, 0, 1, 0, 0))
    gaps = telemetry.coverage_gaps(r, d, "2024-01-01", "2024-01-01")
    assert gaps.groupBy("customer_key").count().orderBy("customer_key").collect()[0][1] == 23
    assert gaps.count() == 47


def test_backfill_days(spark):
    r = readings_at(spark, ("2024-01-01 05:59:00", 1, 0, 1, 0, 0))
    assert [x[0] for x in telemetry.backfill_days(r, "2024-01-03").collect()] == [date(2024, 1, 2), date(2024, 1, 3)]
    assert telemetry.backfill_days(r, "2024-01-01").count() == 0
    assert telemetry.backfill_days(r.limit(0), "2024-03-01").count() == 60


def test_dispatch_plan_bands(spark):
    d = fleet(spark, (1, "North", True), (2, "North", False))
    p = prices_at(spark, ("2024-01-01 00:00:00", -1.0), ("2024-01-01 01:00:00", 500.0))
    bands = spark.createDataFrame([(10.0, 100.0)], "p25 double, p75 double")
    plan = by(arbitrage.dispatch_plan(d, p, bands, "2024-01-01", "2024-01-01"), "customer_key", "hour")
    assert len(plan) == 48
    assert plan[1, datetime(2024, 1, 1, 0)]["soc_min"] == 85.0
    assert plan[1, datetime(2024, 1, 1, 1)]["grid_max_kw"] == -2.0
    assert plan[1, datetime(2024, 1, 1, 2)]["dispatch_zone"] == "NO_PRICE_DATA"
    assert plan[2, datetime(2024, 1, 1, 0)]["dispatch_zone"] == "NOT_ENROLLED"


def test_full_cycles_equal_a_plain_walk(spark):
    """One device with most of the readings, several hours, gaps, and a turn of the year."""
    rng = random.Random(3)
    rows, expected = [], {}
    for device, n in ((1, 400), (2, 40), (3, 1)):
        ts, before = datetime(2023, 12, 31, 20), None
        for _ in range(n):
            ts += timedelta(seconds=rng.choice([5, 60, 4000]))
            soc = float(rng.randint(0, 100))
            rows.append((str(ts), device, 0, soc, 0, 0))
            moved = abs(soc - before) if before is not None else 0.0
            expected[device, ts.year] = expected.get((device, ts.year), 0.0) + moved
            before = soc
    rng.shuffle(rows)
    found = by(telemetry.full_cycles(readings_at(spark, *rows)), "customer_key", "year")
    assert {k: r["full_cycles"] for k, r in found.items()} == pytest.approx({k: v / 200 for k, v in expected.items()})


def test_soc_zone_limits(spark):
    r = readings_at(spark, *[("2024-01-01 00:00:00", 1, 0, soc, 0, 0) for soc in (0, 9.9, 10, 29.9, 30, 89.9, 90, 100)])
    assert {x["soc_zone"]: x["readings"] for x in telemetry.soc_zone_dwell(r).collect()} == {
        "deep_discharge_guard": 2, "own_reserve": 2, "fleet_usable": 2, "top_buffer": 2}


def test_means_of_empty_groups_are_null(spark):
    r = readings_at(spark, ("2024-01-01 00:00:00", 1, 0, None, 0, 0))
    row = telemetry.capacity_hourly(r, fleet(spark, (1, "North", True))).first()
    assert row["avg_battery_soc_pct"] is None


def test_participation_pay(spark):
    r = readings_at(spark, ("2024-01-01 00:00:00", 1, 0, 50, 0, -100.0), ("2024-01-01 01:00:00", 1, 0, 50, 0, 10.0))
    p = prices_at(spark, ("2024-01-01 00:00:00", 50.0), ("2024-01-01 01:00:00", -200.0))
    m = arbitrage.arbitrage_margins(r, fleet(spark, (1, "North", True)), p)
    # 100 kWh exported at 0.05, and half of the 2 EUR earned on 10 kWh at -0.20 EUR/kWh
    assert arbitrage.participation_pay(m).first()[2:] == (50.0, 5.0, 1.0, 56.0)


def test_hot_gateway_is_reduced_before_the_shuffle(spark):
    """The plan must combine readings per hour and customer below the first exchange and the join."""
    margins = arbitrage.arbitrage_margins(
        readings_at(spark, ("2024-01-01 00:00:00", 1, 0, 50, 0, 1)), fleet(spark, (1, "North", True)),
        prices_at(spark, ("2024-01-01 00:00:00", 50.0)))
    plan = margins._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.index("Join") < plan.index("partial_sum")


def test_correlation_series(spark):
    r = readings_at(spark, *[(f"2024-01-01 0{h}:00:00", 1, 0, 90 - 10 * h, 0, 0) for h in range(4)])
    p = prices_at(spark, *[(f"2024-01-01 0{h}:00:00", 50.0 + h) for h in range(4)])
    d = fleet(spark, (1, "North", True))
    series = arbitrage.soc_and_price(telemetry.fleet_soc_by_hour(r, d), p, prices.price_bands(p, exact=True))
    assert arbitrage.soc_price_correlation(series).first()["soc_price_corr"] == pytest.approx(-1.0)


def test_gap_islands_against_the_spine(spark):
    draw = random.Random(3)
    rows = {(f"2024-01-{draw.randint(1, 4):02d} {draw.choice((0, 1, 2, 3, 21, 22, 23)):02d}:{draw.randint(0, 59):02d}:00", draw.randint(1, 5))
            for _ in range(150)}
    r = readings_at(spark, *[(ts, c, 0, 50, 0, 0) for ts, c in sorted(rows)])
    d = fleet(spark, *[(c, "North", True) for c in range(1, 7)])  # the sixth has no reading
    masks = telemetry.hour_masks(r)
    again = telemetry.merged_masks(masks, telemetry.hour_masks(r.where("customer_key < 3")), masks)
    assert sorted(again.collect()) == sorted(masks.collect())
    islands = telemetry.gap_islands(again, d, "2024-01-01", "2024-01-03").collect()
    hours = [(i.customer_key, i.first_hour + timedelta(hours=n)) for i in islands for n in range(i.missing_hours)]
    gaps = telemetry.coverage_gaps(r, d, "2024-01-01", "2024-01-03")
    assert sorted(hours) == sorted((g.customer_key, g.hour) for g in gaps.collect())
    assert all(i.last_hour == i.first_hour + timedelta(hours=i.missing_hours - 1) for i in islands)
    borders = {(i.customer_key, i.first_hour) for i in islands} & {(i.customer_key, i.last_hour + timedelta(hours=1)) for i in islands}
    assert not borders  # runs are as long as can be
    assert [i.missing_hours for i in islands if i.customer_key == 6] == [72]


def test_hours_without_a_reading_are_listed_after_the_join(spark):
    gaps = telemetry.coverage_gaps(readings_at(spark, ("2024-01-01 05:10:00", 1, 0, 0, 0, 0)), fleet(spark, (1, "R", True), (2, "R", True)), "2024-01-01", "2024-01-01")
    plan = gaps._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")  # the spine lies above the join, so it is never dealt
    assert gaps.count() == 23 + 24 and gaps.columns == ["customer_key", "hour", "gateway_id"]
