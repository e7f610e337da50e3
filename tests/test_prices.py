from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import by, price_document, prices_at, unix
from wattloom.operators import prices
from wattloom.operators.arbitrage import zoned_prices
from wattloom.sources import price_documents as docs

T0 = unix("2024-01-01 00:00:00")
QUARTER = 900


def test_price_list_shorter_longer_null_and_empty(spark):
    raw = price_document(
        spark,
        ("2024-01-01", [T0, T0 + QUARTER], [1.5]),
        ("2024-01-02", [T0 + 86400], [2.5, 9.0, 9.0]),
        ("2024-01-03", [T0 + 172800, T0 + 173700], [None, -3.0]),
        ("2024-01-04", [], []))
    rows = [(r["start_time"], r["price_eur_mwh"]) for r in prices.stage_prices(raw).orderBy("start_time").collect()]
    assert rows == [
        (datetime(2024, 1, 1, 0, 0), 1.5), (datetime(2024, 1, 1, 0, 15), None), (datetime(2024, 1, 2, 0, 0), 2.5),
        (datetime(2024, 1, 3, 0, 0), None), (datetime(2024, 1, 3, 0, 15), -3.0)]


def test_repeated_interval_keeps_the_later_document(spark):
    raw = price_document(spark, ("2024-01-01", [T0], [1.0]), ("2024-01-02", [T0], [2.0]))
    assert [r["price_eur_mwh"] for r in prices.stage_prices(raw).collect()] == [2.0]
    assert prices.stage_prices(raw, dedup=False).count() == 2


@pytest.mark.parametrize("start, end, expected", [
    ("2024-03-29 21:00:00", "2024-03-31 20:00:00", {date(2024, 3, 30): 96, date(2024, 3, 31): 92}),
    ("2024-10-25 20:00:00", "2024-10-27 21:00:00", {date(2024, 10, 26): 96, date(2024, 10, 27): 100}),
])
def test_delivery_days_across_clock_changes(spark, start, end, expected):
    times = list(range(unix(start), unix(end), QUARTER))
    raw = price_document(spark, ("2024-01-01", times, [1.0] * len(times)))
    found = docs.to_delivery_days(raw).select("fetch_date", F.size(docs.parsed()["unix_seconds"]).alias("n"))
    assert {r["fetch_date"]: r["n"] for r in found.collect()} == expected


def test_delivery_day_turns_at_ten_in_the_evening(spark):
    times = [unix("2024-01-01 20:45:00"), unix("2024-01-01 21:00:00")]  # 21:45 and 22:00 in Berlin
    days = docs.to_delivery_days(price_document(spark, ("2024-01-01", times, [1.0, 2.0])))
    points = days.select("fetch_date", docs.parsed()["price"].alias("p")).collect()
    assert {r["fetch_date"]: r["p"] for r in points} == {date(2024, 1, 1): [1.0], date(2024, 1, 2): [2.0]}


def test_delivery_day_keeps_a_missing_price(spark):
    days = docs.to_delivery_days(price_document(spark, ("2024-01-01", [T0, T0 + QUARTER], [5.0])))
    assert days.select(docs.parsed()["price"].alias("p")).first()["p"] == [5.0, None]


def test_ingest_is_idempotent(spark):
    stored = price_document(spark, ("2024-01-01", [T0], [1.0]))
    incoming = price_document(spark, ("2024-01-01", [T0], [9.0]), ("2024-01-02", [T0 + 86400], [2.0]))
    added = docs.new_documents(stored, incoming)
    assert [r["fetch_date"] for r in added.collect()] == [date(2024, 1, 2)]
    assert docs.ingest_report(stored, incoming).first().asDict() == {"inserted": 1, "skipped": 1}
    assert docs.new_documents(stored.unionByName(added.select(*stored.columns)), incoming).count() == 0
    assert docs.missing_days(stored.unionByName(added.select(*stored.columns)), "2024-01-03", 3).collect()[0][0] \
        == date(2024, 1, 3)


def test_documents_are_read_from_files(spark, tmp_path):
    (tmp_path / "prices_2024-02-03.json").write_text('{"unix_seconds": [%d], "price": [4.0]}' % T0)
    row = prices.stage_prices(docs.read_price_documents(spark, str(tmp_path))).first()
    assert (row["fetch_date"], row["price_eur_mwh"]) == (date(2024, 2, 3), 4.0)


def test_zones_at_the_edges(spark):
    rows = [("2024-01-01 00:00:00", -0.01), ("2024-01-01 00:15:00", 0.0), ("2024-01-01 00:30:00", 50.0),
            ("2024-01-01 00:45:00", 100.0), ("2024-01-01 01:00:00", 100.01), ("2024-01-01 01:15:00", None)]
    bands = spark.createDataFrame([(50.0, 100.0)], "p25 double, p75 double")
    found = by(zoned_prices(prices_at(spark, *rows), bands), "price_eur_mwh")
    assert {p: (r["price_zone"], r["battery_action"]) for p, r in found.items()} == {
        -0.01: ("NEGATIVE", "MAX_CHARGE"), 0.0: ("LOW", "CHARGE"), 50.0: ("MEDIUM", "SELF_CONSUME"),
        100.0: ("MEDIUM", "SELF_CONSUME"), 100.01: ("HIGH", "DISCHARGE"), None: ("NO_PRICE_DATA", "SELF_CONSUME")}


def test_zones_with_a_lower_quartile_below_zero(spark):
    bands = spark.createDataFrame([(-5.0, 10.0)], "p25 double, p75 double")
    rows = zoned_prices(prices_at(spark, ("2024-01-01 00:00:00", -1.0)), bands).collect()
    assert rows[0]["price_zone"] == "NEGATIVE"


def test_exact_and_sketched_bands(spark):
    p = prices_at(spark, *[(f"2024-01-01 0{i}:00:00", float(i)) for i in range(1, 5)])
    assert prices.price_bands(p, exact=True).first()[:] == (1.75, 3.25, 2.5)
    assert prices.price_bands(p).first()[:] == (1.0, 3.0, 2.5)


def test_price_per_kwh_rounds_on_decimal_digits(spark):
    p = prices_at(spark, ("2024-01-01 00:00:00", 12.45), ("2024-01-01 00:15:00", -12.45))
    values = p.select(prices.per_kwh(F.col("price_eur_mwh")).alias("v")).collect()
    assert [r["v"] for r in values] == [0.0125, -0.0125]


def test_household_price_matches_the_worked_example(spark):
    row = prices.household_price(prices_at(spark, ("2024-01-01 00:00:00", 80.0))).first()
    assert (row["spot_ct_kwh"], row["end_price_ct_kwh"]) == (8.0, 21.05)


def test_peak_hours_are_eight_to_twenty(spark):
    p = prices_at(spark, *[(f"2024-01-01 {h:02d}:00:00", 1.0 if 8 <= h < 20 else 3.0) for h in range(24)])
    assert prices.base_and_peak_load(p).first()[1:] == (2.0, 1.0)


def test_means_of_hourly_means_keep_their_digits(spark):
    thirds = [("2024-01-01 09:00:00", 1.0), ("2024-01-01 09:15:00", 1.0), ("2024-01-01 09:30:00", 2.0), ("2024-01-01 10:00:00", 1.0)]
    found = prices.base_and_peak_load(prices_at(spark, *thirds)).first()
    assert abs(found.baseload - 7 / 6) < 1e-9 and abs(found.peakload - 7 / 6) < 1e-9


def test_highest_price_reports_its_first_time(spark):
    p = prices_at(spark, ("2024-01-01 05:00:00", 9.0), ("2024-01-01 03:00:00", 9.0), ("2024-01-01 01:00:00", 1.0))
    row = prices.highest_prices(p, "2024-01-01", 1).first()
    assert (row["max_price"], row["peak_start"]) == (9.0, datetime(2024, 1, 1, 3))


def test_incomplete_days(spark):
    p = prices_at(spark, ("2024-01-01 05:00:00", 9.0))
    assert prices.incomplete_days(p).first()[1:] == (1, 95)
