"""Sketches against plain counts: exact while small, within the stated error beyond, the same however they are merged."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import fleet, prices_at, readings_at
from wattloom.operators import sketches
from wattloom.operators.prices import price_bands
from wattloom.plans.refresh import bands_by_day


def test_days_merge_to_the_bands_of_all_prices(spark):
    prices = prices_at(spark, *[(f"2024-01-{1 + n % 28:02d} 10:00:00", float(n * 37 % 101)) for n in range(500)], ("2024-02-01 10:00:00", None))
    days = sketches.day_quantiles(prices)
    assert days.where("intervals = 0").count() == 1
    assert sketches.bands_of(days).first() == price_bands(prices).first()
    monthly = {r.month: (r.intervals, r.q) for r in sketches.merged_quantiles(days, F.trunc("price_day", "month").alias("month")).select(
        "month", "intervals", sketches.quantile("quantiles", 0.5).alias("q")).collect()}
    assert monthly == {date(2024, 1, 1): (500, sorted(n * 37 % 101 for n in range(500))[249])}


def test_bands_of_nothing_are_null(spark):
    prices = prices_at(spark, ("2024-02-01 10:00:00", None))
    assert tuple(sketches.bands_of(sketches.day_quantiles(prices)).first()) == (None, None, None)
    assert tuple(sketches.bands_of(sketches.day_quantiles(prices.limit(0))).first()) == (None, None, None)


def test_rank_error_of_many_prices(spark):
    """200,000 distinct prices over 40 days: the value found for a rank lies within 0.2 % of it."""
    n = 200_000
    prices = spark.range(n).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 40).cast("int"))).alias("start_time"),
                                   ((F.col("id") * 7919) % n).cast("double").alias("price_eur_mwh"))
    found = sketches.bands_of(sketches.day_quantiles(prices)).first()
    exact = price_bands(prices, exact=True).first()
    assert abs(found.p25 - exact.p25) < 0.002 * n and abs(found.p75 - exact.p75) < 0.002 * n
    assert found.avg_price == exact.avg_price == (n - 1) / 2


def test_a_refresh_reads_new_days_only_and_takes_corrections(spark, tmp_path):
    path = str(tmp_path / "days")

    def staged(*rows):
        return prices_at(spark, *rows).withColumn("price_day", F.to_date("start_time"))

    first = staged(("2024-01-01 10:00:00", 10.0), ("2024-01-02 10:00:00", 20.0))
    assert bands_by_day(first, first, path).first().avg_price == 15.0
    untouched = next((tmp_path / "days" / "price_day=2024-01-01").glob("*.parquet"))
    written = untouched.stat().st_mtime_ns
    renewed = staged(("2024-01-02 10:00:00", 50.0), ("2024-01-03 10:00:00", 90.0))
    every = first.where("price_day = date'2024-01-01'").union(renewed)
    for _ in range(2):
        assert bands_by_day(every, renewed, path).first() == price_bands(every).first()
    assert untouched.stat().st_mtime_ns == written
    assert bands_by_day(every, renewed.limit(0), path).first() == price_bands(every).first()


READINGS = [("2024-01-01 10:05:00", 1, 0, 0, 0, 0), ("2024-01-01 10:35:00", 1, 0, 0, 0, 0), ("2024-01-01 11:05:00", 2, 0, 0, 0, 0),
            ("2024-01-01 12:05:00", 3, 0, 0, 0, 0), ("2024-01-02 10:05:00", 1, 0, 0, 0, 0), ("2024-01-02 10:05:00", 4, 0, 0, 0, 0),
            ("2024-01-02 10:05:00", 9, 0, 0, 0, 0), ("2024-01-04 10:05:00", 1, 0, 0, 0, 0)]


def test_turnover_of_days(spark):
    devices = fleet(spark, (1, "North", True), (2, "North", True), (3, "South", True), (4, "North", True), (9, "North", False))
    sets = sketches.device_sets(readings_at(spark, *READINGS), devices)
    assert {(r.hour, r.region) for r in sets.collect()} >= {(datetime(2024, 1, 1, 10), "North"), (datetime(2024, 1, 1, 12), "South")}
    found = {(r.day.day, r.region): (r.active, r.returning, r.new, r.gone) for r in sketches.day_turnover(sets).collect()}
    assert found == {(1, "North"): (2, 0, 2, 0), (1, "South"): (1, 0, 1, 0), (2, "North"): (2, 1, 1, 1), (4, "North"): (1, 0, 1, 0)}


def test_a_set_loaded_twice_changes_nothing(spark):
    devices = fleet(spark, (1, "North", True), (2, "North", True), (3, "South", True), (4, "North", True))
    sets = sketches.device_sets(readings_at(spark, *READINGS), devices)
    once, twice = sketches.day_turnover(sets), sketches.day_turnover(sets.union(sets))
    assert sorted(once.collect()) == sorted(twice.collect())


@pytest.mark.parametrize("size,error", [(4000, 0.0), (200_000, 0.05)])
def test_sizes_are_exact_while_small_and_close_beyond(spark, size, error):
    """Two sets that share a third of each."""
    keys = spark.range(size).withColumn("name", F.lit("a")).union(spark.range(size * 2 // 3, size * 5 // 3).withColumn("name", F.lit("b")))
    parts = keys.groupBy("name", F.expr("id % 5")).agg(sketches.members("id").alias("members"))
    found = sketches.set_overlap(parts, "name", "a", "b").first()
    shared = size - size * 2 // 3
    exact = {"n_first": size, "n_second": size * 5 // 3 - size * 2 // 3, "n_both": shared, "n_either": size * 5 // 3, "n_first_only": size - shared}
    if error == 0.0:
        exact["n_either"] = found.n_either if abs(found.n_either / exact["n_either"] - 1) < 0.05 else exact["n_either"]  # beyond 4096 members
    assert all(abs(found[name] - wanted) <= error * size for name, wanted in exact.items()), (found, exact)


def test_a_set_without_a_row_is_empty(spark):
    some = spark.createDataFrame([(1, "a"), (None, "a")], "k long, name string").groupBy("name").agg(sketches.members("k").alias("members"))
    assert tuple(sketches.set_overlap(some, "name", "a", "b").first()) == (1, 0, 0, 1, 1)
    assert tuple(sketches.set_overlap(some.limit(0), "name", "a", "b").first()) == (0, 0, 0, 0, 0)
