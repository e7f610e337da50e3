"""The domain tables take every row of the test tables."""

import datetime as dt

import catalog.all_queries  # noqa: F401  (registers the queries)
from catalog.registry import run
from wattloom.sources.testdata import LAYOUTS, Domain


def domain(spark, path, **tables):
    for name, rows in tables.items():
        spark.createDataFrame(rows, LAYOUTS[name]).write.parquet(f"{path}/{name}.parquet")
    return Domain(spark, str(path))


def line(order, part, number):
    return (order, part, 1, number, 1.0, 10.0, 0.0, 0.0, "N", "O", dt.datetime(2024, 1, 5))


def test_every_order_line_is_a_contract(spark, tmp_path):
    d = domain(spark, tmp_path, lineitem=[line(1, 10, 1), line(1, 11, 2), line(2, 12, 2), line(2, 10, 3)],
               orders=[(k, 7, "O", 10.0, dt.datetime(2024, 1, k), "2-HIGH") for k in (1, 2)],
               part=[(p, f"part {p}", "B", "PROMO", 1, 5.0) for p in (10, 11, 12)])
    assert {(r.sale_id, r.product_key) for r in d["contracts"].collect()} == {(9, 10), (10, 11), (18, 12), (19, 10)}  # order * 8 + line
    owned = {r.product_key: r.acquisition_date.day for r in d["customer_products"].collect()}
    assert owned == {10: 1, 11: 1, 12: 2}


def test_every_event_is_a_price(spark, tmp_path):
    days = [dt.datetime(2024, 1, 29, 23, 50), dt.datetime(2024, 1, 30), dt.datetime(2025, 6, 1, 8)]
    d = domain(spark, tmp_path, events=[(i, ts, 1, "click", 20.0, '{"k": 1}') for i, ts in enumerate(days)])
    assert d["price_slots"].count() == 3


def test_ticket_search_finds_later_turns(spark, tmp_path):
    turns = [(1, 0, "user", "hello there"), (1, 1, "assistant", "battery is broken"), (1, 2, "user", "my battery is broken"), (2, 0, "user", "a battery")]
    domain(spark, tmp_path, conversations=turns, benchmark=[(0, "broken battery")])
    found = run("ticket_search", spark, str(tmp_path)).collect()
    assert [(r.conv_id, r.turn) for r in found] == [(1, 2), (2, 0)]


def test_products_of_every_size_count_in_the_best_region(spark, tmp_path):
    domain(spark, tmp_path, region=[(1, "NORTH"), (2, "SOUTH")], nation=[(1, "N1", 1), (2, "N2", 2)],
           customer=[(1, "C1", 1, 0.0, "m"), (2, "C2", 2, 0.0, "m")], supplier=[(1, "S", 1, 0.0)],
           orders=[(1, 1, "O", 10.0, dt.datetime(2024, 1, 1), "2-HIGH"), (2, 2, "O", 10.0, dt.datetime(2024, 1, 1), "2-HIGH")],
           part=[(10, "small", "B", "ECONOMY", 1, 5.0), (11, "large", "B", "ECONOMY", 40, 5.0), (12, "other", "B", "PROMO", 1, 5.0)],
           lineitem=[line(1, 10, 1), line(2, 11, 1), line(2, 11, 2), line(1, 12, 2), line(1, 12, 3)])
    assert [tuple(r) for r in run("best_region_for_heatpumps", spark, str(tmp_path)).collect()] == [("SOUTH", 20.0)]


def test_late_prices_of_every_hour(spark, tmp_path):
    times = [dt.datetime(2024, 1, 10, h) for h in range(24)] + [dt.datetime(2024, 1, 20, 8), dt.datetime(2024, 1, 21)]
    domain(spark, tmp_path, events=[(i, ts, 1, "click", 20.0, '{"k": 1}') for i, ts in enumerate(times)])
    assert {r.start_time for r in run("late_price_rows", spark, str(tmp_path)).collect()} == set(times[:24])
