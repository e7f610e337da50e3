import json
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.helpers import by, fleet, price_document, readings_at, unix
from wattloom.plans.refresh import refresh
from wattloom.schemas import DATE, INT, TABLES, col, key, money, text
from wattloom.sources import csv_files, documents, gateway, layers

LAYOUT = StructType([key("id"), text("name", 6, True), col("day", DATE), money("amount", 6), col("n", INT)])

FILE = '''id,name,day,amount,n
1,plain,2024-01-05,1.50,3
2, "a, b" ,2024-01-05,1.5,3
3,"say ""x""", N/A ,NULL,
4,short
5,long,2024-01-05,1,2,extra,more
6,bad,2024-13-05,1,2
7,bad,2024-01-05,abc,2
8,,2024-01-05,1,2
9,toolong,2024-01-05,1,2
10,round,2024-01-05,1.005,2.5
x,key,2024-01-05,1,2
11,big,2024-01-05,99999.99,1
'''


def test_csv_rules(spark, tmp_path):
    (tmp_path / "t.csv").write_text(FILE)
    checked = csv_files.read_csv_checked(spark, str(tmp_path / "t.csv"), LAYOUT)
    good = by(csv_files.loaded_rows(checked), "id")
    assert set(good) == {1, 2, 4, 5, 10}
    assert good[2]["name"] == "a, b" and good[4]["day"] is None and good[4]["amount"] is None
    assert good[5]["n"] == 2 and good[10]["n"] == 3 and str(good[10]["amount"]) == "1.01"
    reasons = {r[csv_files.REASON] for r in csv_files.rejected_rows(checked).collect()}
    assert reasons == {"day: not a date", "amount: not a decimal(6,2)", "name: missing", "name: too long",
                       "id: not a int"}
    report = csv_files.load_report({"t": checked}).first()
    assert report[:] == ("t", 12, 5, 7)


def test_quoted_text_longer_than_allowed_is_the_reason_for_row_three(spark, tmp_path):
    (tmp_path / "t.csv").write_text(FILE)
    wide = StructType([key("id"), text("name", 60, True), *LAYOUT.fields[2:]])
    row = by(csv_files.loaded_rows(csv_files.read_csv_checked(spark, str(tmp_path / "t.csv"), wide)), "id")[3]
    assert row[1:] == ('say "x"', None, None, None)


def test_line_break_inside_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name,day,amount,n\n1,"a\nb",2024-01-05,1,2\n')
    rows = csv_files.loaded_rows(csv_files.read_csv_checked(spark, str(tmp_path / "t.csv"), LAYOUT, multi_line=True))
    assert rows.first()["name"] == "a\nb"


def test_table_layouts_are_complete():
    assert len(TABLES) == 23
    assert TABLES["sales_fact"]["amount"].dataType.simpleString() == "decimal(12,2)"


def test_document_scan(spark, tmp_path):
    for path, body in (("docs/energy/a.md", "# A"), ("docs/energy/b.PDF", "x"), ("docs/service/c.md", "# C\n## D"),
                       ("docs/service/d.csv", "1")):
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(body)
    found = documents.scan_documents(spark, str(tmp_path / "docs"), ("%.md", "%.pdf"))
    assert sorted(r["relative_path"] for r in found.collect()) == ["energy/a.md", "energy/b.PDF", "service/c.md"]
    whole = found.withColumn("relative_path", F.concat(F.lit("docs/"), "relative_path"))
    assert {r["title"] for r in documents.collection(whole, "energy").collect()} == {"a.md", "b.PDF"}
    assert len(documents.preview(whole, 2, 1).collect()) == 2


def test_gateway_message(spark):
    readings = {"battery_soc_pct": 8.25, "battery_power_kw": -0.4, "solar_yield_kw": 0.0, "grid_import_export_kw": 3.75, "heatpump_consumption_kw": 2.5}
    whole = {"gateway_id": "GW-77", "timestamp": "2025-11-02T06:07:08.9Z", "telemetry": readings,
             "status": {"online": False, "vpp_enabled": True, "error_code": "E4"}}
    without = {"gateway_id": "GW-78", "timestamp": "2025-11-02T06:07:09Z", "status": {"online": True}}
    values = [(json.dumps(whole),), ("not json",), (json.dumps(without),)]
    row = gateway.flatten_messages(spark.createDataFrame(values, "value string")).collect()
    assert row[0][:] == ("GW-77", datetime(2025, 11, 2, 6, 7, 8, 900000), 8.25, -0.4, 0.0, 3.75, 2.5, False, True, "E4")
    assert row[2][:] == ("GW-78", datetime(2025, 11, 2, 6, 7, 9), None, None, None, None, None, True, None, None)
    assert row[1]["gateway_id"] is None


def test_high_water_on_absent_empty_and_filled_targets(spark):
    source = spark.createDataFrame([(date(2024, 1, d), d) for d in (1, 2, 3)], "day date, v long")
    assert layers.after_high_water(source, None, "day").count() == 3
    assert layers.after_high_water(source, source.limit(0), "day").count() == 3
    filled = source.where("v <= 2")
    assert [r["v"] for r in layers.after_high_water(source, filled, "day").collect()] == [3]
    assert layers.after_high_water(source, filled, "day", inclusive=True).count() == 2


def test_late_rows(spark):
    target = spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 1, 5), 5)], "day date, k long")
    source = spark.createDataFrame([(date(2024, 1, d), d) for d in (1, 3, 5, 6)], "day date, k long")
    assert [r["k"] for r in layers.late_rows(source, target, "day", ["k"]).collect()] == [3]


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "k long, v string, p int")
    layers.upsert_partitions(start, path, ["k"], "p")
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "p=2").glob("*.parquet")}
    layers.upsert_partitions(spark.createDataFrame([(2, "B", 1), (4, "d", 1)], "k long, v string, p int"), path, ["k"], "p")
    rows = {(r["k"], r["v"], r["p"]) for r in spark.read.parquet(path).collect()}
    assert rows == {(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", 1)}
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "p=2").glob("*.parquet")} == untouched
    layers.upsert_partitions(spark.createDataFrame([(4, "D", 1)], "k long, v string, p int"), path, ["k"], "p",
                             listed_partitions=0)
    assert {r["v"] for r in spark.read.parquet(path).where("k = 4").collect()} == {"D"}


def test_merge_follows_the_new_layout(spark):
    target = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "k long, v string, gone long")
    updates = spark.createDataFrame([(2, "B", 1.5), (3, "c", 2.5)], "k long, v string, fresh double")
    merged = layers.merge_rows(target, updates, ["k"])
    assert merged.columns == ["k", "v", "fresh"]
    assert {tuple(r) for r in merged.collect()} == {(1, "a", None), (2, "B", 1.5), (3, "c", 2.5)}


def test_unknown_layer(tmp_path):
    try:
        layers.layer_path(str(tmp_path), "copper", "x")
    except ValueError as error:
        assert "copper" in str(error)
    else:
        raise AssertionError("no error")


def test_refresh_completes_a_partial_hour_and_is_idempotent(spark, tmp_path):
    prices = price_document(spark, ("2024-01-01", [unix("2024-01-01 10:00:00")], [100.0]),
                            ("2024-01-02", [unix("2024-01-02 10:00:00")], [200.0]))
    readings = readings_at(spark, ("2024-01-01 10:05:00", 1, 0, 50, 0, -1), ("2024-01-01 10:45:00", 1, 0, 60, 0, -2),
                           ("2024-01-02 10:05:00", 1, 0, 70, 0, -3))
    devices = fleet(spark, (1, "North", True))
    shared = {"customer_dim": devices.select("customer_key", "customer_name", "city", F.col("region").alias("state"),
                                             "customer_type"),
              "device_registry": devices.select("customer_key", "gateway_id", "has_solar", "has_battery", "has_heatpump",
                                                "is_vpp_enrolled", "enrollment_date")}
    bands = spark.createDataFrame([(0.0, 1000.0)], "p25 double, p75 double")
    root = str(tmp_path)
    cut = {"raw_day_ahead_prices": prices.where("fetch_date = date'2024-01-01'"),
           "telemetry": readings.where("ts < timestamp_ntz'2024-01-01 10:30:00'")}
    refresh({**shared, **cut}, root, bands)
    for _ in range(2):
        paths = refresh({**shared, "raw_day_ahead_prices": prices, "telemetry": readings}, root, bands)
        margins = {r["hour"]: r["net_margin_eur"] for r in spark.read.parquet(paths["arbitrage"]).collect()}
        assert margins == {datetime(2024, 1, 1, 10): 0.3, datetime(2024, 1, 2, 10): 0.6}
        assert spark.read.parquet(paths["capacity"]).count() == 2
        assert spark.read.parquet(paths["telemetry"]).count() == 3
        assert spark.read.parquet(paths["raw_prices"]).count() == 2
