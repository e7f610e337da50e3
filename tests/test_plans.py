"""What the plans must show: filters in the scan, few columns read, rows reduced before joins."""

import subprocess
import sys
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from tests.helpers import fleet, prices_at, readings_at
from wattloom.operators import prices, telemetry
from wattloom.plans import models, questions
from wattloom.session import small_side
from wattloom.sources import layers


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # show filters in full
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_price_window_reaches_the_scan(spark, tmp_path):
    table = stored(spark, prices_at(spark, ("2024-01-01 00:00:00", 1.0)), tmp_path / "p")
    plan = plan_of(prices.price_range_by_day(table, "2024-01-29", 7))
    assert "GreaterThanOrEqual(start_time,2024-01-23T00:00)" in plan
    assert "LessThan(start_time,2024-01-30T00:00)" in plan


def test_high_water_mark_reaches_the_scan(spark, tmp_path):
    table = stored(spark, readings_at(spark, ("2024-01-01 00:00:00", 1, 0, 1, 0, 0)), tmp_path / "r")
    plan = plan_of(layers.after_high_water(table, table, "ts"))
    assert "GreaterThan(ts,2024-01-01T00:00)" in plan


def test_capacity_reads_only_its_columns(spark, tmp_path):
    readings = stored(spark, readings_at(spark, ("2024-01-01 00:00:00", 1, 0, 1, 0, 0)), tmp_path / "r")
    devices = stored(spark, fleet(spark, (1, "North", True)), tmp_path / "d")
    plan = plan_of(telemetry.capacity_hourly(readings, devices))
    assert "ReadSchema: struct<customer_key:bigint,region:string,is_vpp_enrolled:boolean>" in plan
    assert "heatpump" not in plan and "gateway_id" not in plan


def test_metrics_reduce_before_the_join(spark, tmp_path):
    """With one foreign key the fact table is aggregated below the join."""
    readings = stored(spark, readings_at(spark, ("2024-01-01 00:00:00", 1, 0, 1, 0, 0)), tmp_path / "r")
    devices = stored(spark, fleet(spark, (1, "North", True)), tmp_path / "d")
    model = models.telemetry_model({"telemetry": readings, "devices": devices})
    plan = plan_of(model.query(["avg_battery_soc"], ["region"]))
    join = plan.index("Join")
    assert "partial_sum" in plan[join:] and "partial_sum" in plan[:join]


def test_small_side_checks_the_size(spark):
    rows = spark.range(10)
    big = spark.range(100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(big.join(small_side(rows, 10), "id"))
        assert "SortMergeJoin" in plan_of(big.join(small_side(rows, 9), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_partition_gives_the_mark(spark, tmp_path):
    rows = readings_at(spark, ("2024-01-01 10:00:00", 1, 0, 1, 0, 0), ("2024-01-02 08:00:00", 1, 0, 1, 0, 0))
    layers.append(rows.withColumn("day", F.to_date("ts")), str(tmp_path / "t"), ("day",))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert layers.high_water(table, "ts", "day") == datetime(2024, 1, 2, 8)


def test_scratch_follows_the_cluster_setting(tmp_path):
    """In a process of its own, because the setting belongs to the start of a session."""
    code = ("from wattloom import build_session, scratch_path\n"
            f"s = build_session('x', 'local[1]', **{{'spark.checkpoint.dir': '{tmp_path}', 'spark.ui.enabled': 'false'}})\n"
            "print(scratch_path(s, 'a'))\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                          cwd=Path(__file__).resolve().parents[1])
    assert done.stdout.strip().startswith(f"{tmp_path}/a-")


def test_top_rows_of_each_group_are_cut_before_the_shuffle(spark):
    rows = spark.range(2000).selectExpr("id", "if(id % 3 = 0, null, id % 7) as area", "if(id < 5, null, id % 50) as size")
    found = questions.top_per_group(rows, "area", "size", "id", k=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan.split("Exchange")[-1]
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.area, []).append(r)
    for area, own in groups.items():
        own.sort(key=lambda r: (r.size is None, -(r.size or 0), r.id))
        groups[area] = [(r.id, i + 1) for i, r in enumerate(own[:3])]
    assert {(r.area, r.id, r["rank"]) for r in found.collect()} == {(a, *x) for a, own in groups.items() for x in own}
