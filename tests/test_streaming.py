from datetime import datetime

from pyspark.sql import functions as F

from tests.helpers import fleet, prices_at, readings_at
from wattloom.operators.prices import hourly_prices
from wattloom.streaming import jobs

FIRST = [("2024-01-01 10:05:00", 1, 0, 50, 0, 1), ("2024-01-01 10:40:00", 2, 0, 30, 0, 2)]
SECOND = [("2024-01-01 11:05:00", 1, 0, 55, 0, 3), ("2024-01-01 10:50:00", 1, 0, 60, 0, 4)]
THIRD = [("2024-01-01 16:00:00", 1, 0, 70, 0, 5), ("2024-01-01 10:59:00", 2, 0, 99, 0, 6)]
FOURTH = [("2024-01-01 10:15:00", 2, 0, 99, 0, 7), ("2024-01-01 17:00:00", 1, 0, 70, 0, 5)]


def write(spark, folder, *rows):
    readings_at(spark, *rows).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return jobs.file_stream(spark, folder, spark.read.parquet(folder).schema)


def test_hours_are_emitted_once_they_are_closed(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    devices = fleet(spark, (1, "North", True), (2, "North", True))
    results = []
    for rows in (FIRST, SECOND, THIRD, FOURTH):
        write(spark, source, *rows)
        jobs.run_available(jobs.capacity_stream(stream(spark, source), devices), out, state)
        results.append({r["hour"]: (r["readings"], r["approx_active_devices"], float(r["net_grid_kw"]))
                        for r in spark.read.parquet(out).collect()})
    assert results[0] == results[1] == {}
    # the third file moves the watermark to 14:00; its own 10:59 row still counts, the fourth file's 10:15 is too late
    assert results[2] == {datetime(2024, 1, 1, 10): (4, 2, 13.0), datetime(2024, 1, 1, 11): (1, 1, 3.0)}
    assert results[3] == results[2]


def test_second_run_takes_only_new_files(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows, expected in ((FIRST, 2), (SECOND, 4)):
        write(spark, source, *rows)
        for _ in range(2):
            jobs.run_available(stream(spark, source), out, state)
            assert spark.read.parquet(out).count() == expected


def test_redelivered_readings_count_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in (FIRST, FIRST + SECOND, SECOND):
        write(spark, source, *rows)
        jobs.run_available(jobs.deduplicated_stream(stream(spark, source), ["gateway_id", "ts"]), out, state)
    assert spark.read.parquet(out).count() == 4


def test_upsert_over_several_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in (FIRST, SECOND, THIRD, FOURTH[:1]):  # the last one is older than what is stored
        write(spark, source, *rows)
        latest = stream(spark, source).select("customer_key", F.to_date("ts").alias("day"), "ts", "battery_soc_pct")
        jobs.upsert_available(latest, out, state, ["customer_key", "day"], "day", "ts")
    found = {r["customer_key"]: (r["ts"], r["battery_soc_pct"]) for r in spark.read.parquet(out).collect()}
    assert found == {1: (datetime(2024, 1, 1, 16), 70.0), 2: (datetime(2024, 1, 1, 10, 59), 99.0)}


def test_stream_meets_static_prices(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write(spark, source, *FIRST, *SECOND)
    prices = hourly_prices(prices_at(spark, ("2024-01-01 10:00:00", 40.0), ("2024-01-01 10:15:00", 60.0)))
    jobs.run_available(jobs.priced_stream(stream(spark, source), prices), out, state)
    assert sorted((r["ts"].hour, r["price_eur_mwh"]) for r in spark.read.parquet(out).collect()) == [
        (10, 50.0), (10, 50.0), (10, 50.0), (11, None)]


def test_late_rows_are_kept_apart_and_a_replay_changes_nothing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = readings_at(spark, *FIRST).schema
    seen = []
    for rows in (FIRST, SECOND, THIRD, FOURTH):
        write(spark, source, *rows)
        jobs.route_late(stream(spark, source), out, state)
        found = jobs.routed(spark, out, schema)
        seen.append({(r.ts.strftime("%H:%M"), r.grid_import_export_kw, r.late) for r in found.collect()})
    # the third delivery's 10:59 comes after 11:05 was seen, within two hours; the fourth's 10:15 after 16:00
    assert {r for r in seen[-1] if r[2]} == {("10:15", 7.0, True)}
    assert len(seen[-1]) == 8 and seen[0] < seen[1] < seen[2] < seen[3]
    assert sorted(found.drop("late").collect()) == sorted(spark.read.parquet(source).collect())
    # the last batch is taken once more, as after a lost driver: its commit is missing
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].unlink()
    (tmp_path / "state" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    jobs.route_late(stream(spark, source), out, state)
    found = jobs.routed(spark, out, schema)
    assert {(r.ts.strftime("%H:%M"), r.grid_import_export_kw, r.late) for r in found.collect()} == seen[-1] and found.count() == 8
