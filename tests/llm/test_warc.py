import hashlib

import pytest

from wattloom.llm import warc

BIG = "ä" * 600
RECORD = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAYLOADS = [
    "", None, "short", "short", BIG, BIG, BIG, f"x{warc.MAGIC}y", warc.MAGIC, RECORD, f"{RECORD}{RECORD}tail", "\r\n\r\n",
    f"{warc.MAGIC}Content-Length: 999999999\r\n\r\n", f"{warc.MAGIC}Content-Length: 99999999999999999999\r\n\r\n", "WARWARC/1.0\r\r\n",
    "z" * 3000 + RECORD * 40, "\U0001f600\n" * 900, "WARC/1.0\n", f"{warc.MAGIC}{warc.MAGIC}"]


def brute(rows):
    full = [(i, (h or "").encode()) for i, _, h in rows]
    want = []
    for i, data in full:
        carrier = max((j for j, d in full if d == data and j is not None), default=None)
        revisit = len(data) >= 1000 and carrier is not None and i != carrier
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", carrier if revisit else None))
    return sorted(want, key=str)


@pytest.mark.parametrize("split", ["128m", "700b"])
def test_round_trip(spark, split):
    rows = [(i, f"http://h/{i}\r\nWARC-Type: x", h) for i, h in enumerate(PAYLOADS)]
    rows += [(6, None, BIG), (None, "u", BIG), (None, "u", "lost"), (-5, "u", "neg")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = warc.round_trip(pages, records_per_file=7).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string, bytes string")).collect() == []
