"""Compare each registered query with its SQL on the same tables: columns, types, rows and values."""

from __future__ import annotations

import argparse
import math
import time

import duckdb

import catalog.all_queries  # noqa: F401  (registers the queries)
from catalog.registry import CATALOG, run
from wattloom.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


SPARK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
               "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the Spark result and the SQL result; empty if nothing does."""
    cursor = con.execute(sql)
    theirs = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    ours = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    found = []
    if set(ours) != set(theirs):
        return [f"columns: only Spark {set(ours) - set(theirs)}, only SQL {set(theirs) - set(ours)}"]
    found += [f"type of {c}: {ours[c]} / {theirs[c]}" for c in sorted(ours) if ours[c] != theirs[c]]
    names = sorted(ours)
    start = time.time()
    collected = df.collect()
    found_in = time.time() - start
    rows = sorted((tuple(row[c] for c in names) for row in collected), key=_order)
    position = {c: i for i, c in enumerate(theirs)}
    wanted = sorted((tuple(row[position[c]] for c in names) for row in expected), key=_order)
    if len(rows) != len(wanted):
        found.append(f"rows: {len(rows)} / {len(wanted)}")
    bad = [(a, b) for a, b in zip(rows, wanted) if not all(map(_same, a, b))]
    if bad:
        found.append(f"{len(bad)} rows differ, first: {dict(zip(names, bad[0][0]))} / {dict(zip(names, bad[0][1]))}")
    if not rows:
        found.append("no rows")
    print(f"     spark {found_in:.2f}s, {len(rows)} rows", end="  ")
    return found


def _order(row):
    return tuple((v is None, "" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    options = parser.parse_args()
    sf_dir = f"/root/testdata/sf{options.sf}"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, entry in CATALOG.items():
        if options.names and name not in options.names:
            continue
        start = time.time()
        try:
            df = run(name, spark, sf_dir)
            found = differences(df, con, entry.sql) if entry.sql else [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {'' if entry.sql else '(rows only)'}",
              *found, sep="\n      " if found else " ", flush=True)
    print(f"{failed} failed of {len(options.names or CATALOG)}")


if __name__ == "__main__":
    main()
