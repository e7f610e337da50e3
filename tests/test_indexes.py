"""Stored name and vector indexes against the plain lookups."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wattloom.operators import vector_index
from wattloom.operators.name_index import NameIndex
from wattloom.operators.resolve import resolve_literal
from wattloom.operators.vector_index import VectorIndex


def names(seed, count):
    pick = random.Random(seed)
    return ["".join(pick.choice("abeimnrsüöß -") for _ in range(pick.randint(0, 9))) for _ in range(count)]


def test_names_equal_the_plain_lookup(spark, tmp_path):
    held = [*names(1, 400), "Max Müller", "Maxi Meier", "Max Müller", None]
    plain = spark.createDataFrame([(n,) for n in held], "name string")
    index = NameIndex(spark, str(tmp_path / "names"), 8)
    index.add(plain, "name")
    more = spark.createDataFrame([(n,) for n in [*names(2, 100), "Max Müller", "Mux Maller"]], "name string")
    for typed in ("Mueller", "max", "b", "", "anna berns", "qqq zzz"):
        assert index.resolve(typed).collect() == resolve_literal(plain, "name", typed).collect(), typed
    index.add(more, "name")
    index.add(more, "name")
    both = plain.union(more)
    for typed in ("Mueller", "max", "anna berns"):
        assert index.resolve(typed, 9).collect() == resolve_literal(both, "name", typed, 9).collect(), typed
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # for the plan to tell which buckets it reads
    try:
        plan = index.resolve("max")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount" in plan and "SelectedBucketsCount: 8 out of 8" not in plan


def vectors(spark, count, width=12):
    pick = random.Random(3)
    middle = [[pick.gauss(0, 1) for _ in range(width)] for _ in range(20)]
    rows = [(i, [m + pick.gauss(0, 0.4) for m in middle[0 if i % 3 == 0 else i % 20]]) for i in range(count)]
    rows += [(count, rows[0][1]), (count + 1, [0.0] * width), (count + 2, None)]
    return rows, spark.createDataFrame(rows, "id long, v array<float>")


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))


def test_vector_index(spark, tmp_path):
    rows, df = vectors(spark, 900)
    index = VectorIndex(spark, str(tmp_path / "vectors"))
    index.build(df, "id", "v", 24)
    assert index.vectors().count() == len(rows)  # none is left out
    usable = [(i, v) for i, v in rows if v and any(v)]
    queries = [(i, v) for i, v in usable if i % 20 == 0]
    exact = {i: sorted(((-cosine(v, w), j) for j, w in usable))[:5] for i, v in queries}
    for i, v in queries[:6]:
        found = index.search(v, 5, 2, exact=True).collect()
        assert [r.cosine for r in found] == pytest.approx([-c for c, _ in exact[i]], abs=2e-6)
    all_found = index.search_all(df.where("id % 20 = 0"), "id", "v", 5).collect()
    hits = sum(r.key in {j for _, j in exact[r.query]} for r in all_found)
    assert len(all_found) == 5 * len(queries) and hits >= 0.9 * len(all_found)
    plan = index.search(queries[0][1], 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    with pytest.raises(ValueError):
        index.search([0.0] * 12)


def test_empty_vector_table(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "none"))
    index.build(spark.createDataFrame([], "id long, v array<float>"), "id", "v")
    assert index.search([1.0, 0.0]).count() == 0 and index.vectors().where(F.col("cell") >= 0).count() == 0


def test_search_of_many_queries_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "PART", 50)  # several parts of a cell and blocks of queries
    monkeypatch.setattr(vector_index, "ASKED", 7)
    rows, df = vectors(spark, 600)
    rows += [(1000 + i, rows[5][1]) for i in range(9)] + [(None, rows[40][1])]  # copies, and a vector without a key
    df = spark.createDataFrame(rows, df.schema)
    index = VectorIndex(spark, str(tmp_path / "many"))
    index.build(df, "id", "v", 6)
    usable = [(i, v) for i, v in rows if v and any(v)]
    asked = [(i, v) for i, v in usable if i is not None and i % 20 in (0, 5)]
    found = index.search_all(df.where("id % 20 in (0, 5)"), "id", "v", 5, probes=6)
    near = lambda v: sorted((-round(cosine(v, w), 6), j is not None, j or 0) for j, w in usable)[:5]
    expected = {i: [(j if known else None) for _, known, j in near(v)] for i, v in asked}
    got = {i: [None] * 5 for i in expected}
    for r in found.collect():
        got[r.query][r.rank - 1] = r.key
    assert got == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan  # no row for each pair of a query and a vector
