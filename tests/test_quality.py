"""Declared column tests on hand-made breaches."""

from wattloom.operators.quality import NOT_NULL, UNIQUE, column_tests


def test_each_breach_is_counted(spark):
    rows = [(1, "a", 0.5), (1, "b", None), (2, "x", 0.5), (None, "x", 0.5), (None, None, None), (3, "y", 1.0), (1, "a", 2.0)]
    df = spark.createDataFrame(rows, "k long, v string, w double")
    found = column_tests(df, "t", {"k": (UNIQUE, NOT_NULL), "v": (("a", "b"), NOT_NULL, UNIQUE), "w": (NOT_NULL,)})
    assert [tuple(r) for r in found.collect()] == [
        ("t", "k", "unique", 3, 1), ("t", "k", "not_null", 2, 1), ("t", "v", "accepted_values", 3, 2), ("t", "v", "not_null", 1, 1),
        ("t", "v", "unique", 4, 2), ("t", "w", "not_null", 2, 1)]


def test_an_empty_table_passes(spark):
    df = spark.createDataFrame([], "k long")
    assert [tuple(r) for r in column_tests(df, "t", {"k": (UNIQUE, NOT_NULL)}).collect()] == [("t", "k", "unique", 0, 0), ("t", "k", "not_null", 0, 0)]


def test_one_pass_that_combines_before_the_shuffle(spark, tmp_path):
    """A column that is only tested for NULL brings two groups at most."""
    spark.range(1000).selectExpr("id", "id as other", "id as unread").write.parquet(str(tmp_path / "t"))
    plan = column_tests(spark.read.parquet(str(tmp_path / "t")), "t", {"id": (UNIQUE,), "other": (NOT_NULL,)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "unread" not in plan
