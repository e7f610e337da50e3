"""What a stored frame leaves behind, and row numbers that need no stored texts."""

from pyspark.sql import functions as F

from wattloom.llm.common import numbered
from wattloom.session import DROP_SHUFFLES, store


def shuffle_files(spark):
    names = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {n for n in names if n.endswith(".data")}


def test_stored_frame_leaves_no_shuffle_files(spark):
    name, before = next(iter(DROP_SHUFFLES)), shuffle_files(spark)
    set_before = spark.conf.get(name)
    found = store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")), "test")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == set_before
    assert found.count() == 7


def test_numbers_of_rows(spark):
    layout = "doc_id long, text string"
    single = spark.createDataFrame([(5, "e"), (-2, "b"), (9, None)], layout)
    rows = numbered(single, "n")
    assert {(r.doc_id, r.n) for r in rows.collect()} == {(5, 5), (-2, -2), (9, 9)}
    assert "parquet" not in rows._jdf.queryExecution().analyzed().toString().lower()  # nothing was stored
    for repeated in ([(5, "e"), (5, "f"), (1, "a")], [(None, "e"), (5, "f"), (1, "a")]):
        kept = numbered(spark.createDataFrame(repeated, layout), "n").orderBy("n").collect()
        assert len({r.n for r in kept}) == 3
        assert [r.doc_id for r in kept] == sorted((r[0] for r in repeated), key=lambda x: (x is not None, x or 0))
