"""The segmented index against the plain ranking, through refreshes, filters and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_search import WORDS, brute_force
from wattloom.functions.texts import tokens
from wattloom.operators import text_index
from wattloom.operators.search import term_index
from wattloom.operators.text_index import TextIndex

LAYOUT = "id long, content string, kind string"


def texts(seed, ids):
    rng = random.Random(seed)
    return {i: " ".join(rng.choices(WORDS, [2 ** -n for n in range(len(WORDS))], k=rng.randint(1, 60))) for i in ids}


def ranked(index, query, k, where=None):
    found = index.search(query, k, where).collect()
    return sorted(((r.score, r.doc) for r in found), key=lambda x: (-x[0], x[1]))


def frame(spark, held, kind=lambda i: "ab"[i % 2]):
    return spark.createDataFrame([(i, t, kind(i)) for i, t in held.items()], LAYOUT)


def test_refreshes_and_pruning(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "index"))
    held = texts(1, range(700))
    assert index.refresh(frame(spark, held), "id", "content") == {"indexed": 700, "dropped": 0}
    queries = [WORDS[:1], WORDS[2:4], ["heat", "grid", "heat", "unknown", ""], WORDS]
    for query in queries:
        assert ranked(index, query, 7) == brute_force(list(held.items()), query, 7)
    assert index.refresh(frame(spark, held), "id", "content") == {"indexed": 0, "dropped": 0}
    held.update(texts(2, [*range(0, 700, 50), 900, 901]))
    for gone in (5, 6, 7):
        del held[gone]
    assert index.refresh(frame(spark, held), "id", "content") == {"indexed": 16, "dropped": 17}
    assert len(index.commits()) == 2
    for query in queries:
        assert ranked(index, query, 7) == brute_force(list(held.items()), query, 7)
    index.refresh(frame(spark, held, lambda i: "c"), "id", "content")  # only an attribute changed
    assert {r.kind for r in index.search(WORDS, 3).collect()} == {"c"}
    assert ranked(index, WORDS, 7) == brute_force(list(held.items()), WORDS, 7)


def test_filter_keeps_the_statistics_of_all(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "index"))
    held = texts(3, range(300))
    index.refresh(frame(spark, held), "id", "content")
    every = brute_force(list(held.items()), ["solar", "bill"], 1000)
    assert ranked(index, ["solar", "bill"], 9, F.col("kind") == "b") == [x for x in every if x[1] % 2][:9]
    assert ranked(index, ["solar"], 9, F.col("kind") == "none") == []


def test_blocks_are_skipped_and_no_text_is_read(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "index"))
    held = {i: "solar " * (60 if i < 20 else 1) + "filler " * (10 if i < 20 else 200) for i in range(4000)}
    index.refresh(frame(spark, held), "id", "content")
    blocks = spark.read.parquet(str(tmp_path / "index" / "postings"), recursiveFileLookup=True).where("term = 'solar'")
    assert blocks.count() > 30 and blocks.agg(F.max("size")).first()[0] <= text_index.BLOCK
    found = index.search(["solar"], 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content:string" not in plan and "In(term" in plan or "EqualTo(term,solar)" in plan
    assert [r.doc for r in found.orderBy("doc").collect()] == [0, 1, 2, 3, 4]


def test_odd_rows(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "index"))
    with pytest.raises(ValueError):
        index.search(["solar"])
    assert index.refresh(frame(spark, {}), "id", "content") == {"indexed": 0, "dropped": 0}
    rows = [(1, None, "a"), (2, "", None), (3, "Größe, größe! x", "a"), (4, "?!", "b")]
    assert index.refresh(spark.createDataFrame(rows, LAYOUT), "id", "content") == {"indexed": 4, "dropped": 0}
    assert [r.doc for r in index.search(["größe"], 5).collect()] == [3]
    assert index.search(["missing"], 5).count() == 0 and index.search([], 5).count() == 0
    assert index.refresh(spark.createDataFrame(rows, LAYOUT), "id", "content") == {"indexed": 0, "dropped": 0}


def test_an_unfinished_refresh_is_not_seen(spark, tmp_path, monkeypatch):
    index = TextIndex(spark, str(tmp_path / "index"))
    held = texts(4, range(50))
    index.refresh(frame(spark, held), "id", "content")

    def broken(self, counts, path):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(TextIndex, "_write_postings", broken)
        index.refresh(frame(spark, texts(5, range(50))), "id", "content")
    assert ranked(index, WORDS, 7) == brute_force(list(held.items()), WORDS, 7)
    held = texts(5, range(50))
    index.refresh(frame(spark, held), "id", "content")
    assert ranked(index, WORDS, 7) == brute_force(list(held.items()), WORDS, 7)


def test_token_rule_is_that_of_the_plain_search(spark):
    assert spark.createDataFrame([("Ab-c'd 1x",)], "t string").select(tokens(F.col("t"))).first()[0] == ["ab", "c", "d", "1x"]


def test_postings_are_not_shuffled(spark):
    corpus = spark.createDataFrame([(1, "solar heat solar"), (2, None), (3, "heat"), (3, "heat pump")], "id long, content string")
    alone = term_index(corpus.where("id < 3"), "id", "content")
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in alone.collect()} == {(1, 3, "solar", 2), (1, 3, "heat", 1)}
    shared = {tuple(r) for r in term_index(corpus, "id", "content").where("doc = 3").collect()}
    assert shared == {(3, 1, "heat", 1), (3, 2, "heat", 1), (3, 2, "pump", 1)}
