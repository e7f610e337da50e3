from collections import defaultdict

import corpus_pipeline
from tests.llm.test_line_dedup import brute
from tests.llm.test_lsh_forest import brute as near, corpus as near_corpus
from wattloom.llm import line_dedup
from wattloom.llm.common import table
from wattloom.session import settings, store

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = store(stage(spark, docs, SF), "pipeline")
        rows = docs.select("doc_id", "text").collect()
        assert docs.columns == columns
        assert {r.doc_id for r in rows} <= set(before)
        seen[name] = before, rows
    before, rows = seen["line dedup"]
    gone, _ = brute(sorted(before.items()), 80)
    left = {}
    for doc_id, text in before.items():
        lines = (text or "").split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if (doc_id, i) not in gone)
        if kept.strip() or not any(d == doc_id for d, _ in gone):
            left[doc_id] = kept if text is not None else None
    assert {r.doc_id: r.text for r in rows} == left
    before, rows = seen["MinHash near-dedup"]
    classes = near(sorted(before.items()), 5, 80)
    assert {r.doc_id for r in rows} == {doc_id for doc_id, _, _, kept in classes if kept}
    pieces = defaultdict(list)
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect():
        pieces[r.sequence_id].append((r.offset, r.length))
    for found in pieces.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048


def test_rows_that_share_a_doc_id_or_have_none_are_decided_one_by_one(spark):
    rows = [(1, "alpha beta gamma"), (None, "alpha beta gamma\ndelta epsilon"), (None, "only this line"), (None, "alpha beta gamma"),
            (7, "zeta eta\ntheta iota"), (7, "kappa lambda\nzeta eta"), (7, "zeta eta\ntheta iota"), (8, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = [tuple(r) for r in corpus_pipeline.fresh_lines(spark, docs, SF).collect()]
    key = lambda r: (r[0] or 0, r[1] or "", r[1] is None)
    assert sorted(found, key=key) == sorted([
        (None, "alpha beta gamma\ndelta epsilon"), (None, "only this line"), (7, "zeta eta\ntheta iota"), (7, "kappa lambda"), (8, None), (8, "")], key=key)


def test_one_row_of_each_group_stays(spark):
    same, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(5, same), (5, same), (3, same), (3, same), (None, same), (None, other), (None, other), (None, "a single one"), (9, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = [tuple(r) for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()]
    assert sorted(found, key=str) == sorted([(3, same), (None, other), (None, "a single one"), (9, ""), (9, None)], key=str)


def test_near_copies_go_from_the_stage_as_brute_force_says(spark):
    """The line stage leaves few near copies, so the stage is held against texts of its own here."""
    rows = list(enumerate(text for _, text in near_corpus(5)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()}
    want = {doc_id for doc_id, _, _, kept in near(rows, 5, 80) if kept}
    assert kept == want and len(want) < len(rows)


def test_texts_that_stay_as_they_are_are_not_dealt(spark):
    """Only rows that may be named by the keys go through the join's shuffle, even where nothing is broadcast."""
    long_one = " ".join(f"w{i}" for i in range(400))
    texts = ["alpha beta gamma\ndelta epsilon", "alpha beta gamma\nzeta eta", *(f"{long_one} x{i}a x{i}b" * 3 if i == 0 else " ".join(f"u{i}v{k}" for k in range(400)) for i in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = corpus_pipeline.fresh_lines(spark, docs, SF)
        kept = {r.doc_id: r.text for r in found.collect()}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert kept == {**dict(enumerate(texts)), 1: "zeta eta"}
    assert plan.lstrip().startswith("Union")
    some, others = line_dedup.parted(docs, "doc_id", spark.createDataFrame([(1,), (7,)], "key long"))
    assert {1, 7} <= {r.doc_id for r in some.collect()} and some.count() + others.count() == len(texts)
    assert others.count() >= len(texts) - 4 and "Exchange" not in others._jdf.queryExecution().executedPlan().toString()
