import pytest

from wattloom.llm import mixing


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, target string")


def filled(sizes, weights):
    """Water-filling by repeated clamping, as the plain definition has it."""
    total, fixed = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(3 * sizes[i] for i in fixed)
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > 3 * sizes[i]}
        if not over:
            return [3.0 * sizes[i] if i in fixed else share[i] for i in range(len(sizes))]
        fixed |= over


def test_targets_and_taken_words(spark):
    rows = [(i, "abcdef"[i % 6], "w " * (i % 17 + 1), "clash") for i in range(600) if i % 6 < 5 or i < 30]
    rows += [(None, None, "x y", "c"), (7, None, None, "c"), (7, None, " ", "c"), (3, "g", None, "c")]
    sizes = {}
    for _, source, text, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted(s for s in sizes if s) + [None]
    want = dict(zip(order, filled([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))])))
    found = mixing.mix_report(docs(spark, rows)).collect()
    source_of = {(d, len((t or "").split())): s for d, s, t, _ in rows}
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        source = source_of[r.doc_id, r["size"]]
        assert r.target == pytest.approx(want[source]) and r.source_size == sizes[source]
        assert r.taken <= 3 * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= 17
    again = mixing.mix_report(docs(spark, rows).repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_mixed_repeats_rows_and_keeps_columns(spark):
    frame = docs(spark, [(1, "a", "x " * 50, "p"), (2, "b", "y", "q"), (3, "b", "z", "r")])
    found = mixing.mixed(frame)
    assert found.columns == frame.columns
    counts = {}
    for r in found.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts.get(2) == counts.get(3) == 3


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_nothing_to_mix(spark, rows):
    found = mixing.mix_report(docs(spark, rows)).collect()
    assert [(r.doc_id, r.target, r.taken) for r in found] == [(1, 0.0, 0)][:len(rows)]
