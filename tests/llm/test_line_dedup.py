import random

import numpy as np
import pytest

from wattloom.llm import line_dedup


def brute(rows, percent):
    lines = []
    for doc_id, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            words = frozenset(line.encode().lower().split())
            if words:
                lines.append(((doc_id is not None, doc_id or 0, number), doc_id, number, words))
    gone = {}
    for at, doc_id, number, words in lines:
        if any(p < at and 100 * len(w & words) >= percent * len(w | words) for p, _, _, w in lines):
            gone[doc_id, number] = words
    return gone, {(d, n): w for _, d, n, w in lines}


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"v{int(draw.paretovariate(0.6))}" for _ in range(4000)]
    lines = [draw.sample(vocabulary, draw.choice([1, 3, 5, 9, 20, 60])) for _ in range(120)]
    for _ in range(250):
        line = list(draw.choice(lines))
        for _ in range(draw.randrange(0, 1 + len(line) // 6)):
            line[draw.randrange(len(line))] = draw.choice(vocabulary + ["new%d" % draw.randrange(10**6)])
        lines.append(line)
    draw.shuffle(lines)
    texts = []
    while lines:
        n = draw.randrange(1, 12)
        texts.append("\n".join(" ".join(x) for x in lines[:n]))
        lines = lines[n:]
    texts += ["", None, "\n \n", "A b\nc d\r\na B", "x\x85y z", "long " * 9000 + "\n" + " ".join(f"u{i}" for i in range(3000))]
    return [(i * 3, t) for i, t in enumerate(texts)] + [(None, texts[2]), (0, texts[0])]


@pytest.mark.parametrize("most, hot", [(1, line_dedup.HOT), (4, line_dedup.HOT), (2, 7)])
def test_against_brute_force(spark, most, hot):
    rows = corpus(most)
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, line int").repartition(6)
    found = line_dedup.repeated_lines(docs, 80, most, hot).collect()
    gone, lines = brute(rows, 80)
    assert {(r.doc_id, r.line) for r in found} == set(gone)
    for r in found:
        a, b = lines[r.doc_id, r.line], lines[r.match_doc_id, r.match_line]
        assert r.similarity == pytest.approx(len(a & b) / len(a | b)) and r.similarity >= 0.8
        assert (r.match_doc_id is not None, r.match_doc_id or 0, r.match_line) < (r.doc_id is not None, r.doc_id or 0, r.line)


@pytest.mark.parametrize("most, hot", [(1, line_dedup.HOT), (1 << 20, 7)])
def test_every_link_is_counted_once(spark, most, hot):
    rows = corpus(3) + [(10**6 + i, " ".join(f"near{j}" for j in range(40) if j != i)) for i in range(30)]  # each of the last is like all of the others
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    _, lines = brute(rows, 80)
    sets = set(lines.values())
    links = {w: sum(w != x and 100 * len(w & x) >= 80 * len(w | x) for x in sets) for w in sets}
    first = {}
    for at, words in sorted(lines.items(), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[0][1])):
        first.setdefault(words, at)
    found = {(r.doc_id, r.line): ((r.first_doc_id, r.first_line), r.n_links) for r in line_dedup.line_links(docs, 80, most, hot).collect()}
    assert found == {at: (first[words], links[words]) for at, words in lines.items()}
    assert max(links.values()) >= 29


def test_long_lines_that_differ_in_few_words(spark):
    """Every bit of the maps comes into play: sets of 40 words, with a few of them changed."""
    draw = random.Random(5)
    rows = []
    for i in range(150):
        words = [f"w{draw.randrange(10**6)}" for _ in range(40)]
        rows.append((2 * i, " ".join(words)))
        words[draw.randrange(20)], words[20 + draw.randrange(20)] = f"x{i}", f"y{i}"
        rows.append((2 * i + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone, _ = brute(rows, 80)
    assert len(gone) == 150
    assert {(r.doc_id, r.line) for r in line_dedup.repeated_lines(docs).collect()} == set(gone)


def test_lines_leave_their_documents(spark):
    rows = [(1, "one two three\nfour five", 24, "x"), (2, "One two three\n\nsix", 99, "y"), (3, "five four", 9, "z"), (4, "", 0, None), (5, None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _doc string")
    found = {r.doc_id: tuple(r) for r in line_dedup.without_removed(docs).select(*docs.columns[:3]).collect()}
    assert found == {1: rows[0][:3], 2: (2, "\nsix", 4), 4: rows[3][:3], 5: rows[4][:3]}


def test_empty_table(spark):
    assert line_dedup.repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_any_two_sets_of_a_hot_word_meet():
    key = np.arange(40, dtype=np.int64) * 7919
    at, group = line_dedup.tiled(np.arange(40), np.full(40, 5, np.uint64), np.full(40, 30), key, 4)
    groups = {}
    for row, g in zip(at.tolist(), group.tolist()):
        groups.setdefault(g, set()).add(row)
    assert len(groups) > 20 and max(map(len, groups.values())) < 20
    assert all(any({a, b} <= g for g in groups.values()) for a in range(40) for b in range(a))
    at, group = line_dedup.tiled(np.arange(3), np.full(3, 5, np.uint64), np.full(3, 4), key[:3], 4)
    assert at.tolist() == [0, 1, 2] and set(group.tolist()) == {5}


@pytest.mark.parametrize("size, prefix", [(1, 1), (4, 1), (5, 2), (10, 3), (45, 10)])
def test_prefix_length(size, prefix):
    assert line_dedup.prefix_length(size, 80) == prefix


def test_postings_are_dealt_packed(spark):
    """A block of lines deals a row for each group of words, not one for each posting; every set and prefix word arrives once."""
    texts = [" ".join(f"w{(7 * i + k * k) % 53}" for k in range(12)) + "\nshared line of words here" for i in range(80)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    counts = np.full(line_dedup.RARITY, 2, np.uint32)
    rarity = spark.sparkContext.broadcast(counts)
    rows = line_dedup.postings(docs, rarity, 80, line_dedup.HOT, 4).collect()
    assert sorted(r.part for r in rows) == [0, 1, 2, 3]
    found = [(r.part, *x) for r in rows for x in zip(*(np.frombuffer(bytes(r[c]), kind).tolist() for c, kind in line_dedup.KINDS.items()))]
    sets = {frozenset(line.split()) for t in texts for line in t.split("\n")}
    assert len(found) == sum(line_dedup.prefix_length(len(s), 80) for s in sets) == len({(x[1], x[5]) for x in found})
    assert len({x[:2] for x in found}) == len({x[1] for x in found})


def test_rows_of_a_word_once_and_by_size():
    draw = np.random.default_rng(3)
    word, size, key = draw.integers(-3, 3, 500) * 2**61, draw.integers(1, 9, 500).astype(np.int32), draw.integers(-20, 20, 500) * 2**58
    size = (np.abs(key // 2**58) % 5 + 1).astype(np.int32)
    once = line_dedup.set_and_word_once(word, size, key)
    rows = list(zip(word[once].tolist(), size[once].tolist(), key[once].tolist()))
    assert len(rows) == len(set(rows)) and set(rows) == set(zip(word.tolist(), size.tolist(), key.tolist()))
    assert [r[:2] for r in rows] == sorted(r[:2] for r in rows)
    assert len(line_dedup.set_and_word_once(word[:0], size[:0], key[:0])) == 0
    some = np.array([5, -7, 5, 9, -7, 2, 5])
    assert sorted(line_dedup.shared(some).tolist()) == [0, 1, 2, 4, 6] and len(line_dedup.shared(some[:0])) == 0


def test_more_groups_for_more_words(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert line_dedup.parts_for(spark, 0) == parts and line_dedup.parts_for(spark, 1 << 40) == (1 << 40) // line_dedup.PART_WORDS
