import math
import zlib
from collections import Counter

import numpy as np
import pytest

from wattloom.llm import hidden_markov as hm
from wattloom.session import settings


def model(states, classes, seed=1):
    draw = np.random.default_rng(seed)
    emit = draw.uniform(0.1, 1, (classes, states))
    move = draw.uniform(0.1, 1, (states, states))
    start = draw.uniform(0.1, 1, states)
    return hm.Model({}, start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_forward_is_exact():
    m = model(hm.STATES, 5)
    texts = [[0], [1, 2, 3], [4, 4, 0, 1, 2, 3, 3, 3]]
    want = []
    for text in texts:  # plain sum over all paths, by the unscaled recursion
        state = m.start * m.emit[text[0]]
        for x in text[1:]:
            state = (state @ m.move) * m.emit[x]
        want.append(math.log10(state.sum()))
    found = hm.likelihoods(m, np.concatenate(texts), np.zeros(12), np.array([1, 3, 8]))
    assert np.allclose(found, want)


def test_expected_counts_against_plain_forward_backward(monkeypatch):
    monkeypatch.setattr(hm, "CLASSES", 5)
    m = model(hm.STATES, 5)
    rows, size = np.array([[0, 1, 2, 2], [3, 4, 1, 0], [1, 0, 0, 0]]), np.array([4, 3, 1])
    starts, moves, emits = hm.expected(m, rows, size)
    want = np.zeros(hm.STATES), np.zeros((hm.STATES,) * 2), np.zeros((hm.STATES, 5))
    for row, n in zip(rows, size):
        ahead, back = [m.start * m.emit[row[0]]], [np.ones(hm.STATES)]
        for x in row[1:n]:
            ahead.append((ahead[-1] @ m.move) * m.emit[x])
        for x in row[1:n][::-1]:
            back.insert(0, m.move @ (m.emit[x] * back[0]))
        total = ahead[-1].sum()
        want[0][:] += ahead[0] * back[0] / total
        for t in range(n):
            want[2][:, row[t]] += ahead[t] * back[t] / total
            if t + 1 < n:
                want[1][:] += np.outer(ahead[t], m.emit[row[t + 1]] * back[t + 1]) * m.move / total
    for a, b in zip((starts, moves, emits), want):
        assert np.allclose(a, b)


def test_rounds_raise_the_likelihood(monkeypatch):
    monkeypatch.setattr(hm, "CLASSES", 6)
    draw = np.random.default_rng(2)
    text = np.concatenate([draw.integers(0, 3, 64) + 3 * (i % 2) for i in range(40)])
    lengths, share = np.full(40, 64), np.full(6, 1 / 6)
    m, before = model(hm.STATES, 6), -math.inf
    for _ in range(60):
        now = hm.likelihoods(m, text, np.zeros(len(text)), lengths).sum()
        assert now > before - 0.5
        before = now
        m = hm.maximised(m, hm.expected(m, *hm.segments(text, lengths)), share)
    assert before > -0.6 * len(text)


def test_scores_of_whole_texts(spark):
    words = {0: "the of and to in that it", 1: "der die und zu den das ist"}
    rows = [(i, " ".join((words[i % 2].split() * 20)[i % 5:60 + i % 7]).title()) for i in range(300)]
    rows += [(None, "the"), (900, None), (901, ""), (902, "neverseen\x85here the"), (4, rows[4][1]), (903, "die " * 30000)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, block string").repartition(3)
    found = hm.score(docs, rounds=6).collect()
    train, texts = Counter(), {}
    for i, t in rows:
        tokens = [w.lower() for w in (t or "").encode().split()] + [b""]
        held = zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
        texts[i] = tokens, held
        if not held:
            train.update(tokens)
    total, kinds = sum(train.values()), len(train)
    assert len(found) == len(rows)
    for r in found:
        tokens, held = texts[r.doc_id]
        base = sum(math.log10((train[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, len(tokens), sum(train[w] > 0 for w in tokens), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    (row,) = hm.score(docs).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and row.score <= 0
    assert hm.score(docs.limit(0)).count() == 0


def test_every_round_sees_every_block(spark, monkeypatch):
    seen, counted, counted_words = [], hm.counted, hm.counted_words

    def watched(blocks, model):
        seen.append(blocks.count())
        return counted(blocks, model)

    def watched_words(blocks, model):
        seen.append(blocks.count())
        return counted_words(blocks, model)

    monkeypatch.setattr(hm, "counted", watched)
    monkeypatch.setattr(hm, "counted_words", watched_words)
    docs = spark.createDataFrame([(i, f"w{i} the") for i in range(60)], "doc_id long, text string").repartition(20)
    hm.score(docs, rounds=3)
    assert seen == [20] * 3


def test_long_texts_are_one_chain(monkeypatch):
    """Texts over several segments against one plain forward-backward each: moves over borders count, starts only at token 0."""
    monkeypatch.setattr(hm, "CLASSES", 7)
    monkeypatch.setattr(hm, "SEGMENT", 4)
    m, draw = model(hm.STATES, 7), np.random.default_rng(3)
    lengths = np.array([1, 9, 4, 8, 30, 5, 17, 3])
    text = draw.integers(0, 7, lengths.sum())
    want, at = (np.zeros(hm.STATES), np.zeros((hm.STATES,) * 2), np.zeros((hm.STATES, 7))), 0
    for n in lengths:
        row, at = text[at:at + n], at + n
        ahead, back = [m.start * m.emit[row[0]]], [np.ones(hm.STATES)]
        for x in row[1:]:
            ahead.append((ahead[-1] @ m.move) * m.emit[x])
        for x in row[1:][::-1]:
            back.insert(0, m.move @ (m.emit[x] * back[0]))
        total = ahead[-1].sum()
        want[0][:] += ahead[0] * back[0] / total
        for t in range(n):
            want[2][:, row[t]] += ahead[t] * back[t] / total
            if t + 1 < n:
                want[1][:] += np.outer(ahead[t], m.emit[row[t + 1]] * back[t + 1]) * m.move / total
    for rows in (2, 8192):
        monkeypatch.setattr(hm, "ROWS", rows)
        found = hm.expected_of_texts(m, text, lengths)
        assert found[0].sum() == pytest.approx(len(lengths)) and found[1].sum() == pytest.approx((lengths - 1).sum())
        for a, b in zip(found, want):
            assert np.allclose(a, b)


def test_emissions_of_a_state_sum_to_one():
    """Over all training words and one unknown word of each hashed class."""
    draw = np.random.default_rng(4)
    classes = np.concatenate([np.arange(5), hm.TOP + draw.integers(0, hm.HASHED, 400), hm.TOP + np.arange(hm.HASHED)])
    count = np.concatenate([draw.integers(1, 50, 405), np.zeros(hm.HASHED, int)])
    share = np.zeros(hm.CLASSES)
    np.add.at(share, classes, count)
    rest_kinds = np.bincount(classes[5:405] - hm.TOP, minlength=hm.HASHED)
    m = hm.first_model({}, share)
    m.emit[5:hm.TOP] = 0
    m.emit /= m.emit.sum(0)
    own = count[:, None] * draw.dirichlet(np.ones(hm.STATES), len(count))
    words = hm.Words(m, int(count.sum()), 405, share[hm.TOP:], rest_kinds)
    assert np.allclose(words.emissions(classes, count, own).sum(0), 1)
    words.totals = own.sum(0)
    assert np.allclose(words.emissions(classes, count, own).sum(0), 1)


def test_rounds_over_words_against_one_block(spark):
    """The distributed state-by-word table equals the counts of all texts taken as one block; every training word has a row."""
    draw = np.random.default_rng(6)
    texts = [" ".join(f"w{draw.integers(0, 9) + 9 * (i % 2)}" for _ in range(30)) + f" only{i}" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for parts in (1, 7):
        found[parts] = sorted((r.doc_id, round(r.score, 3)) for r in hm.score(docs.repartition(parts), rounds=5).collect())
    assert found[1] == found[7]
    train = Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split() + [""])
    blocks = hm.coded(docs.repartition(5))
    share = np.ones(hm.CLASSES) / hm.CLASSES
    rows = hm.counted_words(blocks, hm.first_model({}, share)).collect()
    assert sorted(r["count"] for r in rows) == sorted(train.values())
    assert all(sum(r[e] for e in hm.EXPECTED) == pytest.approx(r["count"], rel=1e-4) for r in rows)


def test_words_are_dealt_packed(spark):
    """Counting, summing and sending back words shuffles a row for each block and range of hashes, not one for each word of a block."""
    texts = [" ".join(f"w{(i * 7 + k) % 900}" for k in range(300)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    blocks = hm.coded(docs)
    with settings(spark, {"spark.sql.shuffle.partitions": "4"}):
        counts = hm.word_counts(blocks)
        table = hm.counted_words(blocks, hm.first_model({}, np.ones(hm.CLASSES) / hm.CLASSES))
        rows = hm.with_rows(blocks, table).collect()
        kept = {r.hash: r["count"] for r in counts.collect()}
        plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan and "hash#" not in plan.split("Exchange")[1].split("\n")[0]
    assert len(rows) <= 3 * 4
    asked = {r.block: r.hashes for r in blocks.collect()}
    for r in rows:
        own = sorted(asked[r.home], key=lambda h: h % 2**64)[r.first:]
        found = np.frombuffer(bytes(r.counts), np.int64)
        sums = np.frombuffer(bytes(r.sums), np.float32).reshape(hm.STATES, -1).sum(0)
        assert [kept.get(h, 0) for h in own[:len(found)]] == found.tolist()
        assert np.allclose(sums, found, rtol=1e-4)
    train = Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split() + [""])
    assert sorted(kept.values()) == sorted(train.values()) and sum(len(x) for x in asked.values()) == sum(
        len(np.frombuffer(bytes(r.counts), np.int64)) for r in rows)


def test_classes_of_frequent_and_other_words():
    top = {-5: 0, 2**62: 1, 7: 2}
    found = hm.classes_of(np.array([7, 8, -5, 2**62, -6]), np.array([1, 2, 3, 4, 5], np.int32), top)
    assert found.tolist() == [2, hm.TOP + 2, 0, 1, hm.TOP + 5]
    assert hm.classes_of(np.array([7]), np.array([1], np.int32), {}).tolist() == [hm.TOP + 1]


def test_rounds_read_classes_of_training_texts_only(spark, monkeypatch):
    """All rounds but the last read what is stored for them: a number for each training token, no word hashes and no held-out text."""
    seen, counted = [], hm.counted

    def watched(texts, model):
        seen.append((texts.columns, sum(len(r.classes) // 2 for r in texts.collect())))
        return counted(texts, model)

    monkeypatch.setattr(hm, "counted", watched)
    texts = ["a b c " * (i % 5) for i in range(90)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    hm.score(docs, rounds=3)
    tokens = sum(len((t or "").split()) + 1 for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2)
    assert seen == [(["classes", "sizes"], tokens)] * 2


def test_matrices_are_carried_inside_long_texts_only(monkeypatch):
    """Over a text's first and last segment one vector is carried; the counts are those of one segment for each text."""
    monkeypatch.setattr(hm, "CLASSES", 7)
    m, draw, carried, asked = model(hm.STATES, 7), np.random.default_rng(8), hm.transfers, []
    lengths = np.array([5, 8, 3, 4, 17, 12, 1, 9])
    text = draw.integers(0, 7, lengths.sum()).astype(np.uint16)
    whole = hm.expected_of_texts(m, text, lengths)
    monkeypatch.setattr(hm, "SEGMENT", 4)
    monkeypatch.setattr(hm, "transfers", lambda model, found, first: asked.append(len(first)) or carried(model, found, first))
    for a, b in zip(hm.expected_of_texts(m, text, lengths), whole):
        assert np.allclose(a, b)
    assert asked == [3 + 1 + 1]


def test_coded_texts_at_block_borders(spark, monkeypatch):
    """Blocks end with the text that fills them, wherever the pieces that are cut into words end; words are those of ``bytes.split``."""
    monkeypatch.setattr(hm, "BLOCK_TOKENS", 20)
    monkeypatch.setattr(hm, "PIECE", 64)
    texts = [None, "", " \n ", "A b\x1fc  a Ä x", "the", "x\x85y Z q"] + ["Word w%d  the\tthe\n" % (i % 3) * (i % 6) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = hm.coded(docs).collect()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    assert [i for r in rows for i in r.doc_ids] == list(range(len(texts)))
    for r in rows:
        own = [[*(texts[i] or "").encode().lower().split(), hm.END] for i in r.doc_ids]
        lengths, codes, suffixes, trained = (np.frombuffer(bytes(x), np.int32) for x in (r.lengths, r.codes, r.suffixes, r.trained))
        assert lengths.tolist() == [len(x) for x in own] and list(bytes(r.held)) == [held[i] for i in r.doc_ids]
        assert sum(lengths[:-1]) < 20 and (sum(lengths) >= 20 or r == rows[-1])
        flat = [w for x in own for w in x]
        assert [r.hashes[c] for c in codes] == [hm.xxhash.xxh64_intdigest(w) - (1 << 63) for w in flat]
        assert suffixes[codes].tolist() == [zlib.crc32(w[-3:]) % hm.HASHED for w in flat] and len(r.hashes) == len(set(flat))
        train = Counter(w for i, x in zip(r.doc_ids, own) if not held[i] for w in x)
        assert {r.hashes[c]: trained[c] for c in codes} == {hm.xxhash.xxh64_intdigest(w) - (1 << 63): train[w] for w in flat}
