"""Phrase collocations: frequent phrases by mergeable Misra-Gries summaries, counted exactly in a last pass.

Texts are split at BREAKS into pieces and these into words; all counts are per language. A phrase of two to four words is a candidate if it
occurs ``least`` times.

1. Tasks hash the words and pairs of words of a block of text, count equal ones, and deal the hashes to hash partitions. A partition merges what it gets
   into one Misra-Gries summary whose capacity exceeds its mass divided by ``least``: counters lose less than ``least`` in all, so no frequent phrase is
   lost. What may be frequent is marked in a bit table of fixed size (``marked``).
2. The same for phrases of three and four words, all of whose pairs are marked: a phrase is no more frequent than its pairs.
3. Marked phrases are counted by their text (``counted``). The tables only keep rows out of the shuffle: a mark too many costs a row, no result.
4. Candidates are cut at each place, scored at their weakest one, dropped where a longer one explains them, and ranked in each language (``collocations``).

A block holds texts of one language, cut at breaks, which no phrase crosses. A word with a large share of all words is one entry for each block.
Numbers of a score are decimals, so products don't overflow.

Defined cases: a null or empty text has no words; a null language is ``und``; doc_ids are not read, so null and repeated ones count row by row; ties go
by count and by the phrase's bytes; an empty table gives no rows; other columns are not read. Within a block, words and phrases are told apart by
64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import groups_for
from wattloom.llm.line_sets import BLOCK, INVERSE, LETTER, LONG, POWER
from wattloom.llm.sets import mixed
from wattloom.session import store

LONGEST, LEAST, TOP = 4, 30, 2000
HELD_BYTES = 8 << 20
GROUP_BYTES = 16 << 20
TABLE_BITS, MOST_PARTITION_BITS = 26, 16
BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
END = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
SPACES = re.compile(r"[\x20\x09]+")
KIND = np.zeros(256, np.int8)  # 1: between words, 2: between pieces
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
SUMMARY = "part int, once binary, keys binary, counts binary"
COUNTS = "lang string, size int, phrase string, n long"


@dataclass
class Words:
    """Hash, piece and place of each word of a block."""

    hash: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words_in(data: bytes) -> Words:
    raw = np.frombuffer(data, np.uint8)
    found: list[tuple[np.ndarray, ...]] = []
    at = passed = 0
    while at < len(raw):
        stop = min(at + BLOCK, len(raw))
        kind = KIND[raw[at:stop]]
        if stop < len(raw):
            ends = np.flatnonzero(kind)
            if not len(ends):  # the block lies within one word
                space = END.search(data, stop)
                stop = space.start() if space else len(raw)
                found.append((np.array([xxhash.xxh64_intdigest(data[at:stop])], np.uint64), np.array([passed]), np.array([at]), np.array([stop])))
                at = stop
                continue
            stop = at + int(ends[-1]) + 1
            kind = kind[:stop - at]
        part = raw[at:stop]
        solid = np.zeros(len(part) + 2, np.int8)
        solid[1:-1] = kind == 0
        edges = np.diff(solid)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(LETTER[part] * POWER[:len(part)], out=sums[1:])
        own = mixed(mixed((sums[ends] - sums[starts]) * INVERSE[starts]) + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts > LONG):
            own[i] = xxhash.xxh64_intdigest(data[at + starts[i]:at + ends[i]])
        breaks = np.flatnonzero(kind == 2)
        found.append((own, passed + np.searchsorted(breaks, starts), starts + at, ends + at))
        passed += len(breaks)
        at = stop
    if not found:
        return Words(np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    return Words(*(np.concatenate(c) for c in zip(*found)))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, lower-cased text) of about HELD_BYTES; a long text is cut at breaks."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for text, lang in zip(*batch.columns[:2]):
            value = text.as_buffer()
            if value is None or not len(value):
                continue
            data, name = value.to_pybytes().lower(), lang.as_py()
            while len(data) > HELD_BYTES:
                cut = BREAK.search(data, HELD_BYTES)
                if not cut:
                    break
                yield name, data[:cut.start()]
                data = data[cut.end():]
            held.setdefault(name, []).append(data)
            size += len(data)
            if size >= HELD_BYTES:
                yield from ((k, b"\n".join(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def phrase_hashes(words: Words, lang: str, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, place of the first word, hash) of the phrases within pieces, for each size."""
    made = mixed(words.hash ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
    for size in range(1, longest + 1):
        if size > 1:
            made = mixed(made[:-1] * np.uint64(0xD6E8FEB86659FD93) + words.hash[size - 1:])
        within = words.piece[:len(made)] == words.piece[size - 1:] if len(made) else np.empty(0, bool)
        at = np.flatnonzero(within)
        yield size, at, made[at]


def marks_of(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit table has a mark for each hash."""
    place = hashes >> np.uint64(64 - TABLE_BITS)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & 1 > 0


def inner_pairs(words: Words, lang: str, pairs: np.ndarray) -> np.ndarray:
    """For each word, whether it and the next one are a marked pair."""
    marked = np.zeros(len(words.hash) + LONGEST, bool)
    for size, at, hashes in phrase_hashes(words, lang, 2):
        if size == 2:
            marked[at] = marks_of(pairs, hashes)
    return marked


def likely(words: Words, lang: str, pairs: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The phrases to be summarised: of one and two words, or, given the table of pairs, the longer ones whose pairs are marked."""
    if pairs is None:
        yield from phrase_hashes(words, lang, 2)
        return
    follows = inner_pairs(words, lang, pairs)
    for size, at, hashes in phrase_hashes(words, lang, LONGEST):
        if size > 2:
            kept = np.logical_and.reduce([follows[at + i] for i in range(size - 1)])
            yield size, at[kept], hashes[kept]


def reduced(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One Misra-Gries step: equal keys are added up; beyond the capacity all counters fall by the largest one that has no place."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if len(keys):
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
    if len(keys) <= capacity:
        return keys, counts, 0
    lost = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    kept = counts > lost
    return keys[kept], counts[kept] - lost, lost


def summary(parts: Iterator[tuple[np.ndarray, np.ndarray]], mass: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The merged Misra-Gries summary (keys, counters, loss): a key's count is at most its counter and the loss, which stays below ``least``."""
    capacity = mass // least + 1
    held, size, loss = [], 0, 0
    for keys, counts in parts:
        held.append((keys, counts))
        size += len(keys)
        if size > 4 * capacity:
            k, c, lost = reduced(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), capacity)
            held, size, loss = [(k, c)], len(k), loss + lost
    if not held:
        return np.empty(0, np.uint32), np.empty(0, np.int64), 0
    k, c, lost = reduced(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), capacity)
    return k, c, loss + lost


def marked(texts: DataFrame, bits: int, least: int, pairs: np.ndarray | None = None) -> np.ndarray:
    """Bit table of the phrases that may occur ``least`` times, from 2 ** ``bits`` hash partitions."""
    given = texts.sparkSession.sparkContext.broadcast(pairs)  # 2 ** TABLE_BITS bits, whatever the corpus

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in blocks(batches):
            words = words_in(data)
            hashes = np.concatenate([h for _, _, h in likely(words, lang, given.value)] or [np.empty(0, np.uint64)])
            keys, counts = np.unique(hashes >> np.uint64(32 - bits), return_counts=True)
            part = (keys >> np.uint64(32)).astype(np.int64)
            low = keys.astype(np.uint32)
            owners, first = np.unique(part, return_index=True)
            rows: list[tuple] = []
            for owner, a, b in zip(owners, first, [*first[1:], len(keys)]):
                once = counts[a:b] == 1
                rows.append((int(owner), low[a:b][once].tobytes(), low[a:b][~once].tobytes(), counts[a:b][~once].astype(np.uint32).tobytes()))
            if rows:
                part_, once_, keys_, counts_ = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(part_, pa.int32()), *(pa.array(c, pa.binary()) for c in (once_, keys_, counts_))],
                                                 ["part", "once", "keys", "counts"])

    def summarised(table: pa.Table) -> pa.Table:
        def entries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for once, keys, counts in zip(table["once"], table["keys"], table["counts"]):
                own = np.frombuffer(once.as_py(), np.uint32)
                yield own, np.ones(len(own), np.int64)
                yield np.frombuffer(keys.as_py(), np.uint32), np.frombuffer(counts.as_py(), np.uint32).astype(np.int64)

        mass = sum(int(c.sum()) for _, c in entries())
        keys, counts, loss = summary(entries(), mass, least)
        found = np.zeros(1 << (TABLE_BITS - bits), bool)
        found[(keys[counts + loss >= least] >> np.uint32(32 - TABLE_BITS + bits)).astype(np.int64)] = True
        return pa.table({"part": table["part"][:1], "marks": pa.array([np.packbits(found).tobytes()], pa.binary())})

    table = np.zeros((1 << bits, 1 << (TABLE_BITS - bits - 3)), np.uint8)
    for row in texts.mapInArrow(dealt, SUMMARY).groupBy("part").applyInArrow(summarised, "part int, marks binary").toLocalIterator():
        table[row["part"]] = np.frombuffer(bytes(row["marks"]), np.uint8)  # 2 ** TABLE_BITS bits in all
    return table.ravel()


def counted(texts: DataFrame, pairs: np.ndarray, longer: np.ndarray) -> DataFrame:
    """(lang, size, phrase, n): how often each marked phrase occurs; size 0 counts all words of a language."""
    given = texts.sparkSession.sparkContext.broadcast((pairs, longer))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, longer = given.value
        for lang, data in blocks(batches):
            words = words_in(data)
            follows = inner_pairs(words, lang, pairs)
            sizes, phrases, times = [0], [""], [len(words.hash)]
            for size, at, hashes in phrase_hashes(words, lang, LONGEST):
                if size <= 2:
                    kept = marks_of(pairs, hashes)
                else:
                    kept = np.logical_and.reduce([follows[at + i] for i in range(size - 1)])
                    kept[kept] = marks_of(longer, hashes[kept])
                _, first, count = np.unique(hashes[kept], return_index=True, return_counts=True)
                begin = at[kept][first]
                for a, b in zip(words.start[begin].tolist(), words.end[begin + size - 1].tolist()):
                    text = data[a:b].decode()
                    phrases.append(text if size == 1 else " ".join(SPACES.split(text)))
                sizes += [size] * len(first)
                times += count.tolist()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(sizes), pa.string()), pa.array(sizes, pa.int32()), pa.array(phrases, pa.string()),
                                              pa.array(times, pa.int64())], ["lang", "size", "phrase", "n"])

    return texts.mapInArrow(counts, COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, size, phrase, n) of the words and phrases that occur ``least`` times, and with size 0 the number of words of each language."""
    texts = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_PARTITION_BITS, max(1, (groups_for(size, GROUP_BYTES) - 1).bit_length()))
    pairs = marked(texts, bits, least)
    longer = marked(texts, bits, least, pairs)
    return counted(texts, pairs, longer).where((F.col("n") >= least) | (F.col("size") == 0))


def whole(number: Column) -> Column:
    return number.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    known = store(frequent(docs, least), "phrases")
    phrase = known.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    run = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = phrase.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("head"), run(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    part = lambda name, count: known.where("size > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    placed = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    scored = placed.withColumn("x", whole(F.col("a")) * 2_000_000).withColumn("y", whole(F.col("l")) + whole(F.col("r"))).withColumn("score", F.expr("x div y"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = F.filter(F.flatten(F.transform(F.sequence(F.lit(1), F.col("size")), lambda i: F.transform(
        F.sequence(F.lit(2), F.greatest(F.lit(2), F.col("size") - 1)), lambda m: F.struct(i.alias("i"), m.alias("m"))))),
        lambda s: (s["i"] + s["m"] - 1 <= F.col("size")) & (s["m"] < F.col("size")))
    inside = phrase.where("size > 2").withColumn("span", F.explode(spans)).select(
        "lang", run(F.col("span.i"), F.col("span.m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    open_ = weakest.join(inside, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (whole(F.col("around")) * 100 < whole(F.col("a")) * 80))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = open_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = known.where("size = 0").select("lang", F.col("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                                           "n", F.col("cut.score").cast("long").alias("score"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS MATERIALIZED (
  SELECT row_number() OVER () AS piece_id, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT piece_id, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM lists),
runs AS MATERIALIZED (
  SELECT lang, w1, lead(w1, 1) OVER later AS w2, lead(w1, 2) OVER later AS w3, lead(w1, 3) OVER later AS w4
  FROM words WINDOW later AS (PARTITION BY piece_id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS size, w1 AS phrase FROM runs UNION ALL
  SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL UNION ALL
  SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL),
known AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= 30),
sizes AS MATERIALIZED (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY 1),
phrases AS MATERIALIZED (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM known WHERE size > 1),
cuts AS (
  SELECT p.lang, p.phrase, a, k, l.n AS l, r.n AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (CAST(l.n AS HUGEINT) + r.n) AS BIGINT) AS score
  FROM phrases p, (VALUES (1), (2), (3)) AS c(k), known l, known r
  WHERE k < p.size AND l.lang = p.lang AND l.phrase = array_to_string(w[1:k], ' ') AND r.lang = p.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS turn FROM cuts) WHERE turn = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS around
  FROM phrases, (VALUES (1), (2), (3)) AS s(i), (VALUES (2), (3)) AS t(m) WHERE i + m - 1 <= size AND m < size GROUP BY 1, 2)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR CAST(100 AS HUGEINT) * around < CAST(80 AS HUGEINT) * a)
JOIN sizes USING (lang) WHERE rank <= 2000"""
