"""Line dedup by an exact set-similarity join: of two lines whose word sets are alike, the later one goes.

A line is taken as the set of its words (A-Z lower-cased). Sets are alike if their Jaccard similarity is at least ``percent``.
A line is removed if an earlier line (by doc_id, then line number) is alike, whether or not that one is removed itself.
Lines with equal sets are one class; a line's links are the other sets that are alike, all of them, earlier and later.

1. One pass reads the lines and counts words in a table of fixed size, by hash. (count in steps of 0.7 percent, hash) is a total order of words by rarity.
2. Each set's rarest words, so many that two alike sets share one of them (the prefix), are dealt by word: a block of lines gives one row of packed
   arrays for each group of words, and there are the more groups the more words there are. Sets with a word in common are
   compared in order of length: the length filter ends the comparison; the positional filter and the parity map of the words, whose
   differing bits are no more than the words that differ, bound the overlap that is left. A pair that also shares the prefix word before is left to that word.
   What is kept is which sets have a partner there, not the pairs, so a group of near copies costs a row for each of its sets and words.
3. These sets are dealt by word once more, with all their words. Every pair is compared on the full sets, and counts in the group of its rarest common word only.
A word of more than HOT lines is dealt in tiles, each pair of which is a group of its own, so no task holds all its lines.
4. Of a class only the first line can stay.

Defined cases: lines without words are never removed and match nothing; a null text has no lines; null doc_ids come first; rows that
share doc_id and line number and have equal words stand or fall together; an empty table gives no rows; other columns are kept by ``without_removed``,
which takes each row by itself, and not read otherwise. Words and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm.common import fresh, numbered
from wattloom.llm.line_sets import Lines, lines_of, order_within
from wattloom.llm.sets import SLICE, TABLE, added_slices, mixed
from wattloom.session import store

PERCENT = 80
AT_ONCE = 1 << 20
RARITY = 1 << 22
WANTED = 1 << 26
HOT = 1 << 16
MAP_WORDS = 2
STEP_BITS = 12
BITS = 64 * MAP_WORDS
PART_WORDS = 1 << 19
PACK_ROWS = 1 << 17
LINE_BYTES = 1 << 20
POSTING = "word long, before long, size int, place int, key long, " + ", ".join(f"bits{i} long" for i in range(MAP_WORDS))
KINDS = {name: {"int": np.int32, "long": np.int64}[kind] for name, kind in (c.split() for c in POSTING.split(", "))}
PACKED = "part int, " + ", ".join(f"{c} binary" for c in KINDS)
LINK = "key long, links long, match_doc_id long, match_line int, similarity double"


def prefix_length(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """So many rarest words that any alike set shares one."""
    return size - -(-percent * size // 100) + 1


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap at which sets of these sizes are alike."""
    return -(-percent * (a + b) // (100 + percent))


def steps_of(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of STEP_BITS bits that keeps their order; words of one step are told apart by hash."""
    return np.minimum(np.log2(np.maximum(counts, 1)) * 100, (1 << STEP_BITS) - 1).astype(np.uint64)


def read_lines(texts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, line, key) of each line with a word, and how many lines hold each word, by hash: one pass, stored."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY, np.uint32)
        for batch in batches:
            for lines in lines_of(batch.column(1), LINE_BYTES):
                np.add.at(total, (lines.members % np.uint64(RARITY)).astype(np.int64), np.uint32(1))
                nothing = pa.nulls(len(lines.key))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lines.text)), pa.array(lines.number.astype(np.int32)), pa.array(lines.key),
                                                  nothing.cast(pa.int32()), nothing.cast(pa.binary())], ["doc_id", "line", "key", "slice", "sums"])
        parts = [p for p in range(0, RARITY, SLICE) if total[p:p + SLICE].any()]
        nothing = pa.nulls(len(parts))
        yield pa.RecordBatch.from_arrays([nothing.cast(pa.int64()), nothing.cast(pa.int32()), nothing.cast(pa.int64()), pa.array(parts, pa.int32()), pa.array(
            [total[p:p + SLICE].tobytes() for p in parts], pa.binary())], ["doc_id", "line", "key", "slice", "sums"])

    both = store(texts.select("doc_id", "text").mapInArrow(rows, f"doc_id long, line int, key long, {TABLE}"), "lines")
    return both.where("slice is null").select("doc_id", "line", "key"), added_slices(both.where("slice is not null").select("slice", "sums"), RARITY)


def bit_maps(lines: Lines, chosen: np.ndarray) -> np.ndarray:
    """MAP_WORDS numbers for each chosen line: each of its words turns one bit."""
    bit = (lines.members >> np.uint64(24)) % np.uint64(BITS)
    turned, half = np.uint64(1) << (bit % np.uint64(64)), bit // np.uint64(64)
    maps = [np.bitwise_xor.reduceat(np.where(half == i, turned, np.uint64(0)), lines.starts) if len(bit) else bit for i in range(MAP_WORDS)]
    return np.stack(maps, 1)[chosen].view(np.int64)


def tile_of(key: np.ndarray, tiles: np.ndarray) -> np.ndarray:
    return (mixed(key.view(np.uint64)) % tiles.astype(np.uint64)).astype(np.int64)


def tile_group(word: np.ndarray, tile: np.ndarray, other: np.ndarray) -> np.ndarray:
    pair = (np.minimum(tile, other) << 31) + np.maximum(tile, other) + 1
    return mixed(word + mixed(pair.astype(np.uint64)))


def tiled(at: np.ndarray, word: np.ndarray, often: np.ndarray, key: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, group) under which rows are dealt. A word's group is itself; a word of more than ``hot`` lines has a group for each pair of tiles, so that any two of its sets meet in one."""
    tiles = -(-often.astype(np.int64) // hot)
    plain = tiles <= 1
    rows, groups = [at[plain]], [word[plain]]
    split, count = np.flatnonzero(~plain), tiles[~plain]
    if len(split):
        own = np.repeat(split, count)
        other = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        rows.append(at[own])
        groups.append(tile_group(word[own], tile_of(key[own], tiles[own]), other))
    return np.concatenate(rows), np.concatenate(groups)


def meeting_group(word: np.ndarray, often: np.ndarray, a: np.ndarray, b: np.ndarray, hot: int) -> np.ndarray:
    """Of the groups of a word in which two sets (keys a, b) meet, the one that their pair belongs to."""
    tiles = -(-often.astype(np.int64) // hot)
    return np.where(tiles <= 1, word, tile_group(word, tile_of(a, np.maximum(tiles, 1)), tile_of(b, np.maximum(tiles, 1))))


def parts_for(spark: SparkSession, words: int) -> int:
    """Into so many groups the words of postings are dealt, if lines hold ``words`` words."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // PART_WORDS))


def packed(columns: dict[str, np.ndarray], parts: int) -> pa.RecordBatch:
    """One PACKED row for each of ``parts`` groups of words that has postings: their columns, as bytes."""
    spread = mixed(columns["word"].view(np.uint64))  # of equally rare words the prefix has those with small hashes
    part = ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(part, kind="stable")
    some, starts = np.unique(part[order], return_index=True)
    cuts = np.append(starts, len(part)).tolist()
    lists = [[own[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for own in (columns[c][order] for c in KINDS)]
    return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(x, pa.binary()) for x in lists)], ["part", *KINDS])


def postings(texts: DataFrame, rarity: Broadcast, percent: int, hot: int, parts: int) -> DataFrame:
    """The sets and their prefix words that other lines may hold, dealt by groups of words. A set that comes again within a block is dealt once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, held = rarity.value, []

        def ready() -> pa.RecordBatch:
            columns = {c: np.concatenate([x[c] for x in held]) for c in KINDS}
            held.clear()
            return packed(columns, parts)

        for batch in batches:
            for lines in lines_of(batch.column(0), LINE_BYTES):
                dealt = np.zeros(len(lines.key), bool)
                dealt[np.unique(lines.key, return_index=True)[1]] = True
                owner = np.repeat(np.arange(len(lines.size)), lines.size)
                often = count[(lines.members % np.uint64(RARITY)).astype(np.int64)]
                rarest = order_within(owner, steps_of(often), lines.members, STEP_BITS)
                place = np.arange(len(owner)) - lines.starts[owner]  # the sort leaves each line's words in their stretch
                word, often = lines.members[rarest], often[rarest]
                kept = dealt[owner] & (place < prefix_length(lines.size, percent)[owner]) & (often > 1)
                before = np.zeros(len(word), np.uint64)  # 0: none was dealt
                before[1:] = np.where((place[1:] > 0) & (often[:-1] > 1), word[:-1], 0)
                at = np.flatnonzero(kept)
                at, group = tiled(at, word[at], often[at], lines.key[owner[at]], hot)
                place, before, owner = place[at], before[at], owner[at]
                maps = bit_maps(lines, owner)
                held.append({
                    "word": group.view(np.int64), "before": before.view(np.int64), "size": lines.size[owner].astype(np.int32), "place": place.astype(np.int32),
                    "key": lines.key[owner], **{f"bits{i}": maps[:, i] for i in range(MAP_WORDS)}})
                if sum(len(x["word"]) for x in held) >= PACK_ROWS:
                    yield ready()
        if held:
            yield ready()

    return texts.select("text").mapInArrow(rows, PACKED)


def compared(rows: dict[str, np.ndarray], percent: int, known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sets that no filter rules out, each once; ``rows`` lie in order of word and size.

    All rows are compared with the one d places on, for d = 1, 2, ... A row leaves once that one has another word or is too long.
    Pairs of rows that are both ``known``, which may grow meanwhile, are left out.
    """
    word, before, size, place, bits = (rows[c] for c in ("word", "before", "size", "place", "bits"))
    left, d = np.arange(len(word)), 1
    while len(left):
        left = left[left + d < len(word)]
        right = left + d
        near = (word[left] == word[right]) & (100 * size[left] >= percent * size[right])
        left, right = left[near], right[near]
        open_ = (before[left] != before[right]) | (before[left] == 0)
        if known is not None:
            open_ &= ~(known[left] & known[right])
        a, b = left[open_], right[open_]
        room = needed(size[a], size[b], percent)
        fits = np.minimum(place[a], place[b]) + np.minimum(size[a] - place[a], size[b] - place[b]) >= room
        a, b, room = a[fits], b[fits], room[fits]
        apart = np.bitwise_count(bits[a] ^ bits[b]).sum(1)  # unsigned: of a negative number, numpy counts the bits of its absolute value
        alike = 2 * room <= size[a] + size[b] - apart
        yield a[alike], b[alike]
        d += 1


def rows_of(table: pa.Table) -> dict[str, np.ndarray]:
    rows = {c: table[c].to_numpy() for c in ("word", "before", "size", "place", "key")}
    rows["size"], rows["place"] = rows["size"].astype(np.int64), rows["place"].astype(np.int64)
    rows["bits"] = np.stack([table[f"bits{i}"].to_numpy().view(np.uint64) for i in range(MAP_WORDS)], 1)
    return rows


def shared(word: np.ndarray) -> np.ndarray:
    """The rows whose word has another row."""
    order = np.argsort(word)
    twice = np.zeros(len(order) + 1, bool)
    twice[1:-1] = word[order[1:]] == word[order[:-1]]
    return order[twice[1:] | twice[:-1]]


def set_and_word_once(word: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One row for each set and word, in order of word and size."""
    order = np.argsort(word)
    owner = np.cumsum(np.append(0, np.diff(word[order]) != 0))[:len(order)]
    order = order[order_within(owner, size[order].astype(np.uint64), key[order].view(np.uint64), int(size.max(initial=0)).bit_length())]
    first = np.ones(len(order), bool)
    first[1:] = (key[order[1:]] != key[order[:-1]]) | (word[order[1:]] != word[order[:-1]])
    return order[first]


def by_word(dealt: DataFrame, layout: str, of_words: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """``of_words`` over all rows of one or more words: what is dealt is sorted inside its partitions by word, and a word that runs over an Arrow batch is carried into the next one."""

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        return of_words(table.take(pa.array(set_and_word_once(*(table[c].to_numpy() for c in ("word", "size", "key"))))))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch["word"].to_numpy()
            cut = int(np.searchsorted(word, word[-1], side="left"))
            if cut or word[-1] != current:
                ready = [*held, batch.slice(0, cut)]
                held, current = [], word[-1]
                if sum(p.num_rows for p in ready):
                    yield done(ready)
            held.append(batch.slice(cut))
        if held:
            yield done(held)

    return dealt.repartition("word").sortWithinPartitions("word").mapInArrow(words, layout)


def with_partner(dealt: DataFrame, percent: int) -> DataFrame:
    """The rows of sets that some other set of the word may be like."""

    def chosen(dealt: pa.Table) -> pa.Table:
        columns = {c: np.frombuffer(b"".join(x.as_py() for x in dealt[c]), kind) for c, kind in KINDS.items()}
        some = shared(columns["word"])
        once = some[set_and_word_once(*(columns[c][some] for c in ("word", "size", "key")))]
        table = pa.table({c: x[once] for c, x in columns.items()})
        known = np.zeros(len(table), bool)
        for a, b in compared(rows_of(table), percent, known):
            known[a] = known[b] = True
        return table.filter(pa.array(known))

    return dealt.groupBy("part").applyInArrow(chosen, POSTING)


def bit_table(keys: DataFrame) -> bytes:
    """WANTED bits, those of the keys set, whatever their number; tasks set bits of a few slices each, so the driver gets one table."""
    slice_bits = 1 << 19

    def marks(rows: pa.Table) -> pa.Table:
        found = np.zeros(slice_bits, bool)
        found[rows["key"].to_numpy() % slice_bits] = True
        return pa.table({"slice": rows["slice"][:1], "bits": pa.array([np.packbits(found).tobytes()], pa.binary())})

    place = F.pmod(keys.columns[0], F.lit(WANTED))
    dealt = keys.select(place.alias("key")).distinct().select("key", F.expr(f"key div {slice_bits}").cast("int").alias("slice"))
    table = np.zeros((WANTED // slice_bits, slice_bits // 8), np.uint8)
    for row in dealt.groupBy("slice").applyInArrow(marks, "slice int, bits binary").toLocalIterator():  # WANTED bits in all
        table[row["slice"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table.tobytes()


def has_bit(table: bytes, keys: np.ndarray) -> np.ndarray:
    place = (keys % WANTED).astype(np.int64)
    return (np.frombuffer(table, np.uint8)[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0


def parted(rows: DataFrame, number: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``number`` may be among ``keys`` (one column), and those whose is not: a bit table of fixed size says which, so that a join with ``keys`` deals the texts of the first only."""
    table = rows.sparkSession.sparkContext.broadcast(bit_table(keys.select(F.xxhash64(keys.columns[0]).alias("key"))))

    @F.arrow_udf("boolean")
    def may_be(places: pa.Array) -> pa.Array:
        return pa.array(has_bit(table.value, places.to_numpy(zero_copy_only=False)))

    found = may_be(F.xxhash64(number))
    return rows.where(found), rows.where(~found)


def line_places(ids: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A number for each line's place that spreads well."""
    return mixed(mixed(ids.view(np.uint64)) + line.astype(np.uint64)).view(np.int64)


def full_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, doc_id, line, members) of the sets ``wanted`` (key, doc_id, line: their first lines). Only lines at such places are cut into words: a bit table of fixed size says which may be."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(line_places(ids, batch.column(1).to_numpy()))], ["place"])

    table = texts.sparkSession.sparkContext.broadcast(bit_table(wanted.select("doc_id", "line").mapInArrow(places, "place long")))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found: list[bytes] = []
            for doc_id, text in zip(ids, batch.column(1)):
                value = text.as_buffer()
                if value is None:
                    continue
                data = value.to_pybytes()
                numbers = np.arange(data.count(b"\n") + 1)
                asked = np.flatnonzero(has_bit(table.value, line_places(np.broadcast_to(doc_id, numbers.shape).copy(), numbers)))
                if len(asked):
                    cut = data.split(b"\n")
                    found += [cut[i] for i in asked]
            for lines in lines_of(pa.array(found, pa.binary())):
                key, at = np.unique(lines.key, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([lines.set_of(i).tobytes() for i in at], pa.binary())], ["key", "members"])

    return texts.select("doc_id", "text").mapInArrow(members, "key long, members binary").dropDuplicates(["key"]).join(wanted, "key")


class Sets:
    """Full sets of some rows, their words numbered from the rarest on; each set lies in that order."""

    def __init__(self, members: pa.ChunkedArray, count: np.ndarray) -> None:
        cut = [np.frombuffer(x.as_buffer(), np.uint64) for x in members]
        self.size = np.array([len(x) for x in cut], np.int64)
        self.starts = np.cumsum(self.size) - self.size
        found, number = np.unique(np.concatenate(cut), return_inverse=True)
        often = count[(found % np.uint64(RARITY)).astype(np.int64)]
        order = np.lexsort((found, steps_of(often)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words, self.often = found[order], often[order]
        owner = np.repeat(np.arange(len(cut)), self.size)
        self.members = np.sort(owner * len(found) + rank[number]) - owner * len(found)

    def _listed(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of these sets, one set after another, and the place in ``sets`` of each."""
        size = self.size[sets]
        place = np.repeat(np.arange(len(sets)), size)
        return self.members[np.arange(len(place)) + np.repeat(self.starts[sets] - (np.cumsum(size) - size), size)], place

    def common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words each pair has in common, and the number of the rarest one (0 if there is none)."""
        (x, pair), (y, other) = self._listed(a), self._listed(b)
        x_at, y_at = pair * len(self.words) + x, other * len(self.words) + y
        found = np.flatnonzero(y_at[np.minimum(np.searchsorted(y_at, x_at), len(y_at) - 1)] == x_at)
        opens = np.ones(len(found), bool)
        opens[1:] = pair[found[1:]] != pair[found[:-1]]
        rarest = np.zeros(len(a), np.int64)
        rarest[pair[found[opens]]] = x[found[opens]]
        return np.bincount(pair[found], minlength=len(a)), rarest


def linked(dealt: DataFrame, rarity: Broadcast, percent: int, most: int, hot: int) -> DataFrame:
    """(key, links, match_doc_id, match_line, similarity) of each word: in how many pairs that belong to the word a set is alike, and its likest earlier partner there, if any."""

    def of_words(table: pa.Table) -> pa.RecordBatch:
        rows, count = rows_of(table), rarity.value
        ids, line = table["doc_id"].fill_null(0).to_numpy(), table["line"].to_numpy()
        order = np.lexsort((line, ids, ~table["doc_id"].is_null().to_numpy()))
        position = np.empty(len(ids), np.int64)
        position[order] = np.arange(len(ids))
        sets, key, group = Sets(table["members"], count), rows["key"], rows["word"].view(np.uint64)
        links = np.zeros(len(key), np.int64)
        partner, share = np.full(len(key), -1), np.zeros(len(key))

        def take(a: np.ndarray, b: np.ndarray) -> None:
            common, rarest = sets.common(a, b)
            both = sets.size[a] + sets.size[b] - common
            good = (100 * common >= percent * both) & (meeting_group(sets.words[rarest], sets.often[rarest], key[a], key[b], hot) == group[a])
            a, b, likeness = a[good], b[good], (common / both)[good]
            np.add.at(links, a, 1)
            np.add.at(links, b, 1)
            late = np.where(position[a] > position[b], a, b)
            early = a + b - late
            best = np.lexsort((position[early], -likeness, late))
            best = best[np.append(True, late[best[1:]] != late[best[:-1]])] if len(best) else best
            late, early, likeness = late[best], early[best], likeness[best]
            better = (partner[late] < 0) | (likeness > share[late]) | ((likeness == share[late]) & (position[early] < position[partner[late]]))
            partner[late[better]], share[late[better]] = early[better], likeness[better]

        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> None:
            a, b = (np.concatenate(x) for x in zip(*held))
            held.clear()
            words = np.cumsum(sets.size[a] + sets.size[b])
            cuts = np.flatnonzero(np.diff(words // most)) + 1  # about ``most`` words at once
            for x, y in zip(np.split(a, cuts), np.split(b, cuts)):
                take(x, y)

        for a, b in compared(rows, percent):
            if len(a):
                held.append((a, b))
                if sum(len(x) for x, _ in held) >= 1 << 15:
                    flush()
        if held:
            flush()
        some = np.flatnonzero(links)
        match = pa.array(partner[some], mask=partner[some] < 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(key[some]), pa.array(links[some]), table["doc_id"].combine_chunks().take(match), table["line"].combine_chunks().take(match),
             pa.array(share[some], mask=partner[some] < 0)], [c.split()[0] for c in LINK.split(", ")])

    return by_word(dealt, LINK, of_words)


def line_links(docs: DataFrame, percent: int = PERCENT, most: int = AT_ONCE, hot: int = HOT) -> DataFrame:
    """One row for each line with a word: doc_id, line, the first line of its class (first_doc_id, first_line), n_links: how many other sets are alike, removed,
    and for a removed line an earlier one that is alike (match_doc_id, match_line, similarity): its class's first line, or else the likest (first of equals).

    ``most``: full sets are compared about so many words at once.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lines, counts = read_lines(texts)
    rarity = texts.sparkSession.sparkContext.broadcast(counts)  # RARITY numbers, whatever the corpus
    firsts = store(lines.groupBy("key").agg(F.min(F.struct("doc_id", "line")).alias("first")), "lines")
    partners = store(with_partner(postings(texts, rarity, percent, hot, parts_for(texts.sparkSession, int(counts.sum(dtype=np.int64)))), percent), "lines")
    wanted = store(firsts.join(partners.select("key").distinct(), "key", "left_semi").select("key", "first.doc_id", "first.line"), "lines")
    found = linked(partners.join(full_sets(texts, wanted), "key"), rarity, percent, most, hot)
    match = F.struct(F.negative("similarity").alias("apart"), F.col("match_doc_id").isNotNull().alias("known"), "match_doc_id", "match_line")
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"), F.min(F.when(F.col("similarity").isNotNull(), match)).alias("match"))
    classes = firsts.join(store(links, "lines"), "key", "left")
    copy = ~F.struct("doc_id", "line").eqNullSafe(F.col("first"))

    def shown(of_copy: Column, of_other: Column) -> Column:
        return F.when(copy, of_copy).otherwise(of_other)

    return lines.join(classes, "key").select(
        "doc_id", "line", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line").alias("first_line"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), (copy | F.col("match").isNotNull()).alias("removed"),
        shown(F.col("first.doc_id"), F.col("match.match_doc_id")).alias("match_doc_id"), shown(F.col("first.line"), F.col("match.match_line")).alias("match_line"),
        shown(F.lit(1.0), F.negative("match.apart")).alias("similarity"))


def repeated_lines(docs: DataFrame, percent: int = PERCENT, most: int = AT_ONCE, hot: int = HOT) -> DataFrame:
    """One row for each line that goes: doc_id, line, and an earlier line that is alike (match_doc_id, match_line, similarity)."""
    return line_links(docs, percent, most, hot).where("removed").select("doc_id", "line", "match_doc_id", "match_line", "similarity")


def without_removed(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with those lines taken out of text, and n_chars set anew; a document that had words and lost them all goes.

    Each row is a document of its own, in the order of doc_id: rows that share a doc_id, or have none, lose their own lines only, and of equal
    ones the first as read stays.
    """
    row, key, lines = fresh(docs, "_row"), fresh(docs, "_doc"), fresh(docs, "_lines")
    rows = numbered(docs, row)
    removed = repeated_lines(rows.select(F.col(row).alias("doc_id"), "text"), percent).groupBy(F.col("doc_id").alias(key)).agg(
        F.collect_set("line").alias(lines))
    gone = store(removed, "lines")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(lines, i)), "\n")
    changed = F.col(lines).isNotNull()
    some, others = parted(rows, row, gone.select(key))
    joined = some.join(gone, F.col(row) == F.col(key), "left")
    kept = joined.withColumn("text", F.when(changed, left).otherwise(F.col("text"))).where(
        ~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return others.select(*columns).union(kept.select(*columns))
