"""Language-model scoring with a hidden Markov model over words.

Every training word has an emission of its own in every state. The state-by-word table grows with the vocabulary and stays distributed; a
block of documents is sent the rows of its own words only. What a state has not seen of a word is backed off to the word's class:
p(word | state) = seen * (expected count / state's total) + (1 - seen) * p(class | state) * p(word | class), with seen = N / (N + V) for N training
tokens of V words. The TOP most frequent words are classes of their own, all others fall into HASHED classes by their last letters, so
that unknown words have a class as well, and the class table has a fixed size.

Steps, all over whole texts:
1. Documents are coded once, block by block: a block's distinct words, and each text as numbers in them. No text is shuffled.
2. Words are counted over all training documents. Here and later, words are dealt by the range of their hash: a block gives one row of packed
   arrays for each range.
3. Baum-Welch, ROUNDS rounds: tasks run scaled forward-backward over their blocks. All rounds but the last read the training texts as classes, stored once, and sum the expected counts by
   slices of the class table; in the last one by word, into the state-by-word table. (p(word | class) is the same in every state, so that round needs no table either.)
   The chain runs through each text as a whole and starts at its first token only. Work goes by segments of SEGMENT tokens: forward vectors are carried
   out of a text's first segment, backward ones out of its last, and both over a segment between them by its transfer matrix, so segments are worked
   side by side and a text's length costs no memory but its own. Arrays have a row for each state, so that numpy runs along the segments.
   Every round runs over every block.
4. Scoring: each block gets the counts of its own words back, in the order of their hashes, and a scaled forward recursion over the whole text gives its exact likelihood.

Defined cases: a null or empty text is the end token alone; a null doc_id hashes as the empty text; repeated rows are scored one by
one and count as often; without training rows every word is unknown and the states are alike; an empty table gives no rows; other columns are not
read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import DROP_SHUFFLES, scratch_path, settings, store

STATES = 6
TOP = 8192
HASHED = 8192
CLASSES = TOP + HASHED
SEGMENT = 512
ROWS = 2048
WIDE = 512
ROUNDS = 13
BLOCK_DOCS, BLOCK_TOKENS = 1 << 14, 1 << 22
PIECE = 1 << 23
SLICE = 4096
END = b""
BLOCK = ("block long, hashes array<long>, suffixes binary, trained binary, codes binary, lengths binary, held binary, "
         "doc_ids array<long>")
TRAINED = "classes binary, sizes binary"
TINY = 1e-30
EXPECTED = [f"e{k}" for k in range(STATES)]
WORDS = "hash long, count long, " + ", ".join(f"{e} float" for e in EXPECTED)
PACKED = "part int, block long, first int, hashes binary, counts binary, sums binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """How many words each text has (null: none), all their words as places in the last list, and that list: distinct, A-Z lower-cased."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    flat = lists.flatten()
    some = pc.not_equal(flat, "")
    sizes = np.diff(np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[lists.offsets.to_numpy()])
    own = (flat if len(flat) == pc.sum(some).as_py() else flat.filter(some)).dictionary_encode()
    ends, data = np.frombuffer(own.dictionary.buffers()[1], np.int32)[:len(own.dictionary) + 1].tolist() if len(own) else [], own.dictionary.buffers()[2]
    data = data.to_pybytes() if data else b""
    return sizes, own.indices.to_numpy(), [data[a:b] for a, b in zip(ends, ends[1:])]


def coded(docs: DataFrame) -> DataFrame:
    """Blocks of documents: distinct words, their training counts, and each text as numbers; every text ends with END."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        words, codes, lengths, held, ids = Numbers(), [], [], [], []

        def finished() -> pa.RecordBatch:
            sizes = np.array(lengths, np.int32)
            every = np.concatenate(codes)
            train = np.repeat(~np.array(held, bool), sizes)
            names = list(words)
            return pa.RecordBatch.from_arrays([
                pa.array([base + made], pa.int64()), pa.ListArray.from_arrays(
                    pa.array([0, len(names)], pa.int32()), pa.array([xxhash.xxh64_intdigest(w) - (1 << 63) for w in names], pa.int64())),
                *[
                    pa.array([x.tobytes()], pa.binary()) for x in (
                        np.array([zlib.crc32(w[-3:]) % HASHED for w in names], np.int32), np.bincount(every[train], minlength=len(names)).astype(np.int32),
                        every, sizes, np.array(held, np.uint8))], pa.array([ids], pa.list_(pa.int64()))],
                [c.split()[0] for c in BLOCK.split(", ")])

        tokens = 0
        for batch in batches:
            for begin, end in pieces(batch.column(1)):
                part = batch.slice(begin, end - begin)
                sizes, places, names = words_of(part.column(1))
                ends, doc_ids, at = np.append(0, np.cumsum(sizes)), part.column(0).to_pylist(), 0
                while at < len(sizes):
                    full = int(np.searchsorted(tokens + np.cumsum(sizes[at:] + 1), BLOCK_TOKENS)) + 1  # the text that fills the block is its last
                    to = min(at + full, at + BLOCK_DOCS - len(ids), len(sizes))
                    own, found = places[ends[at]:ends[to]], sizes[at:to]
                    used = np.zeros(len(names), bool)
                    used[own] = True
                    used = np.flatnonzero(used)
                    number = np.empty(len(names), np.int32)
                    number[used] = np.fromiter(map(words.__getitem__, [names[i] for i in used]), np.int32, len(used))
                    every = np.full(len(own) + len(found), words[END], np.int32)
                    every[np.arange(len(own)) + np.repeat(np.arange(len(found)), found)] = number[own]
                    codes.append(every)
                    lengths += (found + 1).tolist()
                    held += [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i in doc_ids[at:to]]
                    ids += doc_ids[at:to]
                    tokens += len(every)
                    at = to
                    if len(ids) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                        yield finished()
                        made += 1
                        tokens = 0
                        words, codes, lengths, held, ids = Numbers(), [], [], [], []
        if ids:
            yield finished()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(blocks, BLOCK)


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of texts, each of about PIECE bytes."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(sizes // PIECE)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)])


@dataclass
class Model:
    """top: hash -> class of the frequent words; start, move, emit: probabilities (emit by class or by a block's word, then state)."""

    top: dict[int, int]
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def light(self) -> Model:
        """In single precision, for forward-backward; counts are summed in double precision."""
        return Model(self.top, *[x.astype(np.float32) for x in (self.start, self.move, self.emit)])


def classes_of(hashes: np.ndarray, suffixes: np.ndarray, top: dict[int, int]) -> np.ndarray:
    found = TOP + suffixes
    if top:
        known, own = np.fromiter(top.keys(), np.int64, len(top)), np.fromiter(top.values(), np.int64, len(top))
        order = np.argsort(known)
        known, own = known[order], own[order]
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        found[hit] = own[at[hit]]
    return found


def parts_in(spark: SparkSession) -> int:
    """So many ranges of hashes are dealt."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_hash(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by hash, and where each of ``parts`` ranges of hashes begins in it."""
    own = hashes.view(np.uint64)
    order = np.argsort(own, kind="stable")
    return order, np.searchsorted(((own[order] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))


def dealt(block: int | None, hashes: np.ndarray, parts: int, counts: np.ndarray | None = None, sums: np.ndarray | None = None) -> pa.RecordBatch:
    """One PACKED row for each range of hashes with a word; ``first`` is its place in the order by hash. ``sums`` has a row for each state."""
    order, cuts = by_hash(hashes, parts)
    some = np.flatnonzero(np.diff(cuts))
    lists = [None if x is None else [np.ascontiguousarray(x[..., order[cuts[p]:cuts[p + 1]]]).tobytes() for p in some] for x in (hashes, counts, sums)]
    return pa.RecordBatch.from_arrays([
        pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(cuts[some], pa.int32()),
        *[pa.nulls(len(some), pa.binary()) if x is None else pa.array(x, pa.binary()) for x in lists]], [c.split()[0] for c in PACKED.split(", ")])


def unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


def unpacked_sums(column: pa.ChunkedArray) -> np.ndarray:
    """The sums of several rows side by side: a row for each state."""
    return np.concatenate([np.empty((STATES, 0), np.float32), *[np.frombuffer(x.as_py(), np.float32).reshape(STATES, -1) for x in column]], 1)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(hash, suffix, count) of every training word."""
    parts = parts_in(blocks.sparkSession)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                hashes, suffixes, trained = row[0].values.to_numpy(), *(np.frombuffer(x.as_py(), np.int32) for x in row[1:])
                used = trained > 0
                both = np.stack([suffixes[used], trained[used]])
                yield dealt(None, hashes[used], parts, both)

    def of_part(rows: pa.Table) -> pa.Table:
        hashes = unpacked(rows["hashes"], np.int64)
        suffixes, trained = np.concatenate([np.frombuffer(x.as_py(), np.int32).reshape(2, -1) for x in rows["counts"]], 1)
        words, at, own = np.unique(hashes, return_index=True, return_inverse=True)
        return pa.table({"hash": words, "suffix": suffixes[at], "count": np.bincount(own, weights=trained).astype(np.int64)})

    return blocks.select("hashes", "suffixes", "trained").mapInArrow(of_task, PACKED).groupBy("part").applyInArrow(of_part, "hash long, suffix int, count long")


def first_model(top: dict[int, int], share: np.ndarray, seed: int = 5) -> Model:
    """Each state's emissions are the classes' shares, each turned up or down at random; states tend to stay."""
    random = np.random.default_rng(seed)
    emit = (share[:, None] + 1e-9) * random.uniform(0.2, 1.8, (CLASSES, STATES))
    move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
    np.fill_diagonal(move, 0.9)
    return Model(top, np.full(STATES, 1 / STATES), move, emit / emit.sum(0))


def cut(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each segment of SEGMENT tokens starts, and how long it is, text by text."""
    parts = -(-lengths // SEGMENT)
    first = np.repeat(np.cumsum(lengths) - lengths, parts) + SEGMENT * (
        np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return first, np.minimum(SEGMENT, np.repeat(np.cumsum(lengths), parts) - first)


def padded(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of SEGMENT tokens each; the tokens of one step lie side by side."""
    rows = np.lib.stride_tricks.sliding_window_view(np.append(found, np.zeros(SEGMENT, found.dtype)), SEGMENT)
    return np.asfortranarray(rows[first])


def segments(found: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut every SEGMENT tokens, as rows padded at their end, and how long each is; longest first."""
    first, size = cut(lengths)
    order = np.argsort(-size, kind="stable")
    return padded(found, first[order]), size[order]


def live_at(size: np.ndarray, steps: int) -> list[int]:
    """How many of the rows (longest first) are longer than t, for t from 0 to ``steps``."""
    return np.searchsorted(-size, -np.arange(steps + 1), side="left").tolist()


def expected(model: Model, rows: np.ndarray, size: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None,
             opens: np.ndarray | None = None, names: np.ndarray | None = None, kinds: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of padded rows (longest first), by scaled forward-backward.

    ``enter`` is the forward vector before a row's first token, ``leave`` the backward vector after its last one, and ``opens`` says which rows
    begin a text; without them each row is a text. Emissions are counted by ``rows``, or by ``names``, rows of numbers below ``kinds``.
    """
    count, steps = len(size), int(size[0]) if len(size) else 0
    names, kinds = (rows, len(model.emit)) if names is None else (names, kinds)
    enter = np.broadcast_to(model.start, (count, STATES)) if enter is None else enter
    leave = np.ones((count, STATES), model.emit.dtype) if leave is None else leave
    live = live_at(size, steps)
    starts, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, kinds))
    if not steps:
        return starts, moves, emits
    emit, onto, leave = np.ascontiguousarray(model.emit.T), model.move.T, np.ascontiguousarray(leave.T)
    seen, ahead, scales = [], [], []
    for t in range(steps):
        seen.append(emit.take(rows[:live[t], t], 1))
        state = (enter.T if t == 0 else onto @ ahead[-1][:, :live[t]]) * seen[-1]
        scale = state.sum(0) + TINY
        state /= scale
        ahead.append(state)
        scales.append(scale)
    back, shares, done = np.empty((STATES, 0), model.emit.dtype), np.empty((STATES, sum(live)), model.emit.dtype), 0
    for t in range(steps - 1, -1, -1):
        if live[t + 1] < live[t]:  # these rows end here
            last = leave[:, live[t + 1]:live[t]]
            back = np.concatenate([back, last / ((ahead[t][:, live[t + 1]:] * last).sum(0) + TINY)], 1)
        held = ahead[t] * back
        held /= held.sum(0) + TINY
        shares[:, done:done + live[t]] = held
        done += live[t]
        if t == 0:
            starts = held.sum(1) if opens is None else held[:, opens].sum(1)
            break
        back *= seen[t]
        back /= scales[t]
        moves += model.move * (ahead[t - 1][:, :live[t]] @ back.T)
        back = model.move @ back
    tokens = np.concatenate([names[:live[t], t] for t in range(steps - 1, -1, -1)]).astype(np.int64)
    for k in range(STATES):
        emits[k] = np.bincount(tokens, weights=shares[k], minlength=kinds)
    return starts, moves, emits


def transfers(model: Model, found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each whole segment, up to a factor, the matrix from the forward vector before its first token to the one at its last token."""
    out = np.empty((len(first), STATES, STATES), model.emit.dtype)
    emit, onto = np.ascontiguousarray(model.emit.T), model.move.T
    for begin in range(0, len(first), WIDE):
        start = first[begin:begin + WIDE]
        made = np.eye(STATES, dtype=emit.dtype)[:, :, None] * emit.take(found[start], 1)[:, None]  # by state at the token, state before the segment, segment
        for t in range(1, SEGMENT):
            made = (onto @ made.reshape(STATES, -1)).reshape(made.shape)
            made *= emit.take(found[start + t], 1)[:, None]
            made /= made.sum((0, 1)) + TINY
        out[begin:begin + WIDE] = made.transpose(2, 1, 0)
    return out


def heads(model: Model, found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The forward vectors at the last token of whole segments that begin a text."""
    emit, onto = np.ascontiguousarray(model.emit.T), model.move.T
    state = np.ascontiguousarray(np.broadcast_to(model.start[:, None], (STATES, len(first))))
    for t in range(SEGMENT):
        state = (onto @ state if t else state) * emit.take(found[first + t], 1)
        state /= state.sum(0) + TINY
    return state.T


def tails(model: Model, found: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For segments that end a text, up to a factor, the probability of all their tokens by the state at the first one."""
    order = np.argsort(-size, kind="stable")
    start, live = first[order], live_at(size[order], int(size.max()))
    emit, state = np.ascontiguousarray(model.emit.T), np.empty((STATES, 0), model.emit.dtype)
    for t in range(len(live) - 2, -1, -1):
        new = np.ones((STATES, live[t] - state.shape[1]), state.dtype)
        state = np.concatenate([model.move @ state, new], 1) * emit.take(found[start[:live[t]] + t], 1)
        state /= state.sum(0) + TINY
    out = np.empty((len(size), STATES), state.dtype)
    out[order] = state.T
    return out


def carried(model: Model, found: np.ndarray, first: np.ndarray, size: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``expected`` needs at the segments' borders: (enter, leave), and the expected moves over the borders.

    Of a text's first and last segment one vector is carried, of those between them a matrix.
    """
    enter, leave = np.tile(model.start, (len(size), 1)), np.ones((len(size), STATES), model.emit.dtype)
    moves = np.zeros((STATES, STATES))
    over = np.flatnonzero(np.repeat(parts > 1, parts))  # segments of texts that have several
    if not len(over):
        return enter, leave, moves
    lengths = parts[parts > 1]
    number = np.sort(lengths)[::-1]
    longest = np.argsort(-lengths, kind="stable")
    opens, closes = np.cumsum(lengths) - lengths, np.cumsum(lengths) - 1
    between = np.ones(len(over), bool)
    between[opens] = between[closes] = False
    place = np.cumsum(between) - 1
    through = transfers(model, found, first[over[between]])
    ends, inside = np.empty((len(over), STATES), model.emit.dtype), np.empty((len(over), STATES), model.emit.dtype)
    ends[opens] = heads(model, found, first[over[opens]])
    inside[closes] = tails(model, found, first[over[closes]], size[over[closes]])
    head = opens[longest]
    live = live_at(number, int(number[0]))  # texts with more than s segments
    for s in range(1, number[0]):
        at = head[:live[s]] + s
        enter[over[at]] = ends[at - 1] @ model.move
        at = head[:live[s + 1]] + s
        state = np.einsum("ni,nij->nj", enter[over[at]], through[place[at]])
        ends[at] = state / (state.sum(1, keepdims=True) + TINY)
    for s in range(number[0] - 1, 0, -1):
        at = head[:live[s + 1]] + s
        inside[at] = np.einsum("nij,nj->ni", through[place[at]], leave[over[at]])
        at = head[:live[s]] + s
        whole = ((ends[at - 1] @ model.move) * inside[at]).sum(1, keepdims=True) + TINY
        moves += model.move * (ends[at - 1].T @ (inside[at] / whole))
        before = inside[at] @ model.move.T
        leave[over[at - 1]] = before / (before.sum(1, keepdims=True) + TINY)
    return enter, leave, moves


def expected_of_texts(model: Model, found: np.ndarray, lengths: np.ndarray, names: np.ndarray | None = None,
                      kinds: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of whole texts, however long; emissions by ``found``, or by ``names``, numbers below ``kinds`` for each token."""
    parts = -(-lengths // SEGMENT)
    first, size = cut(lengths)
    opens = np.zeros(len(size), bool)
    opens[np.cumsum(parts) - parts] = True
    enter, leave, moves = carried(model, found, first, size, parts)
    starts, emits = np.zeros(STATES), np.zeros((STATES, len(model.emit) if names is None else kinds))
    order = np.argsort(-size, kind="stable")
    for begin in range(0, len(order), ROWS):
        own = order[begin:begin + ROWS]
        named = None if names is None else padded(names, first[own])
        more = expected(model, padded(found, first[own]), size[own], enter[own], leave[own], opens[own], named, kinds)
        starts, moves, emits = starts + more[0], moves + more[1], emits + more[2]
    return starts, moves, emits


def trained_on(blocks: DataFrame, top: dict[int, int]) -> DataFrame:
    """The training texts of each block, as the classes of their tokens, and how long they are; stored, as all rounds but the last read no more."""

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, suffixes, codes, lengths, held in zip(*batch.columns):
                sizes, train = np.frombuffer(lengths.as_py(), np.int32), ~np.frombuffer(held.as_py(), np.uint8).astype(bool)
                known = classes_of(hashes.values.to_numpy(), np.frombuffer(suffixes.as_py(), np.int32), top).astype(np.uint16)
                found = known[np.frombuffer(codes.as_py(), np.int32)[np.repeat(train, sizes)]]
                yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary()), pa.array([sizes[train].tobytes()], pa.binary())], ["classes", "sizes"])

    path = scratch_path(blocks.sparkSession, "hmm")
    found = blocks.select("hashes", "suffixes", "codes", "lengths", "held").mapInArrow(classed, TRAINED)
    found.write.option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.schema(TRAINED).parquet(path)


def counted(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One Baum-Welch E step over all training texts (``trained_on``): the tasks' tables, summed slice by slice."""
    size, light = STATES * (1 + STATES + CLASSES), model.light()

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(size), False
        for batch in batches:
            for classes, sizes in zip(*batch.columns):
                lengths = np.frombuffer(sizes.as_py(), np.int32).astype(np.int64)
                if len(lengths):
                    any_rows = True
                    total += np.concatenate([x.ravel() for x in expected_of_texts(light, np.frombuffer(classes.as_py(), np.uint16), lengths)])
        parts = range(0, size if any_rows else 0, SLICE)
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array(
            [total[p:p + SLICE].tobytes() for p in parts], pa.binary())], ["slice", "sums"])

    def of_slice(tables: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x.as_py(), np.float64) for x in tables["sums"])
        return pa.table({"slice": tables["slice"][:1], "sums": pa.array([sums.tobytes()], pa.binary())})

    kind = "slice long, sums binary"
    summed = texts.mapInArrow(of_task, kind).groupBy("slice").applyInArrow(of_slice, kind)
    total = np.zeros(size)
    with settings(texts.sparkSession, DROP_SHUFFLES):
        for row in summed.collect():  # one table of fixed size
            total[row["slice"]:row["slice"] + len(row["sums"]) // 8] = np.frombuffer(bytes(row["sums"]), np.float64)
    return total[:STATES], total[STATES:STATES * (1 + STATES)].reshape(STATES, STATES), total[STATES * (1 + STATES):].reshape(STATES, CLASSES)


def maximised(model: Model, sums: tuple[np.ndarray, np.ndarray, np.ndarray], share: np.ndarray) -> Model:
    """The M step; a little of the classes' overall share is added so that no state rules a class out."""
    starts, moves, emits = sums
    emit = emits.T + 10.0 * share[:, None] + 1e-9
    move, start = moves + 0.1, starts + 0.1
    return Model(model.top, start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


@dataclass
class Words:
    """What tasks need beside the class model to give each word its own emissions; of fixed size."""

    model: Model
    tokens: int
    kinds: int
    class_tokens: np.ndarray  # of the HASHED classes
    class_kinds: np.ndarray
    totals: np.ndarray | None = None  # expected tokens of each state; None without training words

    def emissions(self, classes: np.ndarray, count: np.ndarray, expected_counts: np.ndarray) -> np.ndarray:
        """p(word | state) by word, then state: expected counts, backed off to the word's class."""
        own = np.maximum(classes - TOP, 0)
        inside = np.where(classes < TOP, 1.0, (count + 1) / (self.class_tokens[own] + self.class_kinds[own] + 1))
        backed = self.model.emit[classes] * inside[:, None]
        if self.totals is None:
            return backed
        seen = self.tokens / (self.tokens + self.kinds)
        return seen * expected_counts / (self.totals + TINY) + (1 - seen) * backed


def local_model(words: Words, block: pa.Table, known: pa.Table) -> tuple[Model, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One block's own model, with emissions by its words; then text lengths, codes, which texts are held out, and the words' counts."""
    classes = np.frombuffer(block["classes"][0].as_py(), np.int32)
    count, own = np.zeros(len(classes)), np.zeros((len(classes), STATES))
    for first, counts, sums in zip(*(known[c] for c in ("first", "counts", "sums"))):
        found = np.frombuffer(counts.as_py(), np.int64)
        at = slice(first.as_py(), first.as_py() + len(found))
        count[at], own[at] = found, np.frombuffer(sums.as_py(), np.float32).reshape(STATES, -1).T
    m, lengths = words.model, np.frombuffer(block["lengths"][0].as_py(), np.int32).astype(np.int64)
    codes = np.frombuffer(pa.decompress(block["codes"][0].as_py(), int(4 * lengths.sum()), "zstd", asbytes=True), np.int32)
    return (Model({}, m.start, m.move, words.emissions(classes, count, own)), lengths, codes,
            np.frombuffer(block["held"][0].as_py(), np.uint8).astype(bool), count)


def with_rows(blocks: DataFrame, table: DataFrame) -> DataFrame:
    """The table's counts for the words of each block, packed, one row for each range of hashes; words without a row were not trained on and have none."""
    parts = parts_in(blocks.sparkSession)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashes in zip(*batch.columns):
                yield dealt(block.as_py(), hashes.values.to_numpy(), parts)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts, *sums = (x.to_numpy() for x in batch.columns)
            yield dealt(None, hashes, parts, counts, np.stack(sums))

    def of_part(asked: pa.Table, table: pa.Table) -> pa.Table:
        hashes, counts, sums = unpacked(table["hashes"], np.int64), unpacked(table["counts"], np.int64), unpacked_sums(table["sums"])
        order = np.append(np.argsort(hashes), len(hashes))  # the last place stands for a word without a row
        sorted_hashes, counts, sums = hashes[order[:-1]], np.append(counts, 0)[order], np.append(sums, np.zeros((STATES, 1), np.float32), 1)[:, order]
        found: list[tuple[bytes, bytes]] = []
        for x in asked["hashes"]:
            own = np.frombuffer(x.as_py(), np.int64)
            at = np.searchsorted(sorted_hashes, own)
            at[np.append(sorted_hashes, 0)[at] != own] = len(hashes)
            found.append((counts[at].tobytes(), np.ascontiguousarray(sums[:, at]).tobytes()))
        return pa.table({"home": asked["block"], "first": asked["first"], "counts": pa.array([c for c, _ in found], pa.binary()),
                         "sums": pa.array([x for _, x in found], pa.binary())})

    questions = blocks.select("block", "hashes").mapInArrow(asked, PACKED)
    answers = table.select("hash", "count", *EXPECTED).mapInArrow(held, PACKED)
    return questions.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(of_part, "home long, first int, counts binary, sums binary")


def counted_words(blocks: DataFrame, model: Model) -> DataFrame:
    """The last E step, over all training texts: each training word's count and expected count in each state."""
    light, parts = model.light(), parts_in(blocks.sparkSession)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes, suffixes, trained, codes, lengths, held = (batch.column(c)[i] for c in range(6))
                hashes, suffixes, trained = hashes.values.to_numpy(), *(np.frombuffer(x.as_py(), np.int32) for x in (suffixes, trained))
                sizes, train = np.frombuffer(lengths.as_py(), np.int32).astype(np.int64), ~np.frombuffer(held.as_py(), np.uint8).astype(bool)
                if not train.any():
                    continue
                own = np.frombuffer(codes.as_py(), np.int32)[np.repeat(train, sizes)]
                found = classes_of(hashes, suffixes, model.top).astype(np.uint16)[own]
                emits = expected_of_texts(light, found, sizes[train], own, len(hashes))[2]
                used = trained > 0
                yield dealt(None, hashes[used], parts, trained[used], emits[:, used].astype(np.float32))

    def of_part(rows: pa.Table) -> pa.Table:
        words, own = np.unique(unpacked(rows["hashes"], np.int64), return_inverse=True)
        added = lambda x: np.bincount(own, weights=x)
        return pa.table({"hash": words, "count": added(unpacked(rows["counts"], np.int32)).astype(np.int64), **{
            e: added(x).astype(np.float32) for e, x in zip(EXPECTED, unpacked_sums(rows["sums"]))}})

    found = blocks.select("hashes", "suffixes", "trained", "codes", "lengths", "held").mapInArrow(of_task, PACKED)
    return found.groupBy("part").applyInArrow(of_part, WORDS)


def nothing(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))})


def likelihoods(model: Model, found: np.ndarray, inside: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each text by the scaled forward recursion; ``inside`` is added for each token."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths)
    first, size = (ends - lengths)[order], lengths[order]
    result = np.zeros(len(lengths))
    state = np.broadcast_to(model.start[:, None], (STATES, len(size)))
    onto = model.move.T
    for t, n in enumerate(live_at(size, int(size[0]) if len(size) else 0)[:-1]):
        state = (onto @ state[:, :n] if t else state) * model.emit[found[first[:n] + t]].T
        scale = state.sum(0)
        result[:n] += np.log10(scale)
        state /= scale
    out = np.empty(len(lengths))
    out[order] = result
    return out + np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=inside, minlength=len(lengths))


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "hmm")
    coded(docs).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(BLOCK).parquet(path)
    counts = store(word_counts(blocks), "hmm")
    totals = counts.agg(F.sum("count"), F.count("*")).first()
    tokens, kinds = int(totals[0] or 0), int(totals[1] or 0)
    frequent = counts.orderBy(F.desc("count"), "hash").limit(TOP).collect()
    top = {r["hash"]: i for i, r in enumerate(frequent)}

    share = np.zeros(CLASSES)
    share[:len(frequent)] = [r["count"] for r in frequent]
    rest_tokens, rest_kinds = np.zeros(HASHED), np.zeros(HASHED)
    rest = counts.join(F.broadcast(counts.orderBy(F.desc("count"), "hash").limit(TOP).select("hash")), "hash", "left_anti")
    for row in rest.groupBy("suffix").agg(F.sum("count").alias("tokens"), F.count("*").alias("kinds")).collect():  # HASHED rows at most
        rest_tokens[row["suffix"]], rest_kinds[row["suffix"]] = row["tokens"], row["kinds"]
    share[TOP:] = rest_tokens
    share = (share + 1e-3) / (share + 1e-3).sum()

    model = first_model(top, share)
    if tokens and rounds > 1:
        texts = trained_on(blocks, top)
        for _ in range(rounds - 1):
            model = maximised(model, counted(texts, model), share)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words numbered anew, in the order of their hashes."""
        for batch in batches:
            classes, codes = [], []
            for row in zip(*batch.columns[:3]):
                hashes, suffixes, code = row[0].values.to_numpy(), *(np.frombuffer(x.as_py(), np.int32) for x in row[1:])
                order = by_hash(hashes, 1)[0]
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order))
                classes.append(classes_of(hashes, suffixes, top)[order].astype(np.int32).tobytes())
                codes.append(pa.compress(place[code].tobytes(), "zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), pa.array(codes, pa.binary()), *batch.columns[3:]], ["classes", *batch.schema.names[2:]])

    whole = blocks.select("hashes", "suffixes", "codes", "block", "lengths", "held", "doc_ids").mapInArrow(
        classed, "classes binary, codes binary, block long, lengths binary, held binary, doc_ids array<long>")

    table = store(counted_words(blocks, model), "hmm")
    totals = np.array([x or 0.0 for x in table.agg(*[F.sum(F.col(e).cast("double")) for e in EXPECTED]).first()])
    words = Words(model, tokens, kinds, rest_tokens, rest_kinds, totals if tokens else None)
    rows = with_rows(blocks, table)

    def of_block(block: pa.Table, known: pa.Table) -> pa.Table:
        out = [rows_of(block.slice(i, 1), known) for i in range(block.num_rows)]
        return pa.concat_tables(out) if out else nothing(SCORES)

    def rows_of(block: pa.Table, known: pa.Table) -> pa.Table:
        m, lengths, codes, held, count = local_model(words, block, known)
        base = np.log10((count + 1) / (tokens + kinds + 1))
        doc = np.repeat(np.arange(len(lengths)), lengths)
        return pa.table({
            "doc_id": block["doc_ids"][0].values, "held_out": pa.array(held), "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.bincount(doc, weights=count[codes] > 0, minlength=len(lengths)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(lengths), tokens, np.int64)),
            "base_score": pa.array(np.bincount(doc, weights=base[codes], minlength=len(lengths))),
            "score": pa.array(likelihoods(m, codes, np.zeros(len(codes)), lengths))})

    return whole.groupBy("block").cogroup(rows.groupBy("home")).applyInArrow(of_block, SCORES)
