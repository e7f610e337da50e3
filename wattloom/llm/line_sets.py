"""Word sets of the lines of many texts at once, as numpy arrays.

A word's 64-bit hash comes from running sums over the bytes of a block: the sum between a word's two ends, divided by the power of the
base at its start, depends on the word alone. Words above LONG bytes are hashed one by one, so a block need not hold them.
Blocks of STEP bytes stay in a core's cache.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from wattloom.llm.sets import mixed

BLOCK = 1 << 20
STEP = 1 << 16
LONG = 1 << 12
TEXT_BYTES = 4 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
LETTER = np.random.default_rng(23).integers(0, 2**64, 256, np.uint64) | np.uint64(1)
BASE = 0x5851F42D4C957F2D


def powers(base: int) -> np.ndarray:
    found = np.full(BLOCK, base, np.uint64)
    found[0] = 1
    return np.cumprod(found)


POWER, INVERSE = powers(BASE), powers(pow(BASE, -1, 1 << 64))


@dataclass
class Lines:
    """Lines with a word, in order: place of the text, line number, set key, set size, and all sets one after another (sorted hashes)."""

    text: np.ndarray
    number: np.ndarray
    key: np.ndarray
    size: np.ndarray
    starts: np.ndarray
    members: np.ndarray

    def set_of(self, i: int) -> np.ndarray:
        return self.members[self.starts[i]:self.starts[i] + self.size[i]]


def words_and_lines(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the line number of each word."""
    raw = np.frombuffer(data, np.uint8)
    words, lines = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    at = passed = 0
    while at < len(raw):
        end = min(at + STEP, len(raw))
        blank = (raw[at:end] == 0x20) | (raw[at:end] - np.uint8(0x09) < 5)
        if end < len(raw):
            after = int(blank[::-1].argmax())  # bytes after its last space
            if not blank[-1 - after]:  # the block lies within one word
                space = SPACE.search(data, end)
                end = space.start() if space else len(raw)
                words.append(np.array([xxhash.xxh64_intdigest(data[at:end])], np.uint64))
                lines.append(np.array([passed]))
                at = end
                continue
            end -= after
        part, blank = raw[at:end], blank[:end - at]
        beside = np.ones(len(part) + 2, bool)
        beside[1:-1] = blank
        edges = np.flatnonzero(beside[1:] != beside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(LETTER.take(part) * POWER[:len(part)], out=sums[1:])
        found = mixed(mixed((sums[ends] - sums[starts]) * INVERSE[starts]) + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts > LONG):
            found[i] = xxhash.xxh64_intdigest(data[at + starts[i]:at + ends[i]])
        breaks = np.flatnonzero(part == 10)
        words.append(found)
        lines.append(passed + np.searchsorted(breaks, starts))
        passed += len(breaks)
        at = end
    return np.concatenate(words), np.concatenate(lines)


def order_within(owner: np.ndarray, major: np.ndarray, word: np.ndarray, major_bits: int = 0) -> np.ndarray:
    """The order by owner (ascending already), major and word.

    One number for each row holds the first bits of all three; rows that these bits leave out of order, if any, are sorted in full.
    """
    if not len(word):
        return np.empty(0, np.int64)
    bits = 64 - max(int(owner[-1]).bit_length(), 1)
    low = word >> np.uint64(64 - bits + major_bits)
    order = np.argsort((owner.astype(np.uint64) << np.uint64(bits)) | (major << np.uint64(bits - major_bits)) | low)
    placed, value = (owner.astype(np.uint64) << np.uint64(major_bits) | major)[order], word[order]
    if ((placed[1:] == placed[:-1]) & (value[1:] < value[:-1])).any():
        return np.lexsort((word, np.broadcast_to(major, word.shape), owner))
    return order


def sets_of_lines(texts: list[bytes | None], first: int = 0) -> Lines:
    """The lines of ``texts``, whose places count from ``first``."""
    data = b"\n".join([t or b"" for t in texts]).lower()
    count = np.array([(t or b"").count(b"\n") + 1 for t in texts], np.int64)
    word, line = words_and_lines(data)
    order = order_within(line, np.zeros(1, np.uint64), word)
    word, line = word[order], line[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (line[1:] != line[:-1])
    word, line = word[new], line[new]
    opens = np.ones(len(line), bool)
    opens[1:] = line[1:] != line[:-1]
    starts = np.flatnonzero(opens)
    size = np.diff(np.append(starts, len(line)))
    above = np.cumsum(count) - count
    text = np.searchsorted(above, line[starts], side="right") - 1
    key = np.add.reduceat(mixed(mixed(word)), starts) if len(starts) else np.empty(0, np.uint64)
    return Lines(text + first, line[starts] - above[text], mixed(key + size.astype(np.uint64)).view(np.int64), size, starts, word)


def lines_of(texts: pa.Array, most: int = TEXT_BYTES) -> Iterator[Lines]:
    """The lines of a column of texts (null: none), about ``most`` bytes of text at a time."""
    group: list[bytes | None] = []
    first = held = 0
    for text in texts:
        value = text.as_buffer()
        group.append(None if value is None else value.to_pybytes())
        held += len(group[-1] or b"")
        if held >= most:
            yield sets_of_lines(group, first)
            first, group, held = first + len(group), [], 0
    if group:
        yield sets_of_lines(group, first)
