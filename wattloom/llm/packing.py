"""Packing documents into token sequences: first-fit decreasing over a tournament tree.

A document's ids (the tokenizer's, then one end id) are cut every ``length`` ids. A full piece is a sequence
of its own. The last, shorter pieces are dealt at random into groups of about GROUP_PIECES, and each group
is packed on its own by first-fit decreasing: pieces by falling length, each into the first sequence
with room. A tournament tree holds the room left in each sequence, so that one search takes log n steps. Texts are read
and tokenized once; the thin table of pieces is written before it is dealt, and no text is shuffled.

Defined cases: null and empty texts are the end id alone; rows that repeat (the same doc_id, or all columns) are
packed one by one; equal lengths go by doc_id, start and salt; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import groups_for
from wattloom.session import store

LENGTH = 2048
END = 1
GROUP_PIECES = 2048
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
PLACED = PIECE.replace("salt long", "sequence_id long, offset long, padded_length long")

#: Fixed value: the added token of this vocabulary, which a text gives its own id.
ADDED = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoder(path: str):
    """The rank file that holds the vocabulary of the JSON file; its ids are the same, in a third of the time."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


def ids_of(text: str | None, path: str) -> np.ndarray:
    ids = encoder(path).encode(text or "", allowed_special="all")
    ids.append(END)
    return np.array(ids, dtype="<u4")


def cut(docs: DataFrame, vocabulary: str, length: int) -> DataFrame:
    """Pieces of every document, with a salt that deals rows of one doc_id apart."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py(), vocabulary)
                seen += 1
                for start in range(0, len(ids), length):
                    part = ids[start:start + length]
                    salt = zlib.crc32(f"{doc_id}:{start}:{seen}".encode())
                    rows.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids), salt))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECE)


def first_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each size, in the given order, each in the first bin with room.

    ``room`` is a tournament tree: leaf i is what bin i has left, an inner node the larger of its children.
    """
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= size
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left > right else right
    return bins, offsets


def packed_group(pieces: pa.Table, length: int) -> pa.Table:
    pieces = pieces.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("salt", "ascending")])
    sizes = pieces["length"].to_numpy()
    bins, offsets = first_fit(sizes.tolist(), length)
    used = np.bincount(bins, weights=sizes).astype(np.int64)[bins]
    padded = np.where(used & (used - 1) == 0, used, length)
    sequence = pieces["part"].to_numpy() * (1 << 32) + np.array(bins)
    columns = [pieces[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    return pa.table([*columns, *(pa.array(c, pa.int64()) for c in (sequence, offsets, padded))],
                    [c.split()[0] for c in PLACED.split(", ")])


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row for each piece: where it lies in its document and in its sequence.

    ``padded_length`` is what the sequence takes: ``length``, or its own ids where they are a power of two.
    """
    pieces = store(cut(docs, vocabulary, length), "pack")
    groups = groups_for(pieces.count(), group_pieces)
    return pieces.withColumn("part", F.col("salt") % groups).groupBy("part").applyInArrow(
        lambda rows: packed_group(rows, length), PLACED)
