import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from wattloom.llm import packing
from wattloom.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def reference_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = ["", None, "a", "Éèaux de la   mer\r\n\t  x", "<|endoftext|> 1234's", "\U0001f600" * 30, "z" * 5000, "x y " * 4000]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_json_vocabulary(reference_ids, text):
    assert packing.ids_of(text, VOCABULARY).tolist() == reference_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_tournament_tree_is_first_fit(sizes):
    sizes.sort(reverse=True)
    bins, offsets = packing.first_fit(sizes, 50)
    used = []
    for size, found, offset in zip(sizes, bins, offsets):
        want = next((i for i, u in enumerate(used) if u + size <= 50), len(used))
        if want == len(used):
            used.append(0)
        assert (found, offset) == (want, used[want])
        used[want] += size


def test_every_id_lies_in_one_piece_and_sequences_are_gapless(spark, reference_ids):
    texts = [*TEXTS, "x y " * 4000, None]
    rows = [(None if i == 2 else min(i, 7), text, "extra") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    found = packing.pack(docs, VOCABULARY, group_pieces=4).collect()
    ids = {(i if i is None else int(i), text): reference_ids(text) for i, text, _ in rows}
    want = sorted((d is None, d or 0, s, len(x[s:s + 2048]), zlib.crc32(np.array(x[s:s + 2048], "<u4").tobytes()))
                  for d, t, _ in rows for x in [ids[d, t]] for s in range(0, len(x), 2048))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048
        assert {r.padded_length for r in pieces} == {end if end & (end - 1) == 0 else 2048}


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0


def test_group_numbers_do_not_collide():
    rows = pa.table({"doc_id": [1, 2], "start": [0, 0], "length": [2048, 5], "ids_crc32": [1, 2], "doc_tokens": [2048, 5],
                     "salt": [3, 4], "part": [7, 7]})
    assert sorted(packing.packed_group(rows, 2048)["sequence_id"].to_pylist()) == [7 << 32, (7 << 32) + 1]
