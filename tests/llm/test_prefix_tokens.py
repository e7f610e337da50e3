"""SentencePiece ids by the prefix table, held against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from wattloom.llm import prefix_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a  b ", "Hello  world\n\tx", "▁a ▁", "日本語🙂", "a\u0000b", "é ﬁ Ａ", "<s> </s> <unk> <0x41>", "　x", "ß", " ​", "é",
         "a" * 5000, "ab " * 3000, "\n" * 300, "🙂" * 50, " " * 400, "x" + " " * 33 + "y", "1234567890" * 20]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return prefix_tokens.Encoder(prefix_tokens.read_vocabulary(PATH))


def test_chosen_texts(library, encoder):
    for text in TEXTS:
        ids = library.encode(text)
        assert encoder.encode(text) == ids, text[:40]
        assert prefix_tokens.decode(ids, encoder.words) == library.decode(ids), text[:40]


def test_random_texts(library, encoder):
    pick = random.Random(7)
    parts = list("abcdeilnorstuxyz  ▁\n.éß日🙂0123<>/-=") + list(encoder.words.pieces)
    for _ in range(4000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert encoder.encode(text) == library.encode(text), text


def test_every_piece_beside_many_others(library, encoder):
    pick = random.Random(8)
    pieces = list(encoder.words.pieces)
    for piece in pieces[::5]:
        text = piece + pick.choice(pieces)
        assert encoder.encode(text) == library.encode(text), text


def test_random_ids(library, encoder):
    pick = random.Random(9)
    for _ in range(3000):
        ids = [pick.choice([0, 1, 2, 3, 35, 259, 28705]) if pick.random() < 0.3 else pick.randrange(3, 32000 if pick.random() < 0.6 else 259)
               for _ in range(pick.randint(0, 8))]
        assert prefix_tokens.decode(ids, encoder.words) == library.decode(ids), ids


def test_query_on_odd_rows(spark, library):
    texts = [*TEXTS, None, "same", "same", "long " * 40_000]
    rows = [(None if i == 3 else i // 2, t, "c") for i, t in enumerate(texts)]
    found = prefix_tokens.digests(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH).collect()

    def expected(doc_id, text):
        ids = library.encode(text or "")
        return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    assert sorted(map(tuple, found), key=str) == sorted((expected(i, t) for i, t, _ in rows), key=str)
    assert prefix_tokens.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None)]
    ids = prefix_tokens.encoded(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    back = {r.doc_id: r.text for r in prefix_tokens.decoded(ids, PATH).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in rows}


def test_other_models_are_refused(monkeypatch):
    class Rewriting(sentencepiece.SentencePieceProcessor):
        def decode(self, ids):
            return super().decode(ids).strip()

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Rewriting)
    with pytest.raises(ValueError):
        prefix_tokens.read_vocabulary(PATH)
