"""SentencePiece byte-pair encoding and decoding by a prefix table.

Greedy merging gives each prefix of a text one last token, and two tokens may stand side by side exactly if merging their joined
text gives the two back. So one pass suffices: an automaton names the tokens that end at each place, longest first; the first one
that fits the last token of the prefix before it is the last token here. The ids are then read off backwards.

* Tokens fit if no merge crosses their border. At any time the symbols at the border are a part on the right edge of the left token's
  merge tree and one on the left edge of the right token's; their union, if it is a piece, would have been merged at its rank, so it
  must come after one of the two has been merged inwards. Equal ranks merge from the left.
* Characters that no piece holds are tokens of their own bytes and border on everything. Where no piece has a space mark after another
  character, the table starts anew at each run of marks, and the ids of short stretches are kept and looked up. This changes no id.
* Decoding joins pieces, reads byte pieces as UTF-8 (each broken byte becomes U+FFFD), turns marks into spaces and drops the leading one.

The vocabulary is read once on the driver, through the library, and broadcast: its size is that of the file. Texts are never shuffled.

Defined cases: a null or empty text has no tokens and decodes to the empty text; null doc_ids and repeated rows stay, row by row; an
empty table gives no rows; other columns are not read. Time and memory are in proportion to a text's length. Only models that leave a
text as it is (no normalisation, a leading space mark, byte pieces) are taken; others raise ValueError.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
KEPT_LENGTH, KEPT = 48, 400_000
LATEST = 1 << 40
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@dataclass
class Vocabulary:
    """pieces: text -> id of the mergeable ones; rank: id -> its turn; singles: the ids of the 256 bytes; shown: id -> what it decodes to."""

    pieces: dict[str, int]
    rank: dict[int, int]
    singles: list[int]
    shown: dict[int, str]

    def __post_init__(self) -> None:
        self.text = {number: piece for piece, number in self.pieces.items()}
        self.byte = {number: b for b, number in enumerate(self.singles)}


#: Texts whose pieces show whether a model rewrites its input.
PROBES = ("a  b ", "ﬁ Ａ é", "A\tb\n")


def read_vocabulary(path: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    byte = {model.id_to_piece(i): i for i in range(size) if model.is_byte(i)}
    if len(byte) != 256:
        raise ValueError(f"{path} has no piece for every byte")
    if any(model.decode(model.encode(t)) != t or model.encode_as_pieces(t)[0][:1] != MARK for t in PROBES):
        raise ValueError(f"{path} rewrites texts before it encodes them")
    order = sorted(plain, key=lambda i: (-model.get_score(i), i))
    return Vocabulary({model.id_to_piece(i): i for i in plain}, {i: n for n, i in enumerate(order)},
                      [byte[f"<0x{b:02X}>"] for b in range(256)],
                      {i: "" if model.is_control(i) else " \u2047 " if model.is_unknown(i) else model.id_to_piece(i).replace(MARK, " ") for i in range(size)})


class Encoder:
    """Encodes with one vocabulary; keeps what it has learnt about pieces, pairs and short stretches."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.words = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, number in vocabulary.pieces.items():
            self.automaton.add_word(piece, (number, len(piece)))
        self.automaton.make_automaton()
        self.characters = {c for piece in vocabulary.pieces for c in piece}
        self.restarts = not any(b == MARK != a for piece in vocabulary.pieces for a, b in zip(piece, piece[1:]))
        self.stretch = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if self.restarts else re.compile("(?s).+")
        self.edges: dict[int, tuple | None] = {}
        self.fitting: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, tuple[int, str, str]] = {}

    def rank_of(self, text: str) -> int | None:
        number = self.words.pieces.get(text)
        return None if number is None else self.words.rank[number]

    def edge(self, number: int) -> tuple[list, list] | None:
        """The parts on the left and on the right edge of a piece's merge tree, as (text, made at, merged inwards at); None if merging its text doesn't give it."""
        if number in self.edges:
            return self.edges[number]
        piece = self.words.text[number]
        parts: list[tuple[str, list, list]] = [(c, [(c, -1)], [(c, -1)]) for c in piece]
        clock = -1
        while len(parts) > 1:
            ranks = [self.rank_of(a[0] + b[0]) for a, b in zip(parts, parts[1:])]
            open_ = [(r, i) for i, r in enumerate(ranks) if r is not None]
            if not open_:
                break
            rank, i = min(open_)
            clock = max(clock, rank)
            text = parts[i][0] + parts[i + 1][0]
            parts[i:i + 2] = [(text, parts[i][1] + [(text, rank)], parts[i + 1][2] + [(text, rank)])]
        found = None
        if len(parts) == 1:
            found = tuple(self.spans(edge) for edge in parts[0][1:])
        self.edges[number] = found
        return found

    @staticmethod
    def spans(edge: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
        made, out = -1, []
        for (text, rank), after in zip(edge, [*edge[1:], ("", LATEST)]):
            made = max(made, rank)
            out.append((text, made, max(made, after[1])))
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' joined text gives the two back."""
        said = self.edge(right) is not None and not self.crossed(left, right)
        if len(self.fitting) >= 4 * KEPT:
            self.fitting.clear()
        self.fitting[left, right] = said
        return said

    def crossed(self, left: int, right: int) -> bool:
        pieces, ranks = self.words.pieces, self.words.rank
        for a, a_made, a_gone in self.edge(left)[1]:
            for b, b_made, b_gone in self.edge(right)[0]:
                if a_made < b_gone and b_made < a_gone and a + b in pieces:
                    made = max(ranks[pieces[a + b]], a_made, b_made)
                    if made < a_gone and made <= b_gone:
                        return True
        return False

    def known_stretch(self, text: str) -> list[int]:
        """Ids of a text made of the vocabulary's characters: the prefix table forwards, the ids backwards."""
        last, length = [0] * (len(text) + 1), [0] * (len(text) + 1)
        known, fits, edge = self.fitting, self.fits, self.edge
        for place, (number, size) in self.automaton.iter(text):  # of those that end here, the longest first
            end, begin = place + 1, place + 1 - size
            if length[end]:
                continue
            if not begin:
                fit = edge(number) is not None
            elif not length[begin]:
                continue
            else:
                fit = known.get((last[begin], number))
                if fit is None:
                    fit = fits(last[begin], number)
            if fit:
                last[end], length[end] = number, size
        ids, end = [], len(text)
        while end:
            ids.append(last[end])
            end -= length[end]
        return ids[::-1]

    def stretch_ids(self, text: str) -> list[int]:
        ids: list[int] = []
        begin = 0
        for i, c in enumerate(text):
            if c not in self.characters:
                ids += self.known_stretch(text[begin:i]) if begin < i else []
                ids += [self.words.singles[b] for b in c.encode()]
                begin = i + 1
        return ids + (self.known_stretch(text[begin:]) if begin < len(text) else [])

    def stretches(self, text: str) -> list[tuple[int, str, str]]:
        """For each stretch of a text: how many ids, the ids joined by commas, and what they decode to."""
        if not text:
            return []
        parts = self.stretch.findall(MARK + text.replace(" ", MARK))
        found = list(map(self.kept.get, parts))
        if None in found:
            found = [self.looked_up(part) if had is None else had for part, had in zip(parts, found)]
        return found

    def looked_up(self, stretch: str) -> tuple[int, str, str]:
        kept = self.kept
        found = kept.get(stretch)
        if found is None:
            ids = self.stretch_ids(stretch)
            found = len(ids), ",".join(map(str, ids)), joined(ids, self.words)
            if len(stretch) <= KEPT_LENGTH:
                if len(kept) >= KEPT:
                    kept.clear()
                kept[stretch] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.stretches(text or "") for i in ids.split(",")]


def each_byte(error: UnicodeError) -> tuple[str, int]:
    return "\ufffd" * (error.end - error.start), error.end


codecs.register_error("each_byte", each_byte)


def joined(ids: list[int], words: Vocabulary) -> str:
    """The text of some ids, the leading space kept."""
    out, held = [], bytearray()
    for number in ids:
        if number in words.byte:
            held.append(words.byte[number])
            continue
        if held:
            out.append(held.decode("utf-8", "each_byte"))
            held = bytearray()
        out.append(words.shown[number])
    if held:
        out.append(held.decode("utf-8", "each_byte"))
    return "".join(out)


def decode(ids: list[int], words: Vocabulary) -> str:
    text = joined(ids, words)
    first = next((i for i in ids if words.shown[i]), None)  # control ids show nothing
    return text[1:] if first in words.rank and text[:1] == " " else text


ENCODERS: dict[str, Encoder] = {}


def encoder_of(name: str, vocabulary: Vocabulary) -> Encoder:
    """A Python worker's encoder; it outlives the task."""
    if name not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[name] = Encoder(vocabulary)
    return ENCODERS[name]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of each row."""
    words = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, words.value)
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([encoder.encode(batch.column(1)[i].as_py())], pa.list_(pa.int32()))],
                                                 ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    words = rows.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decode(ids or [], words.value) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(texts, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the text that they decode to."""
    words = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def digest(encoder: Encoder, text: str) -> tuple[int, str, str]:
        found = encoder.stretches(text)
        shown = [x[2] for x in found]
        shown[:1] = [x.removeprefix(" ") for x in shown[:1]]
        ids, back = ",".join([x[1] for x in found]), "".join(shown)
        return sum([x[0] for x in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, words.value)
        for batch in batches:
            found = [digest(encoder, text.as_py() or "") for text in batch.column(1)]
            counts, ids, back = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, DIGESTS)
