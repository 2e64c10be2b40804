"""Vector best-fit packing of whole documents into token sequences.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece
lengths). Pieces come longest first, and each goes to the open sequence that it leaves the least
room in (weighted norm of the residual vector, or by the weighted dot product of residual and
demand) among those where it meets every capacity; where there is none, a new one opens. Only
documents longer than a sequence are cut.

Every task tokenises the texts of its own partition, once, and packs them ``ROUND`` pieces at a time;
open sequences stay open from one round to the next. What a task leaves in poorly filled sequences
is packed again with that of other tasks. That second pass moves lengths and checksums, no text.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import map_arrow, materialise

#: Capacities of a sequence: tokens, documents, attention cost.
CAPACITY = (4096, 512, 4096**2)
#: Weights of the residual capacities, each as a share of its whole.
WEIGHTS = (1.0, 0.05, 0.25)
END_ID = 1
VOCABULARY = "word_bpe_49k"
#: Pieces packed at once, and sequences kept open between rounds (the emptiest).
ROUND, OPEN = 20_000, 2_000
#: Sequences below this share of their tokens are packed again with those of other tasks.
LOOSE = 0.99
#: Words a task remembers the ids of (a full memory is emptied), and the longest of them.
REMEMBERED, LONG = 400_000, 64
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_ARROW = pa.schema([(n, pa.int32() if t == "int" else pa.int64()) for n, t in (x.split() for x in SCHEMA.split(", "))])

_LOWER = sorted({x for c in range(0x250) for x in chr(c).lower()})
_class = lambda kind: "".join(re.escape(c) for c in _LOWER if unicodedata.category(c)[0] == kind)
#: The vocabulary's word pattern over lower-cased Latin text. White space is in none of its classes.
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^ \\t\\n\\x0b\\x0c\\r\\x85\\xa0{_class('L')}{_class('N')}]+")
#: Texts with such a letter, or what might be a special token, go through the tokenizer whole.
NOT_LATIN = re.compile("[\u0250-\U0010ffff]|<\\|")


class Words(dict):
    """Ids of lower-cased words, as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.model, self.bytes = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def text_ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else self.bytes.pre_tokenize_str(word)[0][0]
        found = np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()
        if len(word) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


@functools.cache
def words(vocabulary: str) -> Words:
    return Words(vocabulary)


def token_bytes(text: str, vocabulary: str = VOCABULARY) -> bytes:
    """Ids of ``Tokenizer.from_file(<vocabulary>.json).encode(text, add_special_tokens=False)``, 4 bytes each.

    The vocabulary composes, lower-cases and splits a text into words, and the ids of a word depend
    on the word alone. Text of Latin letters, which are composed already, is split here and a word
    seen before is not looked up again; any other text goes through the tokenizer whole.
    """
    known = words(vocabulary)
    if NOT_LATIN.search(text):
        return known.text_ids(text)
    return b"".join(map(known.__getitem__, WORD.findall(text.lower())))


class Packer:
    """Sequences open in one task. A piece is (length, doc_id, piece, start, crc)."""

    def __init__(self, first_id: int, capacity=CAPACITY, weights=WEIGHTS, rule: str = "norm"):
        if rule not in ("norm", "dot"):
            raise ValueError(f"unknown rule {rule!r}")
        self.capacity, self.rule = np.array(capacity, float), rule
        self.weights = np.array(weights, float) / self.capacity**2
        self.room = np.zeros((3, 0))
        self.pieces: list[list[tuple]] = []
        self.next_id, self.out = first_id, []

    def pack(self, pieces: list[tuple]) -> None:
        """Place pieces, the longest first; emit all but the emptiest open sequences."""
        used = self.room.shape[1]
        room = np.concatenate([self.room, np.zeros((3, len(pieces)))], axis=1)
        for piece in sorted(pieces, key=lambda p: (-p[0], p[1] is None, p[1:])):
            demand = np.array([piece[0], 1.0, float(piece[0]) ** 2])
            if demand[2] > self.capacity[2]:
                raise ValueError(f"a piece of {piece[0]} tokens is over the attention capacity of a whole sequence")
            left = room[:, :used] - demand[:, None]
            fits = np.flatnonzero((left >= 0).all(axis=0))
            if len(fits):
                if self.rule == "norm":
                    score = self.weights @ left[:, fits] ** 2
                else:
                    score = (self.weights * demand) @ room[:, fits]
                to = int(fits[score.argmin()])
            else:
                to, used = used, used + 1
                room[:, to] = self.capacity
                self.pieces.append([])
            room[:, to] -= demand
            self.pieces[to].append(piece)
        room = room[:, :used]
        keep = np.argsort(-room[0], kind="stable")[:OPEN]
        keep = np.sort(keep[(room[:2, keep] > 0).all(axis=0)])
        kept = set(keep.tolist())
        for i, sequence in enumerate(self.pieces):
            if i not in kept:
                self._emit(sequence)
        self.room, self.pieces = room[:, keep], [self.pieces[i] for i in keep]

    def _emit(self, sequence: list[tuple], loose: bool = False) -> None:
        at = 0
        for length, doc, piece, start, crc in sequence:
            self.out.append((doc, piece, start, length, crc, None if loose else self.next_id, at))
            at += length
        self.next_id += 1

    def finish(self, loose: float = 0.0) -> None:
        """Emit what is open; sequences filled below the share ``loose`` get no number."""
        for room, sequence in zip(self.room[0], self.pieces, strict=True):
            self._emit(sequence, room > (1 - loose) * self.capacity[0])
        self.room, self.pieces = np.zeros((3, 0)), []

    def rows(self) -> Iterator[pa.RecordBatch]:
        out, self.out = self.out, []
        for at in range(0, len(out), 50_000):
            columns = zip(*out[at : at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def cut(doc, ids: bytes, window: int) -> list[tuple]:
    """A document's pieces: itself, or windows and a shorter last one."""
    return [
        (min(window, len(ids) // 4 - at), doc, n, at, zlib.crc32(ids[4 * at : 4 * (at + window)]))
        for n, at in enumerate(range(0, len(ids) // 4, window))
    ]


def pack(
    docs: DataFrame, capacity=CAPACITY, weights=WEIGHTS, rule: str = "norm", vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents, as ``SCHEMA`` says.

    A document's tokens are its text's ids and then id 1; a null or empty text is id 1 alone. Every
    row is packed, repeated rows and null ids too; pieces of equal length are placed by id. An empty
    table gives no pieces. ``sequence_id`` carries the pass and the partition in its upper bits.
    """
    window = capacity[0]

    def first_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, weights, rule)
        end, waiting = np.array([END_ID], "<u4").tobytes(), []
        for part in parts:
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                waiting += cut(doc, token_bytes(text, vocabulary) + end if text else end, window)
                if len(waiting) >= ROUND:
                    packer.pack(waiting)
                    waiting = []
                    yield from packer.rows()
        packer.pack(waiting)
        packer.finish(LOOSE)
        yield from packer.rows()

    def second_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, waiting = Packer((1 << 62) + (TaskContext.get().partitionId() << 33), capacity, weights, rule), []
        for part in parts:
            waiting += zip(*(part.column(c).to_pylist() for c in ("length", "doc_id", "piece", "start", "ids_crc32")), strict=True)
            while len(waiting) >= ROUND:
                packer.pack(waiting[:ROUND])
                waiting = waiting[ROUND:]
                yield from packer.rows()
        packer.pack(waiting)
        packer.finish()
        yield from packer.rows()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = materialise(map_arrow(rows, first_pass, SCHEMA), "packed")
    loose = packed.where("sequence_id is null")
    tasks = 1 + loose.count() // (10 * ROUND)
    by = ["length", "doc_id", "piece", "start", "ids_crc32"]
    again = loose.repartition(tasks, F.xxhash64(*by)) if tasks > 1 else loose.coalesce(1)
    again = map_arrow(again.sortWithinPartitions(F.xxhash64("ids_crc32", "doc_id"), *by), second_pass, SCHEMA)
    return packed.where("sequence_id is not null").unionByName(again)
