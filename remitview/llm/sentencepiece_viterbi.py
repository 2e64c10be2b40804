"""SentencePiece encoding by a streaming Viterbi search, and decoding.

A text is walked character by character. The search holds the best score and the backpointer of the
last boundaries only, as many as the longest piece has characters: no piece reaches further back.
Where the backpointer paths of all of them run through one boundary, everything before it is decided
and its ids are committed, so memory doesn't grow with the text. The segmentation is the one with
the highest sum of piece scores (equal sums: the longer last piece).

If no piece of the vocabulary goes on from the end of a word into what follows, all paths run through
that end, and the window commits there. A word that a worker has seen between two such commits has
the ids it had before; every other one goes through the window, whatever its length.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import map_arrow

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: A character without a piece costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Stretches that are remembered with their ids in a worker (twice as many at most: some 150 MB), and
#: the longest that is kept.
REMEMBERED, REMEMBERED_LENGTH = 250_000, 48

#: Spaces with the letters, or with the other characters, after them.
_STRETCH = regex.compile(rf"{SPACE}*\p{{L}}+|{SPACE}*[^{SPACE}\p{{L}}]+|{SPACE}+")


class Pieces:
    """Pieces and scores of a model file. Only models with the identity normaliser are read."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError(f"{path}: only models that leave the text as it is are read")
        self.prefix = rules.add_dummy_prefix
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.score = {model.id_to_piece(i): (model.get_score(i), i) for i in ids if i not in special}
        self.heads = {p[:n] for p in self.score for n in range(1, len(p) + 1)}
        self.longest = max(map(len, self.score))
        self.unknown_score = min(s for s, _ in self.score.values()) - UNKNOWN_PENALTY
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        self.bytes_of = [b"" if i in special else model.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])
        #: If no piece spans two stretches, every path has a boundary wherever a stretch ends.
        self.splits = all(len(_STRETCH.findall(p)) == 1 for p in self.score)

    def unknown(self, char: str) -> list[int]:
        """Ids of a character without a piece: its bytes, or the unknown id."""
        return [self.byte_id[b] for b in char.encode()] if len(self.byte_id) == 256 else [self.unknown_id]


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class StreamingViterbi:
    """Feed text in any portions; ids come out as soon as they are decided."""

    def __init__(self, model: Pieces):
        self.model = model
        self.text = ""  # from the last committed boundary on
        self.best, self.back, self.ids = [0.0], [0], [None]  # by boundary, from there
        self.at = 0  # boundaries before it have been extended
        self.done = 0  # characters committed
        self.widest, self.commits = 1, 0

    def feed(self, text: str) -> list[int]:
        self.text += text
        return self._run(len(self.text) - self.model.longest + 1)

    def finish(self) -> list[int]:
        out = self._run(len(self.text))
        return out + self._path(len(self.text))

    def stretch(self, text: str) -> list[int]:
        """Feed a text that ends where all paths meet: what it decides, its end included."""
        out = self.feed(text) + self.finish()
        self.done += len(self.text)
        self.text, self.at = "", 0
        self.best, self.back, self.ids = [0.0], [0], [None]
        self.commits += 1
        return out

    def _run(self, end: int) -> list[int]:
        """Extend all boundaries before ``end``: those whose longest piece is all there."""
        score, heads, longest, unknown = self.model.score, self.model.heads, self.model.longest, self.model.unknown_score
        out: list[int] = []
        end += self.done
        while self.done + self.at < end:
            # up to where the next commit is tried
            text, n, best, back, ids = self.text, len(self.text), self.best, self.back, self.ids
            upto = min(end - self.done, max(4 * longest, (self.at // longest + 1) * longest))
            grow = min(n, upto - 1 + longest) + 1 - len(best)
            if grow > 0:
                best += [-np.inf] * grow
                back += [0] * grow
                ids += [None] * grow
            for i in range(self.at, upto):
                base = best[i]
                for j in range(i + 1, min(n, i + longest) + 1):
                    part = text[i:j]
                    found = score.get(part)
                    if found is None:
                        if part not in heads:
                            break
                    elif base + found[0] > best[j]:
                        best[j], back[j], ids[j] = base + found[0], i, found[1]
                if base + unknown > best[i + 1] and text[i] not in score:
                    best[i + 1], back[i + 1], ids[i + 1] = base + unknown, i, None
            self.at = upto
            self.widest = max(self.widest, len(best))
            if upto >= 4 * longest and upto % longest == 0:
                out += self._commit()
        return out

    def _commit(self) -> list[int]:
        """Follow the paths of all live boundaries back; if they meet, commit what lies before."""
        live = {i for i in range(max(0, self.at - self.model.longest), min(len(self.best), self.at + self.model.longest)) if self.best[i] > -np.inf}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last])
        meet = live.pop()
        out = self._path(meet)
        if meet:
            self.commits += 1
            self.text = self.text[meet:]
            base = self.best[meet]
            self.best, self.ids = [x - base for x in self.best[meet:]], self.ids[meet:]
            self.back = [max(0, b - meet) for b in self.back[meet:]]
            self.at -= meet
            self.done += meet
        return out

    def _path(self, to: int) -> list[int]:
        """Ids of the best path to a boundary."""
        out = []
        while to:
            from_ = self.back[to]
            out.append((self.ids[to],) if self.ids[to] is not None else self.model.unknown(self.text[from_:to]))
            to = from_
        return [i for ids in reversed(out) for i in ids]


class Memory(dict):
    """Ids by stretch, from the window that all stretches go through. When it is full, what was in use
    lately is kept and the rest forgotten."""

    def __init__(self, model: Pieces):
        super().__init__()
        self.model, self.older, self.window = model, {}, StreamingViterbi(model)

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        ids = self.older.get(stretch)
        if ids is None:
            ids = tuple(self.window.stretch(stretch))
        if len(stretch) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[stretch] = ids
        return ids


def encode(text: str | None, memory: Memory) -> list[int]:
    """Ids of a text; none for a null or empty one."""
    if not text:
        return []
    model = memory.model
    escaped = (SPACE if model.prefix else "") + text.replace(" ", SPACE)
    if not model.splits:
        return memory.window.stretch(escaped)
    return list(chain.from_iterable(map(memory.__getitem__, _STRETCH.findall(escaped))))


def decode(ids, model: Pieces) -> str:
    """Text of ids; bytes that form no character become replacement characters."""
    table = model.bytes_of
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if model.prefix and text.startswith(" ") else text


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)`` for every row: the ids of the whole text, none for a null or empty text.
    Repeated rows and null ids come back as they came; an empty table gives an empty result."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(public_tokenizers.path(vocabulary))
        memory = Memory(model)
        for part in parts:
            ids = [np.array(encode(x, memory), np.int32) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, task, "id long, ids array<int>")


def decoded(ids: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(id, text)`` from ``(id, ids)``; null ids count as none."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(public_tokenizers.path(vocabulary))
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([decode(x or [], model) for x in part.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return map_arrow(ids.select(F.col("id").cast("long"), F.col("ids").cast("array<int>")), task, "id long, text string")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_ids, ids_crc32, same)``: ``same`` if the decoded ids are the text again (null: empty)."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(public_tokenizers.path(vocabulary))
        memory = Memory(model)
        for part in parts:
            rows = []
            for text in part.column(1).to_pylist():
                ids = encode(text, memory)
                rows.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), decode(ids, model) == (text or "")))
            n, crc, same = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["id", "n_ids", "ids_crc32", "same"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, task, "id long, n_ids long, ids_crc32 long, same boolean")
