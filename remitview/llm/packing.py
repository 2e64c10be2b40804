"""Sum-of-squares packing of documents into token windows.

Each task packs the documents of its own partition online, so nothing is shuffled and a lost task is
packed again from its input split to the same rows. ``levels[h]`` counts the open windows filled to
``h``; a piece goes to the level (or a new window) that makes the sum of squared counts smallest.
When too many windows are open, and at the end, the fullest are filled up from the emptiest; the last
bit of a partition is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import map_arrow

WINDOW = 1024
#: Open windows a task holds at most before it fills them up (4 bytes a token: 16 MB).
MAX_OPEN = 4096
END_ID = 0
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])


@functools.cache
def _encoders(vocabulary: str):
    """The tokenizer, and the same vocabulary and pattern in a library several times as fast."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")), fast


def token_ids(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of ``Tokenizer.from_file(<vocabulary>.json).encode(text, add_special_tokens=False)``.

    Texts of Latin letters only go through the faster library, whose ids are the same there (a test
    compares every such character); texts with others, where the two libraries' Unicode tables might
    differ, or with the special token's string, go through the tokenizer itself; so does a text that
    the faster library gives up on (its pattern's stack ends at runs of about a million white spaces).
    """
    exact, fast = _encoders(vocabulary)
    if (text.isascii() or max(text) < "ɐ") and SPECIAL not in text:
        try:
            return np.asarray(fast.encode_to_numpy(text), "<u4")
        except ValueError:
            pass
    return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")


class Packer:
    """Online packing of one partition. Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN, first_id: int = 0):
        self.window, self.max_open, self.next_id = window, max_open, first_id
        self.levels = np.zeros(window + 1, np.int64)  # the last one, full windows, stays zero
        self.open: dict[int, list[list]] = defaultdict(list)  # windows by fill
        self.out: list[tuple] = []
        self.moved = 0

    def _emit(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, at))
            at += len(ids)
        self.next_id += 1

    def _place(self, piece: tuple) -> None:
        size, n = len(piece[2]), self.levels
        h = np.flatnonzero(n[: self.window - size + 1])  # open levels with room
        to = h + size
        cost = np.where(to < self.window, 2 * n[to] + 1, 0) - 2 * n[h] + 1
        if len(h) and cost.min() <= 2 * n[size] + 1:
            fill = int(h[len(h) - 1 - cost[::-1].argmin()])  # of equal costs, the fullest window
            pieces = self.open[fill].pop()
            n[fill] -= 1
        else:
            fill, pieces = 0, []
        pieces.append(piece)
        fill += size
        if fill == self.window:
            self._emit(pieces)
        else:
            self.open[fill].append(pieces)
            n[fill] += 1
            if int(n.sum()) > self.max_open:
                self.flush(last=False)

    def add(self, doc, ids: np.ndarray) -> None:
        """Cut off whole windows; the rest is placed by the sum of squares."""
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self._emit([(doc, at, ids[at : at + self.window], len(ids))])
        if whole < len(ids):
            self._place((doc, whole, ids[whole:], len(ids)))

    def flush(self, last: bool = True) -> None:
        """Fill the open windows up, the fullest first, with the pieces of the emptiest.

        A window keeps its pieces and its place in front; only the emptiest are taken apart, as many
        as there is room to fill (``moved`` counts their tokens). What is left over is one window: it
        stays open, or at the end is cut at powers of two.
        """
        windows = deque(w for fill in sorted(self.open) for w in self.open[fill])
        self.open.clear()
        self.levels[:] = 0
        spare: deque[tuple] = deque()
        while windows or spare:
            row = list(windows.pop()) if windows else []
            room = self.window - sum(len(p[2]) for p in row)
            while room and (spare or windows):
                if not spare:
                    spare.extend(windows.popleft())
                doc, start, ids, total = spare.popleft()
                take = ids[:room]
                row.append((doc, start, take, total))
                room -= len(take)
                self.moved += len(take)
                if len(take) < len(ids):
                    spare.appendleft((doc, start + len(take), ids[len(take) :], total))
            if not room:
                self._emit(row)
            elif last:
                self._close(row)
            else:
                self.open[self.window - room].append(row)
                self.levels[self.window - room] = 1

    def _close(self, pieces: list[tuple]) -> None:
        """Emit pieces in sequences of falling powers of two, which need no padding."""
        left = sum(len(p[2]) for p in pieces)
        row, room = [], 0
        for doc, start, ids, total in pieces:
            while len(ids):
                room = room or 1 << (left.bit_length() - 1)
                take = ids[:room]
                row.append((doc, start, take, total))
                ids, start, room, left = ids[len(take) :], start + len(take), room - len(take), left - len(take)
                if not room:
                    self._emit(row)
                    row = []

    def rows(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, as ``SCHEMA`` says.

    A document's tokens are its text's ids and then id 0; a null or empty text is id 0 alone. Every
    row is packed, repeated rows and null ids too. An empty table gives no pieces. ``sequence_id``
    carries the partition in its upper bits, so it is unique without a shuffle.
    """

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, first_id=TaskContext.get().partitionId() << 33)
        end = np.array([END_ID], "<u4")

        def rows() -> list[pa.RecordBatch]:
            found = packer.rows()
            return [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=_ARROW)] if found else []

        for part in parts:
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                packer.add(doc, np.concatenate([token_ids(text, vocabulary), end]) if text else end)
            yield from rows()
        packer.flush()
        yield from rows()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, task, SCHEMA)
