"""Passages repeated word for word, by a sparse suffix array.

Only the suffixes at minimiser positions are kept: where a hash of ``GRAM`` words is the least of
``LENGTH - CORE + 1`` in a row. Any passage of ``LENGTH`` words holds such a position with ``CORE``
of the passage's words to its right, wherever the passage stands, so two copies of it hold two
suffixes that agree in ``CORE`` words. The suffixes are sorted by those words' hash and compared with
their neighbours; where neighbours agree, the match is extended left and right to every window of
``LENGTH`` words around the position, and equal windows are found by sorting once more.

A window is *repeated* if its words stand elsewhere too; its first occurrence is the one with the
smallest (id, position). The result is exact but for collisions of 96-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import batches, free_name, map_arrow, materialise, ship

#: Words of a passage; words of the hash that selects positions; words compared to the right of one.
LENGTH, GRAM, CORE = 50, 8, 25
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Words whose windows are looked at together; a longer text is walked in overlapping blocks.
BLOCK = 1 << 18


class Words:
    """Hashes of the words of a text, and of any run of them."""

    def __init__(self, text: str):
        words = text.encode().split()
        self.n = n = len(words)
        first = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        self.inverse = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]))
        zero = np.zeros(1, np.uint64)
        self.sums = np.concatenate([zero, np.cumsum(first * power[:n])])
        second = (first ^ (first >> np.uint64(29))) * _MIX
        self.second = np.concatenate([zero, np.cumsum(second * power[:n])])

    def runs(self, length: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``length`` words from each position (all positions, or those of ``at``)."""
        return self._runs(self.sums, length, at)

    def check(self, length: int, at: np.ndarray) -> np.ndarray:
        """32 more bits for the same runs."""
        return (self._runs(self.second, length, at) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def _runs(self, sums: np.ndarray, length: int, at: np.ndarray | None) -> np.ndarray:
        if at is None:
            at = np.arange(max(0, self.n - length + 1))
        h = (sums[at + length] - sums[at]) * self.inverse[at]
        h ^= h >> np.uint64(31)
        return h * _MIX

    def anchors(self) -> np.ndarray:
        """For every window of LENGTH words, the leftmost position of its least gram hash."""
        grams, width = self.runs(GRAM), LENGTH - CORE + 1
        n = self.n - LENGTH + 1
        out = np.empty(n, np.int64)
        for at in range(0, n, BLOCK):
            part = grams[at : min(n, at + BLOCK) + width - 1]
            out[at : at + BLOCK] = sliding_window_view(part, width).argmin(axis=1) + np.arange(at, min(n, at + BLOCK))
        return out


def _suffixes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, pos, own) of each kept suffix; of several with one key in a text the first, ``own`` true."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("pos", pa.int32()), ("own", pa.bool_())])
    for part in parts:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, bool)]]
        for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            words = Words(text)
            if words.n < LENGTH:
                continue
            at = np.unique(words.anchors())
            keys, first, count = np.unique(words.runs(CORE, at).view(np.int64), return_index=True, return_counts=True)
            for into, values in zip(out, (keys, np.full(len(keys), doc), at[first].astype(np.int32), count > 1), strict=True):
                into.append(values)
        yield from batches(dict(zip(schema.names, map(np.concatenate, out), strict=True)), schema)


def _agreeing(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of suffixes sorted by key, those that agree with a neighbour (or with one in their own text)."""
    held: pa.RecordBatch | None = None  # the last row so far, still to be compared with the next
    before: int | None = None

    def emit(rows: pa.RecordBatch, following: int | None) -> pa.RecordBatch:
        keys = rows.column(0).to_numpy()
        left = np.concatenate([[before is not None and keys[0] == before], keys[1:] == keys[:-1]])
        right = np.concatenate([keys[1:] == keys[:-1], [following is not None and keys[-1] == following]])
        return rows.filter(pa.array(left | right | rows.column(3).to_numpy(zero_copy_only=False))).select(["id", "pos"])

    for part in parts:
        if not part.num_rows:
            continue
        if held is not None:
            yield emit(held, part.column(0)[0].as_py())
            before = held.column(0)[0].as_py()
        if part.num_rows > 1:
            yield emit(part.slice(0, part.num_rows - 1), part.column(0)[part.num_rows - 1].as_py())
            before = part.column(0)[part.num_rows - 2].as_py()
        held = part.slice(part.num_rows - 1)
    if held is not None:
        yield emit(held, None)


def _windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window around an agreeing suffix. ``kind`` 1: its words stand earlier in its own text, which
    decides it; such rows get hashes of their own, so that a text of one word doesn't fill a task.
    ``kind`` 2: the first of several in its own text."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int32()), ("id", pa.int64()), ("pos", pa.int32()), ("kind", pa.int8())])
    for part in parts:
        for doc, text, starts in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            words = Words(text)
            if words.n < LENGTH:  # shares its id with a longer text
                continue
            each, of = np.unique(words.anchors(), return_inverse=True)
            starts = np.array(starts)
            known = words.runs(CORE, starts[starts <= words.n - CORE])
            at = np.flatnonzero(np.isin(words.runs(CORE, each), known)[of])
            h, c = words.runs(LENGTH, at), words.check(LENGTH, at)
            first, count = np.unique(h, return_index=True, return_counts=True)[1:]
            kind = np.ones(len(at), np.int8)
            kind[first] = np.where(count > 1, 2, 0)
            own = kind == 1
            h[own] = (h[own] ^ (at[own].astype(np.uint64) + np.uint64((doc * int(_BASE)) & ((1 << 64) - 1)))) * _MIX
            yield from batches({"h": h.view(np.int64), "c": c, "id": np.full(len(at), doc), "pos": at.astype(np.int32), "kind": kind}, schema, 10_000)


def _distinct(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted windows without those of a repeated row: the same id and position again."""
    before: list | None = None
    for part in parts:
        if part.num_rows:
            columns = [part.column(i).to_numpy() for i in range(4)]
            again = np.concatenate([[before == [x[0] for x in columns]], np.all([x[1:] == x[:-1] for x in columns], axis=0)])
            before = [x[-1] for x in columns]
            yield part.filter(pa.array(~again))


def _repeats(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by (h, c, id, pos), the repeated ones; ``later`` unless first of their words."""
    held: pa.RecordBatch | None = None
    before: tuple | None = None

    def emit(rows: pa.RecordBatch, following: tuple | None) -> pa.RecordBatch:
        h, c, kind = (rows.column(i).to_numpy() for i in (0, 1, 4))
        same = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
        left = np.concatenate([[before == (h[0], c[0])], same])
        right = np.concatenate([same, [following == (h[-1], c[-1])]])
        out = pa.RecordBatch.from_arrays([rows.column(2), rows.column(3), pa.array(left | (kind == 1))], names=["id", "pos", "later"])
        return out.filter(pa.array(left | right | (kind > 0)))

    last = lambda b, i: (b.column(0)[i].as_py(), b.column(1)[i].as_py())
    for part in _distinct(parts):
        if not part.num_rows:
            continue
        if held is not None:
            yield emit(held, last(part, 0))
            before = last(held, 0)
        if part.num_rows > 1:
            yield emit(part.slice(0, part.num_rows - 1), last(part, part.num_rows - 1))
            before = last(part, part.num_rows - 2)
        held = part.slice(part.num_rows - 1)
    if held is not None:
        yield emit(held, None)


def spans(starts: np.ndarray) -> list[int]:
    """Union of the windows from sorted ``starts`` as flat [from, to, from, to, ...] word positions."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH)
    begin, end = np.concatenate([starts[:1], starts[cut + 1]]), np.concatenate([starts[cut], starts[-1:]]) + LENGTH
    return np.stack([begin, end], axis=1).ravel().tolist()


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        made = [[spans(np.sort(np.array(x or [], np.int64))) for x in part.column(i).to_pylist()] for i in (1, 2)]
        yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.list_(pa.int32())) for x in made)], names=["id", "later", "first"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, later, first)`` for each id that holds a repeated passage: flat lists of word positions
    [from, to, ...] that repeated windows cover, those that also occur earlier (``later``) and those
    of which this is the first occurrence (``first``).

    Words are runs of other characters than white space, compared as they are written. Texts under
    ``LENGTH`` words, null or empty ones, and rows with a null id take no part. Rows that share an id
    count as one occurrence where their words and positions agree. Several occurrences within one
    text count too. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    suffixes = map_arrow(rows, _suffixes, "key long, id long, pos int, own boolean")
    agreeing = suffixes.repartition("key").sortWithinPartitions("key", "id", "pos").mapInArrow(_agreeing, "id long, pos int")
    # at most one row for each distinct key of a text, so a list is shorter than its text
    positions = materialise(agreeing.groupBy("id").agg(F.collect_set("pos").alias("starts")), "suffix-positions")
    windows = map_arrow(rows.join(positions.hint("merge"), "id").select("id", "text", "starts"), _windows, "h long, c int, id long, pos int, kind byte")
    found = windows.repartition("h", "c").sortWithinPartitions("h", "c", "id", "pos").mapInArrow(_repeats, "id long, pos int, later boolean")
    lists = found.groupBy("id").agg(*(F.collect_set(F.when(F.col("later") == x, F.col("pos"))).alias(n) for n, x in (("later", True), ("first", False))))
    return map_arrow(lists, _merged, "id long, later array<int>, first array<int>")


def cut(text: str | None, cuts) -> str | None:
    """The text without the words of the flat list of positions, each with the white space after it."""
    if text is None or cuts is None or not len(cuts):
        return text
    data = text.encode()
    at = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    out, from_ = [], 0
    for a, b in zip(cuts[::2], cuts[1::2], strict=True):
        if b < len(at):  # a text that shares its id with a longer one may be shorter
            out.append(data[from_ : at[a]])
            from_ = at[b]
    return b"".join([*out, data[from_:]]).decode()


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut out except at its first occurrence. All rows and
    columns stay; rows whose id is null keep their text. A text all of whose words are cut is empty."""
    own, cuts_of = free_name(docs, "__id"), free_name(docs, "__cuts")
    found = repeats(docs, id_col, text_col).where(F.size("later") > 0).select(F.col("id").alias(own), F.col("later").alias(cuts_of))
    found = materialise(found, "suffix-cuts")

    @F.pandas_udf("string")
    def cut_all(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([cut(t, c) for t, c in zip(texts, cuts, strict=True)], dtype=object)

    joined = docs.join(found.hint("merge"), F.col(id_col).cast("long") == F.col(own), "left")
    return joined.withColumn(text_col, F.when(F.col(cuts_of).isNull(), F.col(text_col)).otherwise(cut_all(F.col(text_col), F.col(cuts_of)))).select(docs.columns)
