"""SimHash near-duplicates: fingerprints joined with themselves by binary tries.

Nodes of a trie over the distinct fingerprints are traversed in pairs: a pair holds the bits that
differ so far, and is dropped once they exceed the budget. Fingerprints within ``budget`` bits agree
wholly in one of ``budget + 1`` stretches of their bits. So there is a trie for each stretch, over the
fingerprints turned to begin with it, and its top ``depth`` levels, which lie inside the stretch, need
no mixed pairs: Spark deals them out by equal prefixes, one copy of a fingerprint a trie. Each group
walks the rest of its subtree level by level over sorted arrays. ``depth`` follows the count of
fingerprints, and a subtree that holds more than ``SUBTREE`` of them is cut into parts whose pairs are
groups of their own, so a group is bounded whatever the skew.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import connected_components, group_labels, map_arrow, materialise, ship

SEED = 42
#: Fingerprints of a subtree, or part of one, that a group takes from either side.
SUBTREE = 8192
#: Words hashed at a time, and node pairs walked at a time.
BLOCK = 1 << 16
FRONTIER = 1 << 18


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit majority fingerprint of the word shingles of a text (None counts as empty)."""
    words = (text or "").encode().lower().split()  # bytes: lowers A-Z only, splits at ASCII white space
    if not words:
        return 0
    hash64, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + shingle - 1] if n > 1 else words
        rows = zip(*(part[i:] for i in range(shingle)), strict=False) if n > 1 else [part]
        hashes = np.array([hash64(b" ".join(x), SEED) for x in rows], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp long)`` of every row; a text that is null or without words has fingerprint zero."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = np.fromiter((fingerprint(x, shingle) for x in part.column(1).to_pylist()), "<u8", part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view("<i8"))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, task, "id long, fp long")


def _walk(a: np.ndarray, b: np.ndarray, own: bool, depth: int, differ: int, budget: int) -> np.ndarray:
    """Group labels of ``a`` (then ``b``, unless ``own``: a joined with itself) after linking all
    pairs within the budget. Both sorted; all of each share their first ``depth`` bits, which differ
    in ``differ`` places between the sides."""
    labels = np.arange(len(a) if own else len(a) + len(b))
    shift = 0 if own else len(a)
    stack = [(depth, *(np.array([x]) for x in (0, len(a), 0, len(b), differ)))]
    while stack:
        depth, a0, a1, b0, b1, d = stack.pop()
        if len(d) > FRONTIER:
            half = len(d) // 2
            stack += [(depth, *(x[:half] for x in (a0, a1, b0, b1, d))), (depth, *(x[half:] for x in (a0, a1, b0, b1, d)))]
            continue
        ends = (a1 - a0 == 1) & (b1 - b0 == 1)  # two single fingerprints: compare the rest at once
        if depth == 64:
            ends[:] = True  # equal fingerprints may stand on both sides
        if ends.any():
            x, y = a0[ends], b0[ends]
            near = np.bitwise_count(a[x] ^ b[y]) <= budget
            labels = group_labels(len(labels), x[near], y[near] + shift, labels)
            a0, a1, b0, b1, d = (z[~ends] for z in (a0, a1, b0, b1, d))
        if not len(d):
            continue
        bit = np.uint64(1 << (63 - depth))
        above = ~np.uint64((1 << (64 - depth)) - 1)
        am = np.clip(np.searchsorted(a, (a[a0] & above) | bit), a0, a1)
        bm = np.clip(np.searchsorted(b, (b[b0] & above) | bit), b0, b1)
        once = (a0 == b0) & (a1 == b1) if own else np.zeros(len(d), bool)  # a node with itself: one of its two mixed pairs
        sides = [(a0, am, b0, bm, d), (am, a1, bm, b1, d), (a0, am, bm, b1, d + 1), (am, a1, b0, bm, np.where(once, budget + 1, d + 1))]
        new = [np.concatenate(x) for x in zip(*sides, strict=True)]
        keep = (new[0] < new[1]) & (new[2] < new[3]) & (new[4] <= budget)
        if keep.any():
            stack.append((depth + 1, *(x[keep] for x in new)))
    return labels


def links(fps: DataFrame, budget: int, count: int | None = None) -> DataFrame:
    """``(a, b)``: enough pairs to connect all distinct fingerprints ``fps(fp)`` that a chain of
    pairs within ``budget`` bits connects. No group emits more rows than it has fingerprints."""
    ship(fps.sparkSession)
    n = fps.count() if count is None else count
    stretch = 64 // (budget + 1)
    turns = [i * stretch for i in range(budget + 1)]
    depth = min(stretch, max(1, ceil(log2(max(1, n) / (SUBTREE / 2)))))
    turned = [F.shiftleft("fp", t).bitwiseOR(F.shiftrightunsigned("fp", 64 - t)) if t else F.col("fp") for t in turns]
    rows = fps.select(F.posexplode(F.array(*turned)).alias("trie", "bits"))
    rows = rows.select("trie", F.shiftrightunsigned("bits", 64 - depth).alias("p"), "bits")
    # only subtrees of several parts are joined: few, unless most fingerprints are in them
    large = rows.groupBy("trie", "p").agg(F.ceil(F.count("*") / F.lit(SUBTREE)).cast("int").alias("parts")).where("parts > 1")
    placed = rows.join(large, ["trie", "p"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int"))
    placed = placed.select("trie", "p", "bits", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    placed = placed.select("trie", "p", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "bits", (F.col("part") > F.col("other")).alias("right"))

    def task(group: pa.Table) -> pa.Table:
        bits, right = group.column("bits").to_numpy().view("<u8"), group.column("right").to_numpy(zero_copy_only=False)
        own, turn = group.column("x")[0] == group.column("y")[0], turns[group.column("trie")[0].as_py()]
        a, b = np.sort(bits[~right]), np.sort(bits[right])
        if not len(a) or not (own or len(b)):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        labels = _walk(a, a if own else b, own, depth, 0, budget)
        every = a if own else np.concatenate([a, b])
        if turn:
            every = (every >> np.uint64(turn)) | (every << np.uint64(64 - turn))
        found = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": every[found].view("<i8"), "b": every[labels[found]].view("<i8")})

    return placed.groupBy("trie", "p", "x", "y").applyInArrow(task, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component_id)`` for every row: the smallest id reachable over fingerprints that
    differ in ``budget`` bits or fewer.

    Rows with the same fingerprint are one node of the trie, however many; texts that are null,
    empty or blank share fingerprint zero. Rows with a null id get the smallest id of their
    component, which is null if it has none. Repeated rows come back as often as they came. An empty
    table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    rows = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    roots = connected_components(links(distinct.select("fp"), budget), "simhash")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rows.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")
