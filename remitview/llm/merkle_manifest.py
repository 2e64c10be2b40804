"""A Merkle manifest of a table of documents, its trees kept in van Emde Boas order.

Every language is a tree of fan-out ``FAN`` over its rows' digests, and the languages' roots are the
leaves of one more such tree. A tree is cut into aligned blocks of ``FAN ** BLOCK_HEIGHT`` leaves.
A task hashes a block's nodes into one byte string in van Emde Boas order: a subtree is its top
half followed by its bottom subtrees, each laid out alike, so a path from leaf to root stays within
few short stretches of the string whatever the size of a cache line. Addresses are arithmetic; no
pointer is stored. The blocks' roots are the leaves of the next round, until each tree is one node.
Proofs go the other way: from the last round down, each block hands its children the runs of
siblings above them, so a row's proof is read from its own block and one short path.

A block holds a bounded number of digests, however many rows a language has, and every round is a
table in the shared folder.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import crc32_sql, free_name, id_text_crc, map_arrow, materialise, numbered

FAN = 8
#: Levels below a block's root: 4096 leaves, 150 KB of digests.
BLOCK_HEIGHT = 4
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<run:binary,at:int>>"
_PATH = pa.list_(pa.struct([("run", pa.binary()), ("at", pa.int32())]))


def tree_size(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index):
    """Slot of node ``index`` of ``depth`` (the root's is 0) in a complete tree of ``levels`` levels.

    The upper half of the levels comes first, then one after another the subtrees that hang from it;
    the same rule holds inside each. ``index`` may be an array.
    """
    at = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
        else:
            depth, levels = depth - top, levels - top
            subtree, index = index // FAN**depth, index % FAN**depth
            at = at + tree_size(top) + subtree * tree_size(levels)
    return at + index


@functools.cache
def layout(levels: int) -> list[list[int]]:
    """Byte offsets of all nodes, by depth."""
    return [(DIGEST * address(levels, d, np.arange(FAN**d))).tolist() for d in range(levels)]


def joined(digests: bytes) -> bytes:
    """H of digests given as bytes and hashed as hex text."""
    return hashlib.sha256(digests.hex().encode()).digest()


def height(n: int) -> int:
    """Levels below the root of a tree over ``n`` leaves."""
    h = 0
    while FAN**h < n:
        h += 1
    return h


class Block:
    """The nodes over up to ``FAN ** height`` leaves. ``counts[d]`` nodes stand at depth d."""

    def __init__(self, h: int, n: int, nodes: bytes | None = None):
        self.height, self.at = h, layout(h + 1)
        self.counts = [n]
        for _ in range(h):
            self.counts.insert(0, -(-self.counts[0] // FAN))
        self.nodes = bytearray(DIGEST * tree_size(h + 1)) if nodes is None else nodes

    def node(self, depth: int, index: int) -> bytes:
        at = self.at[depth][index]
        return bytes(self.nodes[at : at + DIGEST])

    def run(self, depth: int, first: int) -> bytes:
        """The siblings from ``first`` on, that one included."""
        return b"".join(self.node(depth, i) for i in range(first, min(first + FAN, self.counts[depth])))

    def fill(self, leaves: list[bytes]) -> bytes:
        """Hash upwards from the leaves; the root."""
        for at, leaf in zip(self.at[self.height], leaves, strict=False):
            self.nodes[at : at + DIGEST] = leaf
        for depth in range(self.height - 1, -1, -1):
            for i in range(self.counts[depth]):
                at = self.at[depth][i]
                self.nodes[at : at + DIGEST] = joined(self.run(depth + 1, FAN * i))
        return self.node(0, 0)

    def paths(self, above: list[dict]) -> Iterator[list[dict]]:
        """For each leaf the runs on its way up, and its place in each: the block's, then ``above``."""
        runs = [[self.run(d, i) for i in range(0, self.counts[d], FAN)] for d in range(1, self.height + 1)]
        for leaf in range(self.counts[-1]):
            own = []
            for d in range(self.height, 0, -1):
                own.append({"run": runs[d - 1][leaf // FAN], "at": leaf % FAN})
                leaf //= FAN
            yield own + above


def proof(path: list[dict]) -> str:
    """Digest of the siblings on a path, from the leaf up, left to right."""
    siblings = b"".join(p["run"][: DIGEST * p["at"]] + p["run"][DIGEST * (p["at"] + 1) :] for p in path)
    return joined(siblings).hex()


def folded(leaf: bytes, path: list[dict]) -> bytes:
    """The root over ``leaf`` and the siblings on its path."""
    for p in path:
        leaf = joined(p["run"][: DIGEST * p["at"]] + leaf + p["run"][DIGEST * (p["at"] + 1) :])
    return leaf


def _blocks(nodes: DataFrame) -> DataFrame:
    """One round: ``nodes`` (tree, pos, n, digest, and what travels with a leaf) to blocks, each with
    its leaves' further columns as lists, ordered by position."""
    leaves = FAN**BLOCK_HEIGHT
    further = [c for c in nodes.columns if c not in ("tree", "pos", "n", "digest")]
    group = nodes.select("tree", "n", F.expr(f"pos div {leaves}").alias("block"), F.struct("pos", "digest", *further).alias("leaf"))
    group = group.groupBy("tree", "n", "block").agg(F.array_sort(F.collect_list("leaf")).alias("leaf"))
    lists = group.select("tree", "n", "block", *(F.col(f"leaf.{c}").alias(c) for c in ("digest", *further)))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = part.column(1).to_pylist()
            hashed, roots = [], []
            for n, digests in zip(sizes, part.column(3).to_pylist(), strict=True):
                block = Block(min(height(n), BLOCK_HEIGHT), len(digests))
                roots.append(block.fill(digests))
                hashed.append(bytes(block.nodes))
            columns = [*part.columns, pa.array(hashed, pa.binary()), pa.array(roots, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "nodes", "root"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lists.schema) + ", nodes binary, root binary"
    return map_arrow(lists, task, schema)


def build(nodes: DataFrame, name: str) -> list[DataFrame]:
    """All rounds of blocks over ``nodes`` (tree, pos, n, digest, ...), tables in the shared folder;
    the last round has one block per tree that is not finished before."""
    rounds = []
    while True:
        blocks = materialise(_blocks(nodes), f"{name}-round-{len(rounds)}")
        rounds.append(blocks)
        left = F.expr(f"(n + {FAN**BLOCK_HEIGHT - 1}) div {FAN**BLOCK_HEIGHT}")
        nodes = blocks.select("tree", F.col("block").alias("pos"), left.alias("n"), F.col("root").alias("digest")).where("n > 1")
        if nodes.isEmpty():
            return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """``(tree, digest)`` of every tree."""
    done = [b.where(F.col("n") <= FAN**BLOCK_HEIGHT).select("tree", F.col("root").alias("digest")) for b in rounds]
    return functools.reduce(DataFrame.unionByName, done)


def _below(blocks: DataFrame) -> DataFrame:
    """Paths of a round's leaves, which are the blocks of the round before, from ``path`` of its blocks."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for tree, n, block, count, nodes, above, top in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = list(Block(min(height(n), BLOCK_HEIGHT), count, nodes).paths(above))
                first = block * FAN**BLOCK_HEIGHT
                columns = [pa.array([tree] * count, pa.string()), pa.array(range(first, first + count), pa.int64()), pa.array(found, _PATH), pa.array([top] * count, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "block", "path", "top"])

    rows = blocks.select("tree", "n", "block", F.size("digest").alias("count"), "nodes", "path", "top")
    return map_arrow(rows, task, f"tree string, block long, path {PATH}, top binary")


def with_paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's blocks with ``path``, all runs over the block's root, and ``top``, the root
    they fold to; ``above`` gives (tree, path, top) over the trees' roots."""
    paths = None
    for blocks in reversed(rounds):
        last = blocks.where(F.col("n") <= FAN**BLOCK_HEIGHT).join(above, "tree")
        if paths is not None:
            lower = blocks.where(F.col("n") > FAN**BLOCK_HEIGHT).join(paths, ["tree", "block"])
            last = last.unionByName(lower)
        if blocks is rounds[0]:
            return last
        paths = _below(last)
    raise AssertionError("no rounds")


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon, its text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    fields = {c: F.col(c) for c in FIELDS} | {"text": text}
    return F.unhex(F.sha2(F.concat(*(field(fields[c]) for c in FIELDS)), 256))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def tree_name(lang: Column) -> Column:
    """A text for every language, null and empty apart, that sorts as they do, null first."""
    return F.coalesce(F.concat(F.lit("+"), lang.cast("string")), F.lit(""))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Per row: leaf, its tree's root ``subroot``, the ``root`` over all, the digest of its proof,
    and the root that folds from the row as it is now.

    ``docs`` has the columns doc_id, source, lang, n_chars and text (others are ignored). ``tampered`` is the text
    as found now (default: the original); a null text stays as it is. Rows of a null language are a
    tree of their own, the first. Within a tree rows ascend by doc_id, nulls first, rows of one id by
    their digest; equal rows are leaves of their own. An empty table gives no row. The only row of a
    table has an empty proof, and its leaf is the root.
    """
    now = leaf_digest(F.col("text") if tampered is None else tampered)
    tree = free_name(docs, "tree")
    rows = docs.select(tree_name(F.col("lang")).alias(tree), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(F.col("text")).alias("digest"), now.alias("now"))
    # a digest found unchanged need not travel twice
    rows = rows.withColumnRenamed(tree, "tree").withColumn("now", F.when(F.col("now") != F.col("digest"), F.col("now")))
    leaves = numbered(rows, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest")], "merkle-leaves")
    rounds = build(leaves, "merkle")
    subroots = materialise(roots(rounds), "merkle-subroots")
    one = F.lit("").alias("tree")
    top = build(numbered(subroots.select(one, F.col("tree").alias("lang"), "digest"), ["tree"], [F.col("lang")], "merkle-trees"), "merkle-top")
    over = with_paths(top, roots(top).select("tree", F.expr(f"cast(array() as {PATH})").alias("path"), F.col("digest").alias("top")))
    above = materialise(_tree_paths(over), "merkle-above")
    blocks = with_paths(rounds, above).join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    return _proofs(blocks)


def _tree_paths(blocks: DataFrame) -> DataFrame:
    """``(tree, path, top)`` of the trees that are the leaves of the top tree."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n, langs, nodes, above, top in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = list(Block(min(height(n), BLOCK_HEIGHT), len(langs), nodes).paths(above))
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, _PATH), pa.array([top] * len(langs), pa.binary())], names=["tree", "path", "top"])

    return map_arrow(blocks.select("n", "lang", "nodes", "path", "top"), task, f"tree string, path {PATH}, top binary")


def _proofs(blocks: DataFrame) -> DataFrame:
    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n, ids, digests, nows, nodes, above, subroot, top in zip(*(c.to_pylist() for c in part.columns), strict=True):
                paths = Block(min(height(n), BLOCK_HEIGHT), len(ids), nodes).paths(above)
                out = [(leaf.hex(), proof(p), folded(now or leaf, p)) for leaf, now, p in zip(digests, nows, paths, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([x[0] for x in out], pa.string()),
                        pa.array([subroot.hex()] * len(out), pa.string()),
                        pa.array([top.hex()] * len(out), pa.string()),
                        pa.array([x[1] for x in out], pa.string()),
                        pa.array([x[2].hex() for x in out], pa.string()),
                        pa.array([x[2] == top for x in out], pa.bool_()),
                    ],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    rows = blocks.select("n", "doc_id", "digest", "now", "nodes", "path", "subroot", "top")
    return map_arrow(rows, task, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def damaged_every_third() -> Column:
    """The text as the registered query tampers with it: lower-cased where 3 divides the id's crc32."""
    return F.when(F.pmod(id_text_crc("doc_id"), F.lit(3)) == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))


def oracle_sql() -> str:
    """The manifest of ``documents`` in DuckDB, level by level."""
    hashed = "concat({})".format(", ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def levels(name: str, base: str) -> str:
        return f"""{name} AS (
            {base}
            UNION ALL
            SELECT tree, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value(of_level)
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS of_level FROM (SELECT tree, level, pos, h FROM {name}))
            WHERE of_level > 1 GROUP BY tree, level, pos // 8)"""

    return f"""
    WITH RECURSIVE leaves AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
            SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256({hashed}) AS leaf,
                   sha256({hashed.replace("text::VARCHAR", "now::VARCHAR")}) AS now
            FROM (SELECT *, CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {lowered} ELSE text END AS now FROM documents))),
    {levels("nodes", "SELECT tree, 0 AS level, pos, leaf AS h, 0::BIGINT AS of_level FROM leaves")},
    subroots AS (SELECT tree, arg_max(h, level) AS subroot, max(level) AS height FROM nodes GROUP BY tree),
    {levels("tops", "SELECT '' AS tree, 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, subroot AS h, 0::BIGINT AS of_level FROM subroots")},
    places AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS place FROM subroots),
    top AS (SELECT arg_max(h, level) AS root, max(level) AS height FROM tops),
    steps AS (
        SELECT l.tree, l.pos, n.level AS step, string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < (l.pos >> (3 * n.level))) AS lefts,
               string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > (l.pos >> (3 * n.level))) AS rights
        FROM leaves l JOIN subroots s USING (tree) JOIN nodes n ON n.tree = l.tree AND n.level < s.height AND (n.pos >> 3) = (l.pos >> (3 * n.level + 3))
        GROUP BY ALL
        UNION ALL
        SELECT l.tree, l.pos, 1000 + n.level, string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < (p.place >> (3 * n.level))),
               string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > (p.place >> (3 * n.level)))
        FROM leaves l JOIN places p USING (tree), top t, tops n
        WHERE n.level < t.height AND (n.pos >> 3) = (p.place >> (3 * n.level + 3))
        GROUP BY ALL),
    paths AS (
        SELECT tree, pos, string_agg(coalesce(lefts, '') || coalesce(rights, ''), '' ORDER BY step) AS siblings,
               list({{'l': coalesce(lefts, ''), 'r': coalesce(rights, '')}} ORDER BY step) AS path
        FROM steps GROUP BY tree, pos),
    folds AS (
        SELECT l.tree, l.pos, 0 AS k, l.now AS h, coalesce(p.path, []) AS path FROM leaves l LEFT JOIN paths p USING (tree, pos)
        UNION ALL
        SELECT tree, pos, k + 1, sha256(path[k + 1].l || h || path[k + 1].r), path FROM folds WHERE k < len(path))
    SELECT l.doc_id, l.leaf, s.subroot, t.root, sha256(coalesce(p.siblings, '')) AS proof_sha256, f.h AS folded_root, f.h = t.root AS verified
    FROM leaves l JOIN subroots s USING (tree) LEFT JOIN paths p USING (tree, pos) JOIN folds f ON f.tree = l.tree AND f.pos = l.pos AND f.k = len(f.path), top t
    """
