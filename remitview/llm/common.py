"""Helpers shared by the training-data operators: shared-folder tables, connected components,
Arrow batches and in-task union of links."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of every word pattern here: bytes 0x20 and 0x09-0x0D. ``bytes.split()`` splits at exactly these.
WHITESPACE = r"[\x20\x09-\x0D]+"

#: Rows, and bytes, handed to a Python task at once: whole texts are long, keys are short.
ROWS_PER_BATCH, BYTES_PER_BATCH = 20_000, "4m"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset a local session gets a
    temporary one; on a cluster an unset folder is an error, since executors share no local disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return base.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back. The table survives lost
    executors and cuts the lineage. It can't be removed here: results that are still to be computed
    read it, so the folder's owner clears ``remitview-llm`` when a job's results are written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/remitview-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_text_crc(col: str) -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary"))


def crc32_sql(text: str) -> str:
    """DuckDB expression of a text's unsigned crc32 (UTF-8 letters of one byte, as in ids), bit by bit."""
    bits = "list_reduce([xor(c, b::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    letters = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {letters}), lambda c, b: {bits}), 4294967295)"


def numbered(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``pos``, a row's place (from 0) among the rows of equal ``keys`` in the order
    ``order``, and ``n``, their number.

    No group meets in one task: the rows are cut into ranges of (keys, order, a hash of the row's own
    number), so the largest group, and any number of equal rows, spreads over as many tasks as its
    share asks for. A range's rows count on from the sum of the ranges before it, one row per range
    and key. Rows equal in keys and order stand in any order among themselves. ``keys`` may be null.
    """
    salted = materialise(df.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id())), f"{name}-rows")
    by = [*(F.col(k) for k in keys), *order, F.col("__salt")]
    sorted_ = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("__salt")
    sorted_ = materialise(sorted_.withColumn("__row", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("__row", 33)
    ranges = sorted_.groupBy(part.alias("__part"), *(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min("__row").alias("__first"), F.count("*").alias("__rows"))
    group = Window.partitionBy(*(f"__{k}" for k in keys))
    before = F.sum("__rows").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("*", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__rows").over(group).alias("n"))
    same = [part == F.col("__part"), *(F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys)]
    joined = sorted_.join(ranges, reduce(and_, same))
    return joined.select(*df.columns, (F.col("__row") - F.col("__first") + F.col("__before")).alias("pos"), "n")


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once for a Spark context, so that tasks
    can import it wherever it is installed on the driver only."""
    sc = spark.sparkContext
    if getattr(sc, "_remitview_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp()) / "remitview_tasks.zip"
    with zipfile.ZipFile(to, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(to))
    sc._remitview_shipped = True


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with small batches. Spark reads the batch sizes when the job runs, long after this
    returns, so they are settings of the session and stay: they bound other Arrow batches too."""
    ship(df.sparkSession)
    for name, value in (("maxRecordsPerBatch", str(ROWS_PER_BATCH)), ("maxBytesPerBatch", BYTES_PER_BATCH)):
        if df.sparkSession.conf.get(f"spark.sql.execution.arrow.{name}", None) != value:
            df.sparkSession.conf.set(f"spark.sql.execution.arrow.{name}", value)
    return df.mapInArrow(fn, schema)


def batches(columns: dict[str, list | np.ndarray], schema: pa.Schema, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Cut equally long columns into record batches."""
    arrays = [pa.array(columns[f.name], type=f.type) for f in schema]
    whole = pa.RecordBatch.from_arrays(arrays, schema=schema)
    for at in range(0, whole.num_rows, rows):
        yield whole.slice(at, rows)


def group_labels(n: int, u: np.ndarray, v: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes over the links ``u[i]-v[i]`` (and over
    ``labels``, an earlier result)."""
    labels = np.arange(n) if labels is None else labels
    while len(u):
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped
    return labels


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """Components of the links ``edges(a, b)`` by alternating large-star and small-star rounds.

    Returns ``(node, root)`` for every node that has a link to a smaller one, root being the smallest
    node of its component; roots themselves and isolated nodes have no row. Links that are null or
    loop are ignored. Each round is joins and partial aggregates over a table in the shared folder;
    the driver reads one row of counts a round. A node with very many links is a skewed join key,
    which adaptive execution splits, and its minimum is combined map-side.
    """
    edges = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-links"
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), f"{name}-round")
