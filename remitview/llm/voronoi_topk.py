"""Exact top-k search by inner product as a Voronoi join.

Pivots cut the vectors into cells. Summaries of the cells (counts, radii, the distances of their
``k + 1`` innermost vectors) give every query cell a score that its k-th best surely reaches, and
every data cell an upper bound that falls with a vector's distance from its pivot. A vector is sent
only to the groups of query cells that its bound can still serve; each group then solves its
queries against bounded slices of the data, and the slices' best are merged.

With ``p`` the pivot of x's cell, ``o`` that of q's cell, and q = o + u:
    q.x = q.p + q.(x - p)  lies within  o.p -+ (|u||p| + |q||x - p|).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from remitview.llm.common import map_arrow, materialise, ship

SCALE = 1024
#: Pivots (drawn by hash; this many vectors at most reach the driver), queries of a group, and
#: vectors of a slice: a task holds that many of either.
PIVOTS, GROUP_QUERIES, SLICE = 64, 2048, 20_000


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x array<double>)``: components floor(1024 * x). Rows whose id or vector is null,
    or whose vector holds a null or non-finite component, take no part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False))).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * float(SCALE)).cast("double")).alias("x")
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of vectors; shorter ones are padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if width is None else width
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where every partial sum stays below 2**53, else in integers of any size."""
    bound = queries.shape[1] * float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0))
    if bound < 2**53:
        return (queries @ data.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in data]
    return np.array([[sum(a * b for a, b in zip(q, x, strict=True)) for x in whole[1]] for q in whole[0]], object)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k highest scores, ties to the smaller id. ``ids`` ascend."""
    if len(scores) > k and scores.dtype != object:
        at_least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= at_least)
        return near[np.argsort(-scores[near], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, group_queries: int = GROUP_QUERIES, slice_rows: int = SLICE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row where ``is_query(vec_id)`` holds, the ``k``
    rows of other ids with the highest integer inner product, ties to the smaller id; all of them
    where there are fewer.

    Vectors of unequal length are compared as if padded with zeros. Exact repeats of a row count
    once; of unequal rows with one id, each is a candidate and the queries among them are answered
    together. An empty table, or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = integers(vectors, id_col, vector_col)
    draw = F.xxhash64("x", "vec_id")
    centres = [r[0] for r in rows.orderBy(draw).select("x").limit(pivots).collect()]
    width = max((len(x) for x in centres), default=1)
    width = max(width, rows.agg(F.max(F.size("x"))).first()[0] or 1)
    centre = np.unique(np.array([list(x) + [0.0] * (width - len(x)) for x in centres] or [[0.0] * width]), axis=0)

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (centre * centre).sum(axis=1) / 2
        for part in parts:
            x = _matrix(part.column(1), width)
            cell = np.argmin(half - x @ centre.T, axis=1) if len(x) else np.zeros(0, np.int64)
            away = np.sqrt(((x - centre[cell]) ** 2).sum(axis=1))
            columns = [part.column(0), part.column(1), pa.array(cell, pa.int32()), pa.array(away), pa.array(np.sqrt((x * x).sum(axis=1)))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "x", "cell", "away", "norm"])

    table = materialise(map_arrow(rows.distinct(), assign, "vec_id long, x array<double>, cell int, away double, norm double"), "voronoi")
    query = table.where(is_query(F.col("vec_id")))

    # summaries: a few numbers for each of at most ``pivots`` cells
    order = Window.partitionBy("cell", "salt").orderBy("away")
    near = table.select("cell", "away", F.pmod(F.xxhash64("vec_id", "x"), F.lit(64)).alias("salt")).withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    nearest = {r["cell"]: r["away"] for r in near.groupBy("cell").agg(F.slice(F.sort_array(F.collect_list("away")), 1, k + 1).alias("away")).collect()}
    of_queries = {r["cell"]: r for r in query.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("away"), F.max("norm").alias("norm")).collect()}
    schema = "query_id long, rank int, vec_id long, score long"
    if not of_queries:
        return spark.createDataFrame([], schema)

    dot, length = centre @ centre.T, np.sqrt((centre * centre).sum(axis=1))
    groups: dict[int, int] = {}
    group = room = 0
    for cell in sorted(of_queries, key=lambda c: -dot[c, 0]):  # neighbouring cells share a group
        if room and room + of_queries[cell]["n"] > group_queries:
            group, room = group + 1, 0
        groups[cell], room = group, room + of_queries[cell]["n"]
    asking: dict[int, int] = {}
    for cell, g in groups.items():
        asking[g] = asking.get(g, 0) + of_queries[cell]["n"]
    q_parts = {g: -(-n // group_queries) for g, n in asking.items()}  # a cell of very many queries is several tasks'
    bounds: dict[tuple[int, int], float] = {}  # by query group and data cell, the least distance from the pivot worth sending
    for cell, s in of_queries.items():
        sure = sorted((dot[cell, c] - s["away"] * length[c] - s["norm"] * a for c, away in nearest.items() for a in away), reverse=True)
        reached = sure[k] if len(sure) > k else -np.inf  # k others, whichever the query itself is
        for c in nearest:
            slack = 1e-6 * (abs(dot[cell, c]) + s["away"] * length[c] + abs(reached if len(sure) > k else 0) + 1)
            need = (reached - slack - dot[cell, c] - s["away"] * length[c]) / max(s["norm"], 1e-9)
            key = (groups[cell], c)
            bounds[key] = min(bounds.get(key, np.inf), need)
    least_away = [(g, c, float(max(need, -1.0)), q_parts[g]) for (g, c), need in bounds.items()]
    served = F.broadcast(spark.createDataFrame(least_away, "grp int, cell int, least double, q_parts int"))  # query groups x pivots rows
    sent = table.join(served, "cell").where("away >= least").select("grp", "q_parts", "vec_id", "x")
    slices = sent.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(slice_rows)).cast("int").alias("slices"))
    data = sent.join(F.broadcast(slices), "grp").withColumn("part", F.pmod(F.xxhash64("vec_id", "x"), F.col("slices")).cast("int"))
    data = data.select("grp", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"), "part", "vec_id", "x")
    grouped = F.broadcast(spark.createDataFrame([(c, g, q_parts[g]) for c, g in groups.items()], "cell int, grp int, q_parts int"))
    asked = query.join(grouped, "cell").join(F.broadcast(slices), "grp").withColumn("q_part", F.pmod(F.xxhash64("vec_id"), F.col("q_parts")).cast("int"))
    asked = asked.select("grp", "q_part", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("part"), F.col("vec_id").alias("query_id"), F.col("x").alias("q"))

    def solve(_, left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("vec_id")
        ids, q_ids = right.column("vec_id").to_numpy(), left.column("query_id").to_numpy()
        x, out = _matrix(right.column("x"), width), [[], [], []]
        if len(ids):
            for at in range(0, len(q_ids), 128):
                scores = products(_matrix(left.column("q").slice(at, 128), width), x)
                for q, row in zip(q_ids[at : at + 128], scores, strict=True):
                    other = ids != q
                    found = best(row[other], ids[other], k)
                    out[0].append(np.full(len(found), q))
                    out[1].append(ids[other][found])
                    out[2] += row[other][found].tolist()
        flat = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out[:2]]
        return pa.table({"query_id": pa.array(flat[0], pa.int64()), "vec_id": pa.array(flat[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    found = asked.groupBy("grp", "q_part", "part").cogroup(data.groupBy("grp", "q_part", "part")).applyInArrow(solve, "query_id long, vec_id long, score long")
    ranked = found.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle_sql(k: int = 10, every: int = 100) -> str:
    """Brute force in DuckDB: all inner products of the queries, ranked."""
    return f"""
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v::DOUBLE))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.x, d.x)::BIGINT AS score
        FROM (SELECT * FROM whole WHERE vec_id % {every} = 0) q JOIN whole d ON q.vec_id <> d.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored QUALIFY rank <= {k}
    """
