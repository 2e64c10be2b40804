"""Derive a k-times larger copy of a test scale with Spark (for scale checks).

    python tools/scale_up.py /root/testdata/sf0.1 "$(mktemp -d /tmp/run-XXXXXX)/sf0.1x10" 10
    BENCH_SF_DIR=<that dir> BENCH_QUERIES=open_ffs,open_cco,denied_ffs,denied_cco python bench.py

orders and lineitem are copied k times with order keys shifted by a multiple
of (max key + 1), so copies never collide, and are written as k parquet files
each; the other tables are copied unchanged (every customer then holds k times
the claims).  A fourth argument ``hot`` gives a third of the orders to one
customer and a third of the lines to one supplier, hence to one carrier and one
claim header.  The output folder must be new; nothing is overwritten.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from remitview.session import local_session  # noqa: E402


def replicate(df, key: str, k: int, step: int):
    out = None
    for i in range(k):
        part = df.withColumn(key, F.col(key) + F.lit(i * step))
        out = part if out is None else out.unionByName(part)
    return out.repartition(k)


def hot(df, key: str, of: str):
    """A third of the rows (by ``of``) moved to one value of ``key``."""
    one = df.agg(F.min(key)).first()[0]
    return df.withColumn(key, F.when(F.pmod(F.xxhash64(of), F.lit(3)) == 0, F.lit(one)).otherwise(F.col(key)))


def main(src: str, dst: str, k: int, skewed: bool = False) -> None:
    spark = local_session(8)
    orders = spark.read.parquet(f"{src}/orders.parquet")
    step = orders.agg(F.max("o_orderkey")).first()[0] + 1
    lineitem = spark.read.parquet(f"{src}/lineitem.parquet")
    if skewed:
        orders, lineitem = hot(orders, "o_custkey", "o_orderkey"), hot(lineitem, "l_suppkey", "l_orderkey")
    replicate(orders, "o_orderkey", k, step).write.mode("errorifexists").parquet(f"{dst}/orders.parquet")
    replicate(lineitem, "l_orderkey", k, step).write.mode("errorifexists").parquet(f"{dst}/lineitem.parquet")
    for t in ("customer", "supplier", "nation", "region", "part"):
        spark.read.parquet(f"{src}/{t}.parquet").write.mode("errorifexists").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]) if len(sys.argv) > 3 else 10, "hot" in sys.argv[4:])
