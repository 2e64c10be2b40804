"""Operators that SQL can express, against DuckDB; and top-k with awkward vectors."""

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from remitview.llm import voronoi_topk
from remitview.llm.queries import ORACLES, QUERIES
from tests.harness import compare, duck_connection


@pytest.mark.parametrize("key", ["op3_voronoi_topk", "documents_base_counts"])
def test_oracles(spark, key):
    sf = "/root/testdata/sf0.001"
    result = compare(spark, duck_connection(sf), key, QUERIES[key], ORACLES[key], sf)
    assert result["ok"], result


def test_a_cell_of_very_many_queries_is_split(spark):
    """All vectors near one pivot, all of them queries; unequal lengths, infinite components, unequal rows of one id."""
    r = np.random.default_rng(1)
    x = r.normal(0, 0.001, (150, 6)) + 1
    rows = [(int(i), [float(v) for v in row[: 5 if i % 7 == 0 else 6]]) for i, row in enumerate(x)]
    bad = [(900, [float("inf")] * 6), (901, [1.0, float("-inf")]), (None, [1.0] * 6)]
    twice = [(3, [2.0] * 6)]  # another row of id 3: a candidate too
    df = spark.createDataFrame(rows + bad + twice + [rows[5]], "vec_id long, embedding array<double>")
    found = voronoi_topk.top_k(df, lambda i: i >= 0, k=4, pivots=3, group_queries=20, slice_rows=40).collect()
    ints = [(i, np.floor(1024 * np.array([*v, *[0.0] * (6 - len(v))])).astype(np.int64)) for i, v in rows + twice]
    expected = []
    for q in range(150):
        if q == 3:
            continue  # answered for either of its rows
        own = next(v for i, v in ints if i == q)
        ranked = sorted(((int(own @ v), -i) for i, v in ints if i != q), reverse=True)[:4]
        expected += [(q, n + 1, -i, s) for n, (s, i) in enumerate(ranked)]
    assert sorted(tuple(x) for x in found if x.query_id != 3) == sorted(expected)
    assert len([x for x in found if x.query_id == 3]) == 4
