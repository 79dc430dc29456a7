"""Top-k search against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairtables.llm.topk_search import LARGEST, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, _row string, rank string, _cell int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 3) for i, v in rows], SCHEMA)


def plain(rows, top=5, every=50):
    usable = [
        (i, [max(-LARGEST, min(LARGEST, math.floor(float(np.float32(x)) * 256))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, q) in enumerate(usable):
        if i is None or i % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, c)), j is None, j or 0)
            for k, (j, c) in enumerate(usable)
            if k != at
        ]
        for rank, (score, null, j) in enumerate(sorted(scored)[:top], 1):
            out.append((i, rank, None if null else j, max(-(2**63), min(2**63 - 1, -score))))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def random_rows(n, dims, kind, seed):
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        centres = rng.normal(size=(5, dims))
        values = centres[rng.integers(0, 5, n)] + 0.1 * rng.normal(size=(n, dims))
    elif kind == "ties":
        values = rng.integers(-1, 2, size=(n, dims)) / 4
    else:
        values = rng.normal(size=(n, dims)) * np.exp(-np.arange(dims) / 4)
    return [(i, [float(x) for x in v]) for i, v in enumerate(values)]


@pytest.mark.parametrize("kind", ["clusters", "ties", "falling"])
@pytest.mark.parametrize("dims, block_rows, query_rows, step", [(20, 40, 3, 4), (7, 1000, 100, 8)])
def test_same_as_all_pairs(spark, kind, dims, block_rows, query_rows, step):
    rows = random_rows(403, dims, kind, dims)
    got = top_k(table(spark, rows), block_rows=block_rows, query_rows=query_rows, step=step, cell_bytes=2_000)
    assert found(got) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0, -0.001]), (0, [1.0, 2.0, 3.0]), (50, None), (50, [1.0, None]), (50, [1.0, float("nan")]),
        (50, [float("inf")]), (None, [1.0, 2.0, -0.001]), (None, [5.0]), (100, []), (-50, [0.5]),
        (7, [1.0, 2.0, 3.0, 4.0]), (7, [1.0, 2.0, 3.0, 4.0]), (8, [1.0]),
    ]
    assert found(top_k(table(spark, rows), block_rows=3, query_rows=2)) == plain(rows)


def test_large_components(spark):
    rows = [(0, [1e30, 3.0]), (1, [1e12, 1.0]), (2, [1e12, 2.0]), (3, [-1e30, 1.0]), (4, [3e3, 0.0]), (50, [-1e9, 7.0])]
    assert found(top_k(table(spark, rows))) == plain(rows)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0]), (50, [2.0])]
    assert found(top_k(table(spark, rows))) == plain(rows)
    assert found(top_k(table(spark, rows[:1]))) == []


def test_empty_table(spark):
    assert found(top_k(table(spark, []))) == []


def test_other_queries(spark):
    rows = random_rows(120, 5, "falling", 1)
    got = top_k(table(spark, rows), is_query=F.col("vec_id") % 7 == 0, top=2)
    assert found(got) == plain(rows, top=2, every=7)


def test_no_cross_join(spark):
    plan = top_k(table(spark, random_rows(60, 4, "ties", 2)))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
