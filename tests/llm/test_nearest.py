"""Nearest neighbours: recall over many cells and blocks, the stop, other lengths."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cashwatch.llm.nearest import DIRECTIONS, Projection, chi_square_quantile, nearest_neighbours, search_block

K = 20


def truth(ids, x, query, k=K):
    rows = [r for r in range(len(ids)) if ids[r] != ids[query]]
    score = (x[rows] * x[query]).sum(1)
    return [ids[rows[i]] for i in np.lexsort((np.array(ids)[rows], -score))[:k]]


@pytest.mark.parametrize("kind", ["random", "clustered"])
def test_recall_over_many_cells(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 32)) if kind == "random" else rng.normal(size=(60, 32)).repeat(50, 0) + 0.3 * rng.normal(size=(3000, 32))
    x *= rng.uniform(0.5, 2, (3000, 1))
    ids = list(range(3000))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest_neighbours(df.repartition(5), F.col("vec_id") % 20 == 0, K, rows_per_block=200).orderBy("query_id", "rank").collect():
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), rel=1e-12)
        found[r.query_id].append(r.vec_id)
    assert sorted(found) == list(range(0, 3000, 20)) and all(len(v) == K for v in found.values())
    hits = sum(len(set(v) & set(truth(ids, x, q))) for q, v in found.items())
    assert hits >= 0.9 * K * len(found)


def test_a_bound_stops_the_search_early():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(50, 8)) * 0.05 + 3, rng.normal(size=(4000, 8))])
    longest = np.linalg.norm(x, axis=1).max()
    projection, test = Projection.of(longest, 8, DIRECTIONS), chi_square_quantile(0.97, DIRECTIONS)
    ids, q = np.arange(len(x)), x[:3]
    whole = {r: i.tolist() for r, i, _ in search_block(ids, x, ids[:3], q, np.full(3, np.inf), projection, 5, test)}
    assert all(len(set(v) & set(truth(ids.tolist(), x, r, 5))) >= 4 for r, v in whole.items())
    nothing = [len(i) for _, i, _ in search_block(ids[50:], x[50:], ids[:3], q, np.full(3, 1e-9), projection, 5, test)]
    assert nothing == [0, 0, 0]


def test_other_lengths_take_part(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(50)] + [(100 + i, rng.normal(size=3).tolist()) for i in range(30)] + [(200, [1.0]), (201, [2.0]), (202, [-1.0]), (300, [1.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = nearest_neighbours(df, F.col("vec_id") % 10 == 0, 5, rows_per_block=8).orderBy("query_id", "rank").collect()
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append(r.vec_id)
    short = {i: np.array(v) for i, v in rows if 100 <= i < 200}
    for q in (100, 110, 120):
        assert found[q] == sorted((i for i in short if i != q), key=lambda i: (-(short[i] * short[q]).sum(), i))[:5]
    assert found[200] == [201, 202] and 300 not in found and set(found) == {0, 10, 20, 30, 40, 100, 110, 120, 200}
