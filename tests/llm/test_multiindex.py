"""Near duplicates of vectors: planted pairs over many cells, any lengths, large groups."""

from __future__ import annotations

import numpy as np
import pytest

from cashwatch.llm import multiindex
from cashwatch.llm.multiindex import near_duplicates
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<double>"


def turned(x, cosine, rng):
    """Unit vectors at this cosine to unit vectors x, in random directions."""
    move = rng.normal(size=x.shape)
    move -= (move * x).sum(1, keepdims=True) * x
    move /= np.linalg.norm(move, axis=1, keepdims=True)
    return cosine * x + np.sqrt(1 - cosine**2) * move


def found_of(spark, vectors, schema=SCHEMA, **options):
    rows = [(i, None if v is None else [float(c) for c in v]) for i, v in enumerate(vectors)]
    out = near_duplicates(spark.createDataFrame(rows, schema).repartition(4), **options).collect()
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}


def expected_of(vectors):
    unit = np.array(vectors, float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    root = brute.groups(len(vectors), lambda i, j: near[i, j])
    return {i: (int(near[i].sum()) - 1, root[i], root[i] == i) for i in range(len(vectors))}


def test_planted_pairs_over_a_grid_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "FEW", 500)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = turned(x, 0.953, rng)
    vectors = np.concatenate([x, pairs * rng.uniform(0.5, 3, (1200, 1))])
    found = found_of(spark, vectors, rows_per_cell=30)  # 9 codewords a half: 81 cells
    expected = expected_of(vectors)
    wanted, got = sum(e[0] for e in expected.values()), sum(f[0] for f in found.values())
    assert wanted >= 2400 and all(found[i][0] <= expected[i][0] for i in found)
    assert got >= 0.98 * wanted
    assert sum(found[i] == expected[i] for i in found) >= 0.98 * len(found)


def test_a_large_group_of_near_equal_vectors_is_whole(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "FEW", 300)
    monkeypatch.setattr(multiindex, "MEMBERS", 64)
    monkeypatch.setattr(multiindex, "VISITORS", 128)
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(1, 24))
    group = centre + 0.02 * rng.normal(size=(400, 24))
    others = rng.normal(size=(300, 24))
    vectors = np.concatenate([others, group, group[:50]])
    found, expected = found_of(spark, vectors, rows_per_cell=40), expected_of(vectors)
    assert all(found[i] == expected[i] for i in range(300, 750))


def test_lengths_are_compared_each_for_itself(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "FEW", 20)
    rng = np.random.default_rng(10)
    long, short = rng.normal(size=(60, 16)), rng.normal(size=(40, 8))
    vectors = [*long, *(long[:20] * 2.5 + 0.001), *short, *(-short[:5]), *(short[5:10] * 3)]
    vectors += [[1.0], [2.0], [1.0], [-3.0], [0.0], [2.0, 1.0, 0.0], [4.0, 2.0, 0.0], [1.0, 1.0, 1.0, 1.0, 1.0], None, []]
    found = found_of(spark, vectors, rows_per_cell=8)
    assert all(found[i][0] == 1 and found[60 + i] == (1, i, False) for i in range(20))
    assert all(found[80 + i][0] == (1 if 5 <= i < 10 else 0) for i in range(40))
    n = 130
    assert [found[n + i] for i in range(10)] == [
        (2, n, True), (2, n, False), (2, n, False), (0, n + 3, True), (0, n + 4, True),
        (1, n + 5, True), (1, n + 5, False), (0, n + 7, True), (0, n + 8, True), (0, n + 9, True),
    ]


@pytest.mark.parametrize("kind", ["float", "int"])
def test_other_component_types(spark, kind):
    rows = [(1, [1, 0, 2]), (2, [2, 0, 4]), (3, [0, 1, 0]), (None, [1, 0, 2]), (1, [1, 0, 2])]
    rows = [(i, [float(c) if kind == "float" else c for c in v]) for i, v in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    found = sorted((str(r.vec_id), r.n_links, r.component_id) for r in near_duplicates(df).collect())
    assert found == [("1", 3, 1), ("1", 3, 1), ("2", 3, 1), ("3", 0, 3), ("None", 3, 1)]
