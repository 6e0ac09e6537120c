"""Approximate nearest neighbours by stable projections and kd-trees.

The largest inner product becomes a nearest neighbour by one more component: every vector is
lifted to the length of the longest one. A projection on few Gaussian directions is 2-stable:
a squared distance d^2 is projected to d^2 times a chi-square variable. Projected vectors lie in
kd-trees. A query takes its projected neighbours in the order of distance and verifies them by
their true inner products, until the chi-square test holds: at the current k-th distance, a
better vector would be projected this far with a chance of `1 - confidence` only.

An upper kd-tree, fitted on a bounded sample, deals the vectors to cells; the rows of a cell are
cut into blocks of bounded size, each with a kd-tree of its own. A query first searches a block
of its own cell, which bounds its k-th distance. It then goes to all other blocks whose region
passes the test. Blocks of queries and blocks of vectors meet; results are merged per query.

Vectors of different lengths have no inner product. The index is built for the most common length;
blocks of any other length are compared with all queries of that length.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, as candidates and as queries; rows without an id neither; of rows with one id the smallest
array stands for the id; ties go to the smaller id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cashwatch.llm.common import staged
from cashwatch.llm.vectors import is_valid, matrix, row_groups, usual_length

DIRECTIONS = 12
CONFIDENCE = 0.97
SAMPLE_ROWS = 8192  # vectors that the upper tree is fitted on, at most
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 8192
MOST_CELLS = 1024
LEAF = 32
FIRST_LEAVES = 4  # of the first portion; each has twice as many as the one before
QUERIES_AT_ONCE = 64
SPARSE = 1 / 16  # of a block's rows, below which products are taken one query at a time


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees, by bisection of the closed form."""
    def chance(x: float) -> float:
        terms = [1.0]
        for j in range(1, degrees // 2):
            terms.append(terms[-1] * x / 2 / j)
        return 1 - math.exp(-x / 2) * sum(terms)

    low, high = 0.0, 40.0 * degrees
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chance(mid) < p else (low, mid)
    return high


@dataclass
class Projection:
    """The lift to length `longest`, and the directions to project on."""

    longest: float
    directions: np.ndarray

    @classmethod
    def of(cls, longest: float, length: int, count: int) -> Projection:
        return cls(longest, np.random.default_rng(29).normal(size=(length + 1, count)))

    def vectors(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(1), 0.0))
        return x @ self.directions[:-1] + lift[:, None] * self.directions[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        """Queries are scaled to the common length, which changes no order, and not lifted."""
        return self.scaled(q) @ self.directions[:-1]

    def scaled(self, q: np.ndarray) -> np.ndarray:
        return q / np.linalg.norm(q, axis=1, keepdims=True) * self.longest


@dataclass
class UpperTree:
    """Median splits of the projected space; leaves are numbered from 0 and have boxes."""

    axes: np.ndarray
    values: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, levels: int) -> UpperTree:
        n, m = (1 << levels) - 1, points.shape[1]
        axes, values = np.zeros(n, np.int64), np.zeros(n)
        groups = {0: points}
        boxes = {0: (np.full(m, -np.inf), np.full(m, np.inf))}
        for node in range(n):
            group, (low, high) = groups.pop(node), boxes.pop(node)
            axis = int(np.argmax(group.var(0))) if len(group) else 0
            value = float(np.median(group[:, axis])) if len(group) else 0.0
            axes[node], values[node] = axis, value
            right = group[:, axis] > value
            left_high, right_low = high.copy(), low.copy()
            left_high[axis] = min(high[axis], value)
            right_low[axis] = max(low[axis], value)
            groups[2 * node + 1], groups[2 * node + 2] = group[~right], group[right]
            boxes[2 * node + 1], boxes[2 * node + 2] = (low, left_high), (right_low, high)
        leaves = [boxes[i] for i in range(n, 2 * n + 1)]
        return cls(axes, values, np.array([b[0] for b in leaves]), np.array([b[1] for b in leaves]))

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        while len(at) and at[0] < len(self.axes):
            at = 2 * at + 1 + (points[np.arange(len(at)), self.axes[at]] > self.values[at])
        return at - len(self.axes)

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distances of a point to the boxes of all cells."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        return (gap**2).sum(1)


class BlockTree:
    """A kd-tree over the projected vectors of a block, rows in the order of its leaves."""

    def __init__(self, points: np.ndarray):
        pieces, leaves = [np.arange(len(points))], []
        while pieces:
            rows = pieces.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            axis = int(np.argmax(np.ptp(points[rows], axis=0)))
            order = np.argpartition(points[rows, axis], len(rows) // 2)
            pieces += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.order = np.concatenate(leaves)
        ends = np.cumsum([len(r) for r in leaves])
        self.starts, self.ends = ends - [len(r) for r in leaves], ends
        self.points = points[self.order]
        self.low = np.minimum.reduceat(self.points, self.starts)
        self.high = np.maximum.reduceat(self.points, self.starts)

        self.leaf = np.repeat(np.arange(len(leaves)), self.ends - self.starts)
        self.squares = (self.points**2).sum(1)

    def distances(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each point to the boxes of all leaves, and to all rows in leaf order."""
        gap = np.maximum(np.maximum(self.low - points[:, None], points[:, None] - self.high), 0.0)
        rows = self.squares + (points**2).sum(1)[:, None] - 2 * points @ self.points.T
        return (gap**2).sum(2), np.maximum(rows, 0.0)

    def portions(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves by distance in growing portions: the least distance of each portion, and the
        portion of each row. All of a portion's and later distances are at least the least one."""
        order = np.argsort(near, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        portion = np.log2(rank / FIRST_LEAVES + 1).astype(np.int8)  # 4 leaves, 8, 16, ...
        starts = FIRST_LEAVES * ((1 << np.arange(portion.max() + 1)) - 1)
        return near[order[starts]], portion[self.leaf]


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products whose value depends on the two vectors only, not on their place."""
    return (x * q).sum(axis=1)


def search_block(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, projection: Projection, k: int, test: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The k best of a block for each query, nearest first. `bounds` are squared distances, in
    the lifted space, within which a query has k vectors already."""
    tree = BlockTree(projection.vectors(x))
    ids, x = ids[tree.order], x[tree.order]
    scaled, points = projection.scaled(q), projection.queries(q)
    for at in range(0, len(q), QUERIES_AT_ONCE):
        some = slice(at, at + QUERIES_AT_ONCE)
        near, far = tree.distances(points[some])
        # Many rows of a block are verified for some query: their products are taken together.
        together = scaled[some] @ x.T if (far <= test * bounds[some, None]).mean() > SPARSE else None
        for r in range(at, min(at + QUERIES_AT_ONCE, len(q))):
            best_rows, best = np.zeros(0, np.int64), np.zeros(0)
            bound, distance = bounds[r], far[r - at]
            least, portion = tree.portions(near[r - at])
            for p, nearest in enumerate(least.tolist()):
                if nearest > test * bound:
                    break
                rows = np.flatnonzero((portion == p) & (distance <= test * bound) & (ids != query_ids[r]))
                if len(rows) == 0:
                    continue
                best_rows = np.concatenate([best_rows, rows])
                best = np.concatenate([best, x[rows] @ scaled[r] if together is None else together[r - at, rows]])
                if len(best) >= k:
                    kth = np.partition(best, len(best) - k)[len(best) - k]
                    keep = best >= kth - 1e-9 * projection.longest**2  # ties are kept for the exact order
                    best_rows, best = best_rows[keep], best[keep]
                    bound = min(bound, max(0.0, 2 * projection.longest**2 - 2 * kth) * (1 + 1e-9))
            score = _exact(x[best_rows], q[r])
            order = np.lexsort((ids[best_rows], -score))[:k]
            yield r, ids[best_rows][order], score[order]


def compare_block(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The k best of a block for each query, by comparison with all; for lengths that have no index."""
    for r in range(len(q)):
        rows = np.flatnonzero(ids != query_ids[r])
        score = _exact(x[rows], q[r])
        order = np.lexsort((ids[rows], -score))[:k]
        yield r, ids[rows][order], score[order]


_FOUND = "query_id bigint, vec_id bigint, score double"


def _searched(rows: DataFrame, projection: Projection, k: int, test: float) -> DataFrame:
    """Search of `rows` (`block, part, is_query, vec_id, bound, embedding`), sorted by block."""
    shared = rows.sparkSession.sparkContext.broadcast(projection)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_groups(batches, 3):
            asks = np.asarray(block.column("is_query")) == 1
            if asks.all() or not asks.any():
                continue
            x = matrix(block.column("embedding").combine_chunks())
            ids, bounds = np.asarray(block.column("vec_id")), np.asarray(block.column("bound"))
            if block.column("cell")[0].as_py() < 0:
                found = compare_block(ids[~asks], x[~asks], ids[asks], x[asks], k)
            else:
                found = search_block(ids[~asks], x[~asks], ids[asks], x[asks], bounds[asks], shared.value, k, test)
            parts = [(np.full(len(i), ids[asks][r]), i, s) for r, i, s in found if len(i)]
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[c] for p in parts])) for c in range(3)], names=["query_id", "vec_id", "score"]
                )

    keys = ["cell", "part", "group"]
    columns = [*keys, "is_query", "vec_id", "bound", "embedding"]
    together = rows.select(*columns).repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(search, _FOUND)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    confidence: float = CONFIDENCE,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """`query_id, rank, vec_id, score` for the rows of `vectors` (`vec_id, embedding`) that
    `is_query`, a condition on `vec_id`, selects; candidates are all rows but the query's own."""
    valid = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).filter(F.col("vec_id").isNotNull() & is_valid(F.col("embedding")))
    rows = staged(valid.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    length = usual_length(rows)
    empty = rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if length == 0:
        return empty
    others = rows.filter(F.size("embedding") != length)
    rows = rows.filter(F.size("embedding") == length)
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = rows.agg(F.count("*"), F.sqrt(F.max(square))).first()
    projection = Projection.of(longest * (1 + 1e-12), length, DIRECTIONS)
    test = chi_square_quantile(confidence, DIRECTIONS)

    sample = rows.select("embedding").orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).toArrow()
    levels = max(0, min(int(math.log2(MOST_CELLS)), math.ceil(math.log2(max(1, n / rows_per_block)))))
    upper = UpperTree.fit(projection.vectors(matrix(sample.column(0).combine_chunks())), levels)
    shared = rows.sparkSession.sparkContext.broadcast((projection, upper))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tree = shared.value
        for batch in batches:
            if batch.num_rows:
                cells = tree.cells(own.vectors(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], names=["vec_id", "embedding", "cell"])

    indexed = staged(rows.mapInArrow(place, "vec_id bigint, embedding array<double>, cell int"), "indexed")
    counts = dict(indexed.groupBy("cell").count().collect())  # `MOST_CELLS` rows at most
    parts = [max(1, math.ceil(counts.get(c, 0) / rows_per_block)) for c in range(len(upper.low))]
    parts_of = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("cell") + 1)
    indexed = indexed.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "vec_id"), parts_of).cast("int"))
    queries = indexed.filter(is_query)
    groups = max(1, math.ceil(queries.count() / QUERIES_PER_BLOCK))
    group = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(groups)).cast("int")
    infinite = F.lit(float("inf"))
    asked = queries.withColumn("group", group)
    offered = indexed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumns(
        {"is_query": F.lit(0), "bound": infinite}
    )
    home = asked.withColumns({"is_query": F.lit(1), "bound": infinite})
    first = staged(_searched(offered.unionByName(home), projection, k, test), "first")

    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    norm = F.sqrt(square)
    bound = F.when(
        F.col("n") >= k, F.greatest(F.lit(0.0), 2 * longest * longest - 2 * F.col("score") * longest / norm) * (1 + 1e-9)
    ).otherwise(infinite)
    bounded = asked.join(kth, asked["vec_id"] == kth["query_id"], "left").select(
        "vec_id", "embedding", "cell", "part", "group", F.coalesce(bound, infinite).alias("bound")
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to the blocks that pass the test, but for the one it has been in."""
        own, tree = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                points = own.queries(matrix(batch.column(1)))
                bounds, cells, done = (np.asarray(batch.column(i)) for i in (5, 2, 3))
                owner, to_cell, to_part = [], [], []
                for r, point in enumerate(points):
                    for c in np.flatnonzero(tree.distances(point) <= test * bounds[r]).tolist():
                        for p in range(parts[c]):
                            if (c, p) != (cells[r], done[r]):
                                owner.append(r)
                                to_cell.append(c)
                                to_part.append(p)
                at_rows = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to_cell, pa.int32()),
                        pa.array(to_part, pa.int32()),
                        *[batch.column(i).take(at_rows) for i in (4, 0, 5, 1)],
                    ],
                    names=["cell", "part", "group", "vec_id", "bound", "embedding"],
                )

    sent = bounded.mapInArrow(
        spread, "cell int, part int, group int, vec_id bigint, bound double, embedding array<double>"
    ).withColumn("is_query", F.lit(1))
    # Other lengths: blocks that all queries of the length visit.
    d = F.size("embedding").alias("d")
    counts_of = others.groupBy(d).agg(F.ceil(F.count("*") / F.lit(float(rows_per_block))).cast("int").alias("parts"))
    sized = others.withColumn("d", d).join(counts_of, "d").withColumns({"cell": -F.col("d"), "bound": infinite})
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    blocks = sized.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col("parts")).cast("int"))
    blocks = blocks.withColumns({"group": every(F.lit(groups)), "is_query": F.lit(0)})
    asking = sized.filter(is_query).withColumns({"group": group, "is_query": F.lit(1)}).withColumn("part", every(F.col("parts")))
    columns = ["cell", "part", "group", "is_query", "vec_id", "bound", "embedding"]
    met = [f.select(*columns) for f in (offered, sent, blocks, asking)]
    second = _searched(reduce(DataFrame.unionAll, met), projection, k, test)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(second).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
