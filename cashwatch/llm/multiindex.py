"""Embedding near-duplicates with an inverted multi-index.

Vectors are scaled to length one and cut in halves. Each half has a codebook of its own, fitted
by k-means on a bounded sample; the pairs of codewords form a grid of cells. A vector lies in
the cell of its nearest codewords and visits cells in the order of their distance, by traversal
of two sorted sequences (multi-sequence). The distance of a cell is how far the vector would
have to move, in both halves, to fall into it. The traversal stops beyond the distance within
which `target_recall` of all moves of the threshold's length, in random directions, end: a
neighbour farther inside is found the more surely, and each pair is sought from both sides.
Visitors and members of a cell are then compared exactly.

Equal vectors are collapsed before and counted; of numbers (vectors of length one) those of one
sign. Full cells and crowds of visitors are cut into parts that meet pairwise, so no block grows
with the data. Vectors of different lengths have no cosine: each length that is held by more than
`FEW` different vectors has a grid of its own, any other is one cell.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing and form components of their own, and so does a length that no other vector has; repeated
ids are rows of their own; a component's id is its smallest id that is not null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from cashwatch.llm.common import discard, staged, work_on
from cashwatch.llm.components import connected_components
from cashwatch.llm.vectors import is_valid, matrix, row_groups

SAMPLE_ROWS = 8192  # vectors that the codebooks are fitted on, at most
ROWS_PER_CELL = 1024
MOST_CODEWORDS = 256  # of a half; the grid has the square of it at most
TARGET_RECALL = 0.999
MEMBERS, VISITORS = 1024, 4096  # of a block
FEW = 4096  # vectors of one length that need no grid


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, turns: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(turns):
        near = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        for j in range(k):
            if (near == j).any():
                centres[j] = x[near == j].mean(0)
    return centres


@dataclass
class Grid:
    """Two codebooks and the squared distance at which the traversal stops."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    @classmethod
    def fit(cls, sample: np.ndarray, k: int, threshold: float, target_recall: float) -> Grid:
        rng = np.random.default_rng(5)
        half = sample.shape[1] // 2
        grid = cls(_codebook(sample[:, :half], k, rng), _codebook(sample[:, half:], k, rng), np.inf)
        # Move each sample vector by the threshold's angle in a random direction.
        turn = rng.normal(size=sample.shape)
        turn -= (turn * sample).sum(1, keepdims=True) * sample
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-300)
        moved = threshold * sample + np.sqrt(max(0.0, 1 - threshold**2)) * turn
        a, b = grid.distances(sample)
        i, j = grid.homes(moved)
        rows = np.arange(len(sample))
        grid.reach = float(np.quantile(a[rows, i] + b[rows, j], target_recall))
        return grid

    def _halves(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        half = self.first.shape[1]
        return [(x[:, :half], self.first), (x[:, half:], self.second)]

    def homes(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.argmin((c**2).sum(1) - 2 * h @ c.T, axis=1) for h, c in self._halves(x)]

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half the squared distance to the border that parts the nearest codeword's
        region from every other codeword's."""
        out = []
        for h, c in self._halves(x):
            d = (c**2).sum(1) - 2 * h @ c.T
            home = np.argmin(d, axis=1)
            apart = np.linalg.norm(c[home][:, None, :] - c[None, :, :], axis=2)
            border = (d - d.min(1, keepdims=True)) / (2 * np.maximum(apart, 1e-12))
            out.append(border**2)
        return out

    def visits(self, x: np.ndarray) -> Iterator[list[int]]:
        """Cells in the order of distance, the own one first, up to the reach."""
        k = len(self.second)
        a, b = self.distances(x)
        order_a, order_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        for row in range(len(x)):
            u, v = a[row][order_a[row]].tolist(), b[row][order_b[row]].tolist()
            names_a, names_b = order_a[row].tolist(), order_b[row].tolist()
            heap, out = [(u[0] + v[0], 0, 0)], []
            while heap:
                d, i, j = heapq.heappop(heap)
                if out and d > self.reach:
                    break
                out.append(names_a[i] * k + names_b[j])
                if j + 1 < len(v):
                    heapq.heappush(heap, (u[i] + v[j + 1], i, j + 1))
                if j == 0 and i + 1 < len(u):
                    heapq.heappush(heap, (u[i + 1] + v[0], i + 1, 0))
            yield out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Cells:
    """Numbers of the cells of all lengths: a range for each grid, one for each other length."""

    grids: dict[int, Grid]
    first: dict[int, int]  # of the cells of a length
    count: int

    @classmethod
    def of(cls, lengths: list[int], grids: dict[int, Grid]) -> Cells:
        first, n = {}, 0
        for d in lengths:
            first[d] = n
            n += len(grids[d].first) * len(grids[d].second) if d in grids else 1
        return cls(grids, first, n)

    def visits(self, column: pa.Array) -> list[list[int]]:
        """Cells that each vector visits, its own first."""
        lengths = np.diff(np.asarray(column.offsets))
        out: list[list[int]] = [[]] * len(column)
        for d in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == d)
            if d in self.grids:
                x = _unit(matrix(column.take(pa.array(rows))))
                for r, seen in zip(rows.tolist(), self.grids[d].visits(x)):
                    out[r] = [self.first[d] + c for c in seen]
            else:
                for r in rows.tolist():
                    out[r] = [self.first[d]]
        return out


def _visits(distinct: DataFrame, cells: Cells) -> DataFrame:
    """A row for each vector and cell it visits; `seat` 0 marks the own cell and has the list of all.

    Rows are thin: the vectors themselves go to the blocks from the table they are in.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(cells)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                seen = shared.value.visits(pa.concat_arrays([batch.column(1)]))
                owner = pa.array(np.repeat(np.arange(len(seen)), [len(s) for s in seen]))
                lists = [s if i == 0 else None for s in seen for i in range(len(s))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for s in seen for c in s], pa.int64()),
                        pa.array([i for s in seen for i in range(len(s))], pa.int32()),
                        pa.array([s[0] for s in seen], pa.int64()).take(owner),
                        pa.array(lists, pa.list_(pa.int64())),
                        batch.column(0).take(owner),
                    ],
                    names=["cell", "seat", "home", "cells", "node"],
                )

    schema = "cell bigint, seat int, home bigint, cells array<bigint>, node bigint"
    return staged(distinct.select("node", "embedding").mapInArrow(visit, schema), "visits")


def _grids(distinct: DataFrame, rows_per_cell: int, threshold: float, target_recall: float) -> Cells:
    """Grids fitted on a bounded sample, shared among the lengths that need one."""
    counts = distinct.groupBy(F.size("embedding").alias("d")).count().collect()  # a row per length
    large = {r.d: r["count"] for r in counts if r["count"] > FEW and r.d > 1}
    grids = {}
    for d, n in sorted(large.items()):
        k = int(np.clip(np.ceil(np.sqrt(n / rows_per_cell)), 2, MOST_CODEWORDS))
        own = distinct.filter(F.size("embedding") == d).select(F.col("embedding").cast("array<double>").alias("embedding"), "h1", "h2")
        rows = max(k, SAMPLE_ROWS // len(large))
        sample = own.orderBy(F.xxhash64("h1", "h2")).limit(rows).select("embedding").toArrow()
        grids[d] = Grid.fit(_unit(matrix(sample.column(0).combine_chunks())), k, threshold, target_recall)
    return Cells.of(sorted(r.d for r in counts), grids)


def _links(block: pa.Table, threshold: float, cells: int) -> pa.RecordBatch | None:
    """`node, links, root`: what a block adds to a vector's links, and a vector connected with it."""
    side = np.asarray(block.column("member"))
    nodes, copies, homes = (np.asarray(block.column(c)) for c in ("node", "copies", "home"))
    x = _unit(matrix(block.column("embedding").combine_chunks()))
    m, p = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
    if len(m) == 0 or len(p) == 0:
        return None
    i, j = np.nonzero(x[p] @ x[m].T >= threshold)
    i, j = p[i], m[j]
    other = nodes[i] != nodes[j]
    i, j = i[other], j[other]
    if len(i) == 0:
        return None
    # A pair that the member finds too, as a visitor of the other's cell, counts there for it.
    visited = pc.fill_null(block.column("cells").combine_chunks(), [])
    width = np.asarray(pc.list_value_length(visited))
    codes = np.repeat(np.arange(len(side)), width) * cells + np.asarray(visited.flatten())
    mutual = np.isin(j * cells + homes[i], codes)
    links = np.zeros(len(side), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j[~mutual], copies[i[~mutual]])
    _, at = np.unique(nodes, return_inverse=True)
    root = np.full(at.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(root, at, nodes)
    while True:
        low = np.minimum(root[at[i]], root[at[j]])
        before = root.copy()
        np.minimum.at(root, at[i], low)
        np.minimum.at(root, at[j], low)
        if (root == before).all():
            break
    used = (links > 0) | (root[at] != nodes)
    return pa.RecordBatch.from_pydict({"node": nodes[used], "links": links[used], "root": root[at][used]})


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    target_recall: float = TARGET_RECALL,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row of `vectors` (`vec_id, embedding`)."""
    with work_on(vectors.sparkSession, "multiindex") as work:
        whole = work.keep(_linked(vectors, threshold, target_recall, rows_per_cell))
    least = whole.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return whole.join(least, "component").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _linked(vectors: DataFrame, threshold: float, target_recall: float, rows_per_cell: int) -> DataFrame:
    """`row, vec_id, n_links, component` of every row, written."""
    real = isinstance(vectors.schema["embedding"].dataType.elementType, (FloatType, DoubleType))
    embedding = F.col("embedding") if real else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", embedding.alias("embedding"))
    # The cosine of two numbers is that of their signs.
    sign = F.transform("embedding", lambda x: F.signum(x).cast(rows.schema["embedding"].dataType.elementType))
    rows = rows.withColumn("embedding", F.when(F.size("embedding") == 1, sign).otherwise(F.col("embedding")))
    rows = rows.withColumn("valid", is_valid(F.col("embedding")))
    rows = staged(
        rows.withColumns({f"h{i}": F.when(F.col("valid"), F.xxhash64(F.lit(i), "embedding")) for i in (1, 2)}), "vectors"
    )
    usable = rows.filter("valid")
    distinct = staged(
        usable.groupBy("h1", "h2").agg(
            F.min("row").alias("node"), F.count("*").alias("copies"), F.min("embedding").alias("embedding")
        ),
        "distinct",
    )
    grid = _grids(distinct, rows_per_cell, threshold, target_recall)
    visits = _visits(distinct, grid)
    sizes = visits.groupBy("cell").agg(
        F.ceil(F.count_if(F.col("seat") == 0) / F.lit(float(MEMBERS))).cast("int").alias("m_parts"),
        F.ceil(F.count("*") / F.lit(float(VISITORS))).cast("int").alias("v_parts"),
    )
    placed = visits.join(sizes, "cell").filter("m_parts > 0")
    own = lambda parts, salt: F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    members = placed.filter("seat = 0").select("cell", own("m_parts", 1).alias("mp"), each("v_parts").alias("vp"), F.lit(1).alias("member"), "home", "cells", "node")
    no_list = F.lit(None).cast("array<bigint>").alias("cells")
    visitors = placed.select("cell", each("m_parts").alias("mp"), own("v_parts", 2).alias("vp"), F.lit(0).alias("member"), "home", no_list, "node")
    keys = ["cell", "mp", "vp"]
    seats = members.unionByName(visitors).join(distinct.select("node", "copies", "embedding"), "node")
    columns = [*keys, "member", "home", "cells", "node", "copies", "embedding"]
    blocks = seats.select(*columns).repartition(*keys).sortWithinPartitions(*keys)
    cells = grid.count

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_groups(batches, 3):
            found = _links(block, threshold, cells)
            if found is not None:
                yield found

    found = staged(blocks.mapInArrow(link, "node bigint, links bigint, root bigint"), "links")
    discard(visits)
    components = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_vector = distinct.select("h1", "h2", "node", "copies").join(counts, "node", "left").join(components, "node", "left")
    per_vector = per_vector.select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    joined = usable.select("row", "vec_id", "h1", "h2").join(per_vector, ["h1", "h2"]).select("row", "vec_id", "n_links", "component")
    alone = rows.filter("NOT valid").select("row", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("row").alias("component"))
    return staged(joined.unionByName(alone), "linked")
