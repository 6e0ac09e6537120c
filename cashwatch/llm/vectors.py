"""What the two vector operators share: valid vectors, Arrow columns as matrices, row groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def is_valid(embedding: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(
        embedding.isNotNull() & F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False)
    )


def usual_length(valid: DataFrame) -> int:
    """The most common length; vectors of another length cannot be compared and take no part."""
    found = valid.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return int(found["d"]) if found else 0


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix of doubles."""
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1)


def row_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first `keys` columns, of batches sorted by them."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [np.asarray(batch.column(i)) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            key = tuple(c[start] for c in columns)
            if key != held_key and held:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
