"""Joins that split a key which one task could not hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

PARTS = 1000


def hot_keys(df: DataFrame, keys: Sequence[str], least_rows: int, parts: int = PARTS) -> DataFrame:
    """Keys that hold more than `least_rows` rows and more than one in `parts` of all, with `_salts`,
    the number of pieces of that size. There are fewer than `parts` of them, however large `df` is.

    Partial counts leave one row per key and task before the shuffle.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    size = F.greatest(F.lit(least_rows), F.ceil(counts.agg(F.sum("_rows")).scalar() / F.lit(float(parts))))
    return counts.filter(F.col("_rows") > size).select(*keys, F.ceil(F.col("_rows") / size).cast("long").alias("_salts"))


def left_join_split(
    left: DataFrame, right: DataFrame, keys: Sequence[str], least_rows: int = 100_000, parts: int = PARTS
) -> DataFrame:
    """`left.join(right, keys, "left")` with a right key of any number of rows.

    Adaptive execution splits the left side of a left join only. Here the rows of a hot right key
    are dealt to as many pieces as its measured count asks for, and the few left rows of that key
    go to each piece. A hot key has a match by definition, so that part is an inner join; all other
    rows take the plain left join. A key is hot beyond `least_rows` rows and one in `parts`
    of all; so there are fewer than `parts` hot keys, and only these are broadcast.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(right, keys, least_rows, parts))
    piece = F.pmod(F.monotonically_increasing_id(), F.col("_salts")).alias("_piece")
    # Ids count the rows of a task, so that equal rows are dealt out too.
    dealt = right.join(hot, keys).select(*right.columns, piece)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_piece")
    repeated = left.join(hot, keys).select(*left.columns, every)
    plain = left.join(hot, keys, "left_anti").join(right.join(hot, keys, "left_anti"), keys, "left")
    split = repeated.join(dealt, [*keys, "_piece"]).drop("_piece")
    return plain.unionByName(split)
