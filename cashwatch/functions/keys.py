"""Stable per-row assignments and surrogate keys, independent of the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

def hash_assign(columns: Sequence[Column], groups: int, salt: str = "") -> Column:
    """Group number 0..groups-1 of a row. Give each attribute its own `salt`:
    one hash used twice makes the two attributes follow each other."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(groups))


def key_assign(key: Column, groups: int) -> Column:
    """Group number 0..groups-1 of an integer key by remainder: any engine finds the same one."""
    return F.pmod(key, F.lit(groups))


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """`prefix` plus the number, zero-padded to at least `width`. Longer numbers are
    kept whole; a plain `lpad` would cut them and make keys collide."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))
