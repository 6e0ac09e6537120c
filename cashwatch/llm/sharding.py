"""Balanced label propagation: documents with equal texts drift to common shards.

Every document starts in a random shard. In each round the members of a group of equal
texts look at where the group's other members are and ask to move to the group's largest
shards; a shard accepts movers, in random order, up to its quota. A group larger than a
shard asks for as many shards as it fills. At last documents without links fill the room
that is left, so that shard counts differ by one at most (the law `rows`).

Defined cases: a null text counts as an empty one; null and repeated ids are rows like any
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cashwatch.llm.common import key_range, staged, with_rank

ROUNDS = 3
_GROUP = ["g1", "g2"]


def _items(docs: DataFrame, shards: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(1), text).alias("g1"),
        F.xxhash64(F.lit(2), text).alias("g2"),
        F.monotonically_increasing_id().alias("row"),
    )
    start = F.pmod(F.xxhash64(F.lit(3), "doc_id", "row"), F.lit(shards)).cast("int")
    return staged(rows.withColumn("shard", start), "shard-items")


def _round(members: DataFrame, shards: int, capacity: int) -> DataFrame:
    """One round: `members` with `row, g1, g2, members, shard`, moved."""
    here = members.groupBy(*_GROUP, "members", "shard").agg(F.count("*").alias("here"))
    largest = Window.partitionBy(*_GROUP).orderBy(F.col("here").desc(), F.xxhash64(*_GROUP, "shard"))
    wanted = F.ceil(F.col("members") / F.lit(float(capacity))).cast("int")
    ranked = here.withColumn("place", F.row_number().over(largest) - 1).withColumn(
        "wanted", F.least(wanted, F.count("*").over(Window.partitionBy(*_GROUP)).cast("int"))
    )
    shard_of_place = ranked.filter("place < wanted").select(*_GROUP, "place", F.col("shard").alias("goal"))
    standing = ranked.select(*_GROUP, "shard", (F.col("place") < F.col("wanted")).alias("stays"), "wanted")

    asked = members.join(standing, [*_GROUP, "shard"]).withColumn(
        "place", F.when(~F.col("stays"), F.pmod(F.xxhash64(F.lit(4), "row"), F.col("wanted")).cast("int"))
    )
    asked = asked.join(shard_of_place, [*_GROUP, "place"], "left")

    # Small groups ask as a whole; the members of a group that is large for a shard ask one by one.
    large = F.col("members") * 64 > F.lit(capacity)
    turn = key_range(F.when(large, F.xxhash64(F.lit(5), "row")).otherwise(F.xxhash64(F.lit(5), *_GROUP)))
    asked = asked.withColumn("turn", turn)
    stay = asked.filter("stays").groupBy(F.col("shard").alias("goal")).agg(F.count("*").alias("kept"))
    movers = asked.filter("NOT stays").groupBy("goal", "turn").agg(F.count("*").alias("movers"))
    upto = Window.partitionBy("goal").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    accepted = (
        movers.withColumn("upto", F.sum("movers").over(upto))
        .join(stay, "goal", "left")
        .filter(F.col("upto") + F.coalesce("kept", F.lit(0)) <= F.lit(capacity))
        .select("goal", "turn", F.lit(True).alias("accepted"))
    )
    moved = asked.join(accepted, ["goal", "turn"], "left")
    shard = F.when(F.col("accepted"), F.col("goal")).otherwise(F.col("shard"))
    return moved.select("row", *_GROUP, "members", shard.alias("shard"))


def balanced_shards(docs: DataFrame, shards: int = 24, rounds: int = ROUNDS) -> DataFrame:
    """`doc_id, size, text_crc32, g1, g2, shard, slot` of every document of `docs`
    (`doc_id, text`); slots number the rows of a shard from 0 without gaps.

    Only one number per shard comes to the driver: how many rows it keeps.
    """
    items = _items(docs, shards)
    total = items.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    capacity = max(1, total // shards)

    groups = items.groupBy(*_GROUP).agg(F.count("*").alias("members")).filter("members > 1")
    members = staged(items.join(groups, _GROUP).select("row", *_GROUP, "members", "shard"), "shard-0")
    for i in range(rounds):
        members = staged(_round(members, shards, capacity), f"shard-{i + 1}")

    large = F.col("members") * 64 > F.lit(capacity)
    order = F.when(large, F.xxhash64(F.lit(6), "row")).otherwise(F.xxhash64(F.lit(6), *_GROUP))
    ranked = with_rank(members.withColumn("_order", order), "_order", "row", ["shard"])
    room = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("shard") + 1)
    kept = staged(ranked.filter(F.col("rank") < room).select("row", "shard", F.col("rank").alias("slot")), "shard-kept")

    stays = {r["shard"]: r["count"] for r in kept.groupBy("shard").count().collect()}  # a row per shard
    left = [q - stays.get(s, 0) for s, q in enumerate(quota)]
    ends = [sum(left[: s + 1]) for s in range(shards)]
    starts = F.array(*[F.lit(e - n) for e, n in zip(ends, left)])
    kept_in = F.array(*[F.lit(stays.get(s, 0)) for s in range(shards)])

    others = items.select("row").join(kept.select("row"), "row", "left_anti")
    placed = with_rank(others.withColumn("_order", F.xxhash64(F.lit(7), "row")), "_order", "row")
    passed = F.filter(F.array(*[F.lit(e) for e in ends]), lambda end: end <= F.col("rank"))
    filled = placed.withColumn("shard", F.size(passed)).select(
        "row",
        "shard",
        (F.col("rank") - F.element_at(starts, F.col("shard") + 1) + F.element_at(kept_in, F.col("shard") + 1)).alias("slot"),
    )
    seat = kept.unionByName(filled)
    return items.drop("shard").join(seat, "row").select(
        "doc_id", "size", "text_crc32", *_GROUP, "shard", F.col("slot").cast("long").alias("slot")
    )
