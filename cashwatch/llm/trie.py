"""Prefix trie of conversations by vertical bitmaps.

Conversations lie in blocks (the shards of the index). A block maps each (position, turn) to the
bitset of its conversations that have this turn there. From the bitset of a node, the turn of its
smallest remaining conversation selects a posting; the intersection of both is a child, and goes
on depth first. Popcounts are members, lowest bits the smallest members, and the bits that stop
at a depth the node's list of ends. Nodes of all blocks are then summed up by their key, the
exclusive or of a 128-bit hash of every (position, turn) on the path.

What a subtree holds is a sum over members. The smallest member of a node represents it, and
represents every node below on its own path too, so a conversation has one depth from which on it
represents. A first pass over the blocks finds these depths; in the second, with
`r` the depth of a member, a node at depth d has as many children as members with r <= d + 1 that
go on, as many leaves as members that represent one, and saves the lengths of its members' turns
from d to r - 1.

A conversation is cut into segments of `SEGMENT` turns, each with the key of the path before it,
so no row and no block grows with the longest conversation. Ids of ends are hashed in numeric
order: sorted and joined by ranges of 65,536 ids, and the ranges of a node follow each other
through one digest, so a node that ends a large part of all conversations is never one list.

Defined cases: rows without conv_id take no part; null turns come first; rows of a conversation
with the same turn are ordered by a digest of role and text, and repeated rows are turns of their
own; null role or text is empty; conversations whose rebuilt form has no turn end at the root; an
empty table has no node, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cashwatch.llm.common import discard, staged, work_on

SEGMENT = 512  # turns of a conversation in one row
BLOCK_TURNS = 100_000  # turns of a block; it holds whole segments
BLOCK_ROWS = 8192  # bits of a block's bitsets
TURNS_SHIFT = 12  # turn numbers of one conversation are ranked by ranges of 4,096
IDS_SHIFT = 16  # ids of one node's ends are sorted by ranges of 65,536
FAMILY, MOST_SHARED = 100, 6  # conversations that share a first one, and a bound of the turns they share
NEVER = 2**62

_NODE = (
    "ka bigint, kb bigint, pa bigint, pb bigint, depth bigint, conv bigint, r bigint, n bigint, n_ends bigint, "
    "children bigint, leaves bigint, saved bigint, ends array<bigint>"
)


def ordered_turns(df: DataFrame) -> DataFrame:
    """`conv, p, digest, len`: position (from 1), digest and code points of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        digest.alias("digest"),
        F.length(text).cast("long").alias("len"),
        F.coalesce(F.shiftright(F.col("turn").cast("long"), TURNS_SHIFT), F.lit(-(2**62))).alias("range"),
    )
    counts = turns.groupBy("conv", "range").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.sum("rows").over(earlier)).filter("before > 0").drop("rows")
    inside = Window.partitionBy("conv", "range").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = turns.withColumn("p", F.row_number().over(inside).cast("long")).join(before, ["conv", "range"], "left")
    return placed.select("conv", (F.col("p") + F.coalesce("before", F.lit(0))).alias("p"), "digest", "len")


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first one of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of `ordered_turns`: all conversations, `conv, h, shared, n`, and their rebuilt turns.

    `h` turns are asked of the family's first conversation, `shared` are there; `n` is the length.
    """
    first = (
        turns.filter((F.col("conv") % FAMILY == 0) & (F.col("p") < MOST_SHARED))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("p", "digest", "len"))).alias("first"))
    )
    convs = (
        turns.groupBy("conv")
        .agg(F.max("p").alias("own"))
        .withColumn("h", shared_turns(F.col("conv")))
        .withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
        .join(first, "base", "left")
        .withColumn("first", F.filter("first", lambda t: t["p"] <= F.col("h")))
        .withColumn("shared", F.coalesce(F.array_size("first").cast("long"), F.lit(0)))
        .withColumn("n", F.col("shared") + F.greatest(F.lit(0), F.col("own") - F.col("h")))
    )
    head = convs.select("conv", F.explode("first").alias("t")).select("conv", "t.p", "t.digest", "t.len")
    rest = (
        turns.filter(F.col("p") > shared_turns(F.col("conv")))
        .join(convs.select("conv", "h", "shared"), "conv")
        .select("conv", (F.col("p") - F.col("h") + F.col("shared")).alias("p"), "digest", "len")
    )
    return convs.select("conv", "h", "shared", "n"), head.unionByName(rest)


def segments(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Rows `conv, seg, last, turns (array of p, a, b, len), xa, xb`; a turnless conversation has one empty one.

    Families lie together, so that what they share is summed up before it is shuffled.
    """
    seg = F.shiftright(F.col("p") - 1, SEGMENT.bit_length() - 1).cast("long")
    base = F.col("conv") - F.col("conv") % FAMILY
    hashed = turns.select(
        "conv",
        base.alias("base"),
        seg.alias("seg"),
        "p",
        "len",
        *[F.xxhash64(F.lit(salt), "p", "digest").alias(name) for salt, name in (("first", "a"), ("second", "b"))],
    )
    bare = convs.filter("n = 0").select(
        "conv", base.alias("base"), F.lit(0).cast("long").alias("seg"),
        *[F.lit(None).cast("long").alias(c) for c in ("p", "len", "a", "b")],
    )
    known = F.when(F.col("p").isNotNull(), F.struct("p", "a", "b", "len"))
    return (
        hashed.unionByName(bare)
        .repartition("base", "seg")
        .groupBy("base", "seg", "conv")
        .agg(
            F.sort_array(F.collect_list(known)).alias("turns"),
            F.coalesce(F.bit_xor("a"), F.lit(0)).alias("xa"),
            F.coalesce(F.bit_xor("b"), F.lit(0)).alias("xb"),
        )
        .sortWithinPartitions("base", "seg", "conv")
        .drop("base")
    )


def _with_starts(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Add `sa, sb`, the key of the path before a segment, and `last`. Few conversations have several."""
    last = convs.filter(F.col("n") > SEGMENT).select(
        "conv", F.shiftright(F.col("n") - 1, SEGMENT.bit_length() - 1).cast("long").alias("last_seg")
    )
    earlier = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.select("conv", "seg", "xa", "xb")
        .join(last, "conv")
        .select(
            "conv",
            "seg",
            (F.col("seg") == F.col("last_seg")).alias("last"),
            *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(s) for x, s in (("xa", "sa"), ("xb", "sb"))],
        )
    )
    return rows.drop("xa", "xb").join(starts, ["conv", "seg"], "left").withColumns(
        {
            "last": F.coalesce("last", F.lit(True)),
            "sa": F.coalesce("sa", F.lit(0).cast("long")),
            "sb": F.coalesce("sb", F.lit(0).cast("long")),
        }
    )


@dataclass
class Row:
    """One segment: its conversation, first depth, key before it, turns, and what is known of it."""

    conv: int
    depth: int
    key: tuple[int, int]
    turns: list[tuple[int, int, int]]  # a, b, length
    last: bool
    r: int = NEVER
    leaf: bool = False
    carry: int = 0  # saved by the segments behind this one


@dataclass
class Node:
    key: tuple[int, int]
    parent: tuple[int, int]
    depth: int
    conv: int
    r: int
    n: int
    ends: list[int] = field(default_factory=list)
    children: int = 0
    leaves: int = 0
    saved: int = 0
    above: int = -1  # index of the parent in the block


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def block_nodes(rows: list[Row]) -> list[Node]:
    """The nodes of a block, parents first; sums are over the block's own members."""
    rows = sorted(rows, key=lambda x: x.conv)  # bits in order of ids: the lowest is the smallest
    postings: dict[tuple[int, int, int], int] = defaultdict(int)
    stops: dict[int, int] = defaultdict(int)  # depth -> rows that have no turn beyond it here
    starts: dict[tuple[int, int, int], int] = defaultdict(int)
    represents: dict[int, int] = defaultdict(int)  # depth -> rows that represent from it on
    over = leaves = 0  # rows whose conversation ends with them, rows that represent a leaf
    for i, row in enumerate(rows):
        bit = 1 << i
        starts[(row.depth, *row.key)] |= bit
        stops[row.depth + len(row.turns)] |= bit
        represents[max(row.r, row.depth)] |= bit
        over |= bit * row.last
        leaves |= bit * row.leaf
        for p, (a, b, _) in enumerate(row.turns):
            postings[row.depth + p, a, b] |= bit

    nodes: list[Node] = []
    for (first, *key), members in starts.items():
        from_here = 0  # rows that represent nodes at this depth
        for depth, bits in represents.items():
            from_here |= bits if depth <= first else 0
        stack = [(members, first, (key[0], key[1]), (0, 0), 0, -1, from_here)]
        while stack:
            members, depth, (ka, kb), parent, length, above, reps = stack.pop()
            ending = members & stops.get(depth, 0)
            going = members & ~(ending & over)
            next_reps = reps | (represents.get(depth + 1, 0) & members)
            at = above
            if depth > first or first == 0:
                lowest = rows[(members & -members).bit_length() - 1]
                at = len(nodes)
                node = Node((ka, kb), parent, depth, lowest.conv, lowest.r, members.bit_count(), above=above)
                node.ends = [rows[i].conv for i in _bits(ending & over)]
                node.children = (going & next_reps).bit_count()
                node.leaves = (members & leaves).bit_count()
                node.saved = length * (members & ~reps).bit_count()
                node.saved += sum(rows[i].carry for i in _bits(ending & ~over))
                nodes.append(node)
            rest = members & ~ending
            while rest:
                row = rows[(rest & -rest).bit_length() - 1]
                a, b, size = row.turns[depth - first]
                child = rest & postings[depth, a, b]
                rest ^= child
                stack.append((child, depth + 1, (ka ^ a, kb ^ b), (ka, kb), size, at, next_reps & child))
    for node in reversed(nodes):
        if node.above >= 0:
            nodes[node.above].saved += node.saved
    return nodes


def _local_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of every block of `rows`, which are dealt to blocks as they lie."""

    def records(nodes: list[Node]) -> pa.RecordBatch:
        columns = [
            [n.key[0] for n in nodes],
            [n.key[1] for n in nodes],
            [n.parent[0] for n in nodes],
            [n.parent[1] for n in nodes],
            [n.depth for n in nodes],
            [n.conv for n in nodes],
            [n.r for n in nodes],
            [n.n for n in nodes],
            [len(n.ends) for n in nodes],
            [n.children for n in nodes],
            [n.leaves for n in nodes],
            [n.saved for n in nodes],
        ]
        ends = pa.array([n.ends or None for n in nodes], pa.list_(pa.int64()))
        names = [x.split()[0] for x in _NODE.split(", ")]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], ends], names=names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Row] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for x in batch.slice(start, 256).to_pylist():
                    turns = [(t["a"], t["b"], t["len"]) for t in x["turns"]]
                    held.append(
                        Row(x["conv"], x["seg"] * SEGMENT, (x["sa"], x["sb"]), turns, x["last"], x["r"], x["leaf"], x["carry"])
                    )
                    size += len(turns)
                    if size >= BLOCK_TURNS or len(held) >= BLOCK_ROWS:
                        yield records(block_nodes(held))
                        held, size = [], 0
        if held:
            yield records(block_nodes(held))

    return rows.select("conv", "seg", "turns", "last", "sa", "sb", "r", "leaf", "carry").mapInArrow(blocks, _NODE)


def _representatives(nodes: DataFrame) -> DataFrame:
    """Of each conversation that represents a node: the depth from which on, and whether a leaf."""
    found = nodes.groupBy("ka", "kb").agg(
        F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("n_ends").alias("n_ends")
    )
    leaf = F.col("n") == F.col("n_ends")
    return found.groupBy("conv").agg(F.min("depth").alias("r"), F.max(leaf).alias("leaf"))


def _with_representatives(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Add what the first pass found, and what a conversation's later segments save."""
    joined = rows.drop("r", "leaf", "carry").join(known, "conv", "left").withColumns(
        {"r": F.coalesce("r", F.lit(NEVER)), "leaf": F.coalesce("leaf", F.lit(False))}
    )
    saved = F.aggregate(
        "turns", F.lit(0).cast("long"), lambda s, t: s + F.when(t["p"] < F.col("r"), t["len"]).otherwise(F.lit(0))
    )
    later = Window.partitionBy("conv").orderBy("seg").rowsBetween(1, Window.unboundedFollowing)
    # Only conversations of several segments have segments with a key before them, or one that goes on.
    several = joined.filter("NOT last OR seg > 0").select("conv", "seg", saved.alias("own"))
    carried = several.select("conv", "seg", F.coalesce(F.sum("own").over(later), F.lit(0)).alias("carry"))
    return joined.join(carried, ["conv", "seg"], "left").withColumn("carry", F.coalesce("carry", F.lit(0).cast("long")))


def _ends_digests(nodes: DataFrame) -> DataFrame:
    """`ka, kb, ends_sha256` of nodes that end a conversation."""
    ids = nodes.filter("ends IS NOT NULL").select("ka", "kb", F.explode("ends").alias("id"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string")), ",")
    ranges = ids.groupBy("ka", "kb", F.shiftright("id", IDS_SHIFT).alias("range")).agg(listed.alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def result(out: list[tuple[int, int, str]]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["ka", "kb", "ends_sha256"])

        for batch in batches:
            out = []
            ka, kb, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("ka", "kb", "ids"))
            for a, b, text in zip(ka, kb, texts):
                if (a, b) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (a, b), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield result(out)
        if now is not None:
            yield result([(*now, state.hexdigest())])

    sorted_ranges = ranges.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "range")
    return sorted_ranges.mapInArrow(digests, "ka bigint, kb bigint, ends_sha256 string")


def _merged_nodes(conversations: DataFrame) -> DataFrame:
    """The nodes of all blocks summed up by key, written."""
    turns = staged(ordered_turns(conversations), "turns")
    convs, whole = rebuilt(turns)
    convs = staged(convs, "convs")
    unknown = {"r": F.lit(NEVER), "leaf": F.lit(False), "carry": F.lit(0).cast("long")}
    written = staged(segments(convs, whole), "segments")
    discard(turns)
    rows = _with_starts(written, convs)
    known = staged(_representatives(_local_nodes(rows.withColumns(unknown))), "representatives")
    local = staged(_local_nodes(_with_representatives(rows, known)), "local-nodes")
    discard(written, convs, known)
    least = F.min(F.struct("conv", "r"))
    return staged(
        local.groupBy("ka", "kb")
        .agg(
            F.min("depth").alias("depth"),
            least.alias("least"),
            F.min("pa").alias("pa"),
            F.min("pb").alias("pb"),
            *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
        )
        .join(_ends_digests(local), ["ka", "kb"], "left"),
        "nodes",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    `conv_id` (the smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens` (code points that a shared prefix spares, over the subtree), `ends_sha256`.
    """
    with work_on(conversations.sparkSession, "trie") as work:
        nodes = work.keep(_merged_nodes(conversations))
    # A conversation represents the parents of its nodes too, but for the first node of its own.
    first = (F.col("depth") == F.col("least.r")) & (F.col("depth") > 0)
    parents = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("least.conv").alias("parent"))
    inner = F.when(F.col("depth") > 0, F.col("least.conv"))
    placed = nodes.filter(first).join(parents, ["pa", "pb"]).unionByName(nodes.filter(~first).withColumn("parent", inner))
    return placed.select(
        F.col("least.conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
