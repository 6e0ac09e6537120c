"""N-gram Jaccard join with signature trees.

Documents are sets of hashed word shingles. Two sets of Jaccard similarity t share a token
among the first (1 - t) part of each, under any one order of tokens, and one more for each token
that this part is lengthened by; rare tokens come first, so that shared passages do not bring
documents together. How frequent a token is comes from
a count sketch of fixed size over all documents.

Documents meet in blocks by such a token. In a block a signature tree is built: documents in
order of size, leaves of 16, nodes that hold the OR of their token bitmaps, their range of
sizes and the largest number of tokens that share a bit. Two nodes are traversed together
unless the largest overlap their bitmaps allow is below the least overlap that their sizes
ask for. What is left is compared set by set, unless already connected.

First each document goes to the block of one token, chosen by a hash, a few times with
different hashes; this connects groups of near copies. After that only tokens count whose
documents are not all connected yet: their trees give pairs, which are compared exactly.
Tokens that the very same documents hold early are one, with a weight.
No pair is lost: every pair with a common early token is either compared or connected.

Defined cases: a null or empty text has an empty set and is linked with nothing; equal sets are
linked whatever the texts; rows with equal or null ids are rows of their own, and a component's
id is the smallest that is not null; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from cashwatch.llm.common import discard, staged, text_portions, work_on
from cashwatch.llm.components import connected_components

SKETCH_BITS = 20
SLOT_BITS = 14  # counters of a slot of the sketch
FILTER_BITS = 24
LEAF = 16
FANOUT = 8
BLOCK = 1024  # documents of a block
BYTES_AT_ONCE = 1_000_000
ROWS_AT_ONCE = 256  # of a batch that are Python objects at a time
SEEN = 100_000  # sets that a task remembers having sent
ROUNDS = 4


@dataclass(frozen=True)
class Rule:
    """Shingle length in words, and the similarity as a whole percentage."""

    words: int = 5
    percent: int = 80

    def shared(self, size):
        """How many of their early tokens two linked sets share, the smaller one of this size."""
        return 1 + size // 20

    def early(self, size):
        """How many first tokens of a set are early: those beyond the part that a linked set
        must hold, and one for each token to be shared."""
        return size - (self.percent * size + 99) // 100 + self.shared(size)

    def least_overlap(self, sizes: np.ndarray) -> np.ndarray:
        """The overlap that two sets with these summed sizes need: 100 o >= p (sum - o)."""
        return (self.percent * sizes + 99 + self.percent) // (100 + self.percent)


# Token sets --------------------------------------------------------------------------------

_MULTIPLIERS = np.random.default_rng(11).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def token_sets(texts: list[str | None], rule: Rule) -> Iterator[np.ndarray]:
    """The sorted set of 64-bit shingle hashes of each text."""
    # bytes.lower and bytes.split know ASCII letters and white space only, as words are defined.
    cut = [(t or "").encode("utf-8").lower().split() for t in texts]
    flat = [w for words in cut for w in words]
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.zeros(0, np.uint64)
    at, k = 0, rule.words
    for words in cut:
        w = hashes[at : at + len(words)]
        at += len(words)
        if len(w) == 0:
            yield w
            continue
        n = max(1, len(w) - k + 1)
        h = np.full(n, min(len(w), k), np.uint64)
        for i in range(min(len(w), k)):  # a text of fewer words is one shingle
            h += w[i : i + n] * _MULTIPLIERS[i]
        h = _scrambled(h)
        h.sort()
        yield h[np.concatenate([[True], h[1:] != h[:-1]])]


def _set_ids(tokens: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def pack(tokens: np.ndarray) -> bytes:
    """The upper five bytes of each token, in order."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, 3:] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return np.unique(out.view("<u8").ravel())


# Passes over the texts ---------------------------------------------------------------------


def _sizes_and_sketch(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows of kind `doc` (row, doc_id, n, c, c2) and of kind `sketch` (slot, counts)."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = f"kind string, row bigint, doc_id {doc_type}, n bigint, c bigint, c2 bigint, slot int, counts binary"
    slot_size = 1 << SLOT_BITS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for part, texts in text_portions(batches, BYTES_AT_ONCE):
            sets = list(token_sets(texts, rule))
            used = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            counts += np.bincount((used >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
            ids = [_set_ids(s) for s in sets]
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["doc"] * m),
                    part.column(0),
                    part.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([i[0] for i in ids], pa.int64()),
                    pa.array([i[1] for i in ids], pa.int64()),
                    pa.nulls(m, pa.int32()),
                    pa.nulls(m, pa.binary()),
                ],
                names=["kind", "row", "doc_id", "n", "c", "c2", "slot", "counts"],
            )
        if counts.any():
            slots = range(len(counts) // slot_size)
            m = len(slots)
            blobs = [counts[s * slot_size : (s + 1) * slot_size].astype("<u4").tobytes() for s in slots]
            null = pa.nulls(m, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["sketch"] * m), null, pa.nulls(m, part.column(1).type), null, null, null,
                    pa.array(list(slots), pa.int32()), pa.array(blobs, pa.binary()),
                ],
                names=["kind", "row", "doc_id", "n", "c", "c2", "slot", "counts"],
            )

    return staged(rows.mapInArrow(scan, schema), "sets", ["kind"])


def _order(scanned: DataFrame) -> np.ndarray:
    """The frequency class of each cell of the sketch: its count on a scale of half powers of two.

    Slots are summed on the executors. The sketch has a fixed size, whatever the input.
    """

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for blob in group["counts"]:
            total += np.frombuffer(blob, "<u4")
        classes = np.floor(2 * np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pd.DataFrame({"slot": [key[0]], "classes": [classes.tobytes()]})

    summed = scanned.filter("kind = 'sketch'").select("slot", "counts").groupBy("slot")
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in summed.applyInPandas(add, "slot int, classes binary").collect():  # one megabyte in all
        classes[r["slot"] << SLOT_BITS : (r["slot"] + 1) << SLOT_BITS] = np.frombuffer(r["classes"], np.uint8)
    return classes


def _early_tokens(docs: DataFrame, classes: np.ndarray, rule: Rule) -> DataFrame:
    """`token, c, n`: the first tokens of each distinct set, rare ones first."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, texts in text_portions(batches, BYTES_AT_ONCE):
            tokens, owners, sizes = [], [], []
            for s in token_sets(texts, rule):
                c = _set_ids(s)[0] if len(s) else None
                if c is None or c in seen:
                    continue
                if len(seen) > SEEN:  # forgetting only repeats rows, which are dropped later
                    seen.clear()
                seen.add(c)
                p = int(rule.early(np.int64(len(s))))
                rank = shared.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                tokens.append(s[np.argsort(rank, kind="stable")[:p]])
                owners.append(np.full(p, c, np.int64))
                sizes.append(np.full(p, len(s), np.int32))
            if tokens:
                yield pa.RecordBatch.from_pydict(
                    {
                        "token": np.concatenate(tokens).view(np.int64),
                        "c": np.concatenate(owners),
                        "n": np.concatenate(sizes),
                    }
                )

    return docs.select("text").mapInArrow(scan, "token bigint, c bigint, n int")


def _repeated(early: DataFrame, rule: Rule) -> DataFrame:
    """Rows of tokens that another set of like size holds too: linked sets differ in size by the
    rule's part at most. Rows come sorted by token, then size, and stream by; where any such set
    exists, the set before or after is one."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose successor is not known yet, and whether it is like its predecessor
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(i), dtype=np.int64) for i in range(3)])
            linked = False
            if held is not None:
                rows = np.concatenate([held[0], rows], axis=1)
                linked = held[1]
            if rows.shape[1] == 0:
                continue
            fresh = np.ones(rows.shape[1], bool)
            fresh[1:] = (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)
            rows = rows[:, fresh]
            like = (rows[0][1:] == rows[0][:-1]) & (100 * rows[2][:-1] >= rule.percent * rows[2][1:])
            good = np.zeros(rows.shape[1], bool)
            good[0] = linked
            good[1:] |= like
            good[:-1] |= like
            held = (rows[:, -1:], bool(good[-1]))
            out = rows[:, :-1][:, good[:-1]]
            if out.shape[1]:
                yield pa.RecordBatch.from_pydict({"token": out[0], "c": out[1], "n": out[2].astype(np.int32)})
        if held is not None and held[1]:
            out = held[0]
            yield pa.RecordBatch.from_pydict({"token": out[0], "c": out[1], "n": out[2].astype(np.int32)})

    together = early.repartition("token").sortWithinPartitions("token", "n", "c")
    return staged(together.mapInArrow(keep, "token bigint, c bigint, n int"), "tokens")


def _enough(rule: Rule) -> Column:
    """How many early tokens a set of `n` shares with any linked one, which may be smaller."""
    least_partner = F.expr(f"(n * {rule.percent} + 99) div 100")
    return F.lit(1) + F.floor(least_partner / F.lit(20.0))


def _merged(rows: DataFrame) -> DataFrame:
    """Of tokens that the very same sets hold one stays, with the sum of their `weight`: a passage
    that a few sets share is one row of each, not one for each of its tokens. Tokens of one set go."""
    sets = [F.count("*").alias("held"), *(F.bit_xor(F.xxhash64(F.lit(i), "c")).alias(f"x{i}") for i in range(2))]
    lists = rows.groupBy("token").agg(*sets, F.max("weight").alias("weight")).filter("held > 1")
    stands = lists.groupBy("held", "x0", "x1").agg(F.min("token").alias("token"), F.sum("weight").alias("weight"))
    return staged(rows.drop("weight").join(stands.drop("held", "x0", "x1"), "token"), "merged")


def _with_partners(tokens: DataFrame, rule: Rule) -> DataFrame:
    """`token, c, n, weight`: rows of sets that have as many repeated early tokens as any link of
    theirs shares. A partner has at least the rule's part of a set's size."""
    rows = tokens.withColumn("weight", F.lit(1).cast("long"))
    held = F.sum("weight").over(Window.partitionBy("c"))  # of one set
    for _ in range(2):
        merged = _merged(rows)
        discard(rows)
        fit = merged.withColumn("held", held).filter(F.col("held") >= _enough(rule)).drop("held")
        rows = staged(fit, "partners")
        discard(merged)
    return rows


# Signature trees ---------------------------------------------------------------------------


def signature(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Bitmap of the tokens' places among `bits` (a power of two), as bytes."""
    out = np.zeros(bits, bool)
    out[(tokens >> np.uint64(24)).astype(np.int64) & (bits - 1)] = True
    return np.packbits(out)


def signature_bits(size: int) -> int:
    """At least four bits for each token: with two, bounds let eight times as many pairs pass."""
    return 1 << max(8, (4 * size - 1).bit_length())


def folded(bitmap: np.ndarray, bits: int) -> np.ndarray:
    """The signature of the same tokens with fewer bits: places are taken modulo the width."""
    return np.bitwise_or.reduce(bitmap.reshape(-1, bits // 8), axis=0)


def _count(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=-1, dtype=np.int64)


class SignatureTree:
    """Documents in order of size; each level groups the one below. A node holds the OR of
    its bitmaps, its least and largest size, and the most tokens beyond one for each bit."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        bitmaps = np.ascontiguousarray(bitmaps).view(np.uint64)
        level = (bitmaps, sizes, sizes, sizes - _count(bitmaps))
        self.levels = [level]
        step = LEAF
        while len(level[1]) > 1:
            at = np.arange(0, len(level[1]), step)
            level = (
                np.bitwise_or.reduceat(level[0], at, axis=0),
                np.minimum.reduceat(level[1], at),
                np.maximum.reduceat(level[2], at),
                np.maximum.reduceat(level[3], at),
            )
            self.levels.append(level)
            step = FANOUT

    def children(self, depth: int, node: int) -> range:
        step = LEAF if depth == 1 else FANOUT
        return range(node * step, min((node + 1) * step, len(self.levels[depth - 1][1])))

    def meets(self, depth: int, some: np.ndarray, others: np.ndarray, rule: Rule) -> np.ndarray:
        """Matrix: which nodes of one level may hold documents that are linked.

        Common tokens fall on common bits, and beyond one for each bit there are at most as
        many as either side has to spare."""
        bitmaps, low, high, spare = self.levels[depth]
        i, j = some[:, None], others[None, :]
        possible = _count(bitmaps[i] & bitmaps[j]) + np.minimum(spare[i], spare[j])
        possible = np.minimum(possible, np.minimum(high[i], high[j]))
        return possible >= rule.least_overlap(low[i] + low[j])

    def span(self, depth: int, node: int) -> slice:
        """The documents under a node."""
        width = 1 if depth == 0 else LEAF * FANOUT ** (depth - 1)
        return slice(node * width, (node + 1) * width)

    def pairs(self, rule: Rule, labels: np.ndarray, parts: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
        """Pairs of documents that the bounds leave, by traversal of node pairs from the root.

        Documents with equal labels need no comparison; the caller may change labels on the
        way. With `parts` only documents of different parts are compared."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            depth, a, b = stack.pop()
            mine, theirs = labels[self.span(depth, a)], labels[self.span(depth, b)]
            if (mine == mine[0]).all() and (theirs == mine[0]).all():
                continue
            some, others = np.asarray(self.children(depth, a)), np.asarray(self.children(depth, b))
            near = self.meets(depth - 1, some, others, rule)
            if a == b:
                near &= some[:, None] < others[None, :] if depth == 1 else some[:, None] <= others[None, :]
            if depth == 1:
                near &= mine[:, None] != theirs[None, :]
                if parts is not None:
                    near &= parts[some][:, None] != parts[others][None, :]
            left, right = np.nonzero(near)
            found = zip(some[left].tolist(), others[right].tolist())
            if depth == 1:
                yield from found
            else:
                stack += [(depth - 1, i, j) for i, j in found]


def similar(a: np.ndarray, b: np.ndarray, rule: Rule) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= rule.percent * (len(a) + len(b) - common)


def connected(sets: list[np.ndarray], rule: Rule) -> np.ndarray:
    """For each of the sets the index of the first one it is connected with."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    root = np.arange(len(sets))
    if len(sets) > 1:
        bits = signature_bits(int(sizes.max()))
        tree = SignatureTree(np.stack([signature(sets[i], bits) for i in order]), sizes[order])
        for a, b in tree.pairs(rule, root):
            if root[a] != root[b] and similar(sets[order[a]], sets[order[b]], rule):
                low, high = sorted((root[a], root[b]))
                root[root == high] = low
    out = np.empty(len(sets), np.int64)
    out[order] = order[root]
    return out


# Blocks ------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Groups of rows with equal first `keys` columns, from batches sorted by them."""
    now, group = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            for row in zip(*[c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns]):
                if row[:keys] != now:
                    if group:
                        yield group
                    now, group = row[:keys], []
                group.append(row[keys:])
    if group:
        yield group


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over hashes of the sets `c` of `ids`: what it lets pass in vain
    does no harm, and it lets most others not pass."""
    bit = F.pmod("c", F.lit(1 << FILTER_BITS))
    words = ids.select("c").distinct().groupBy(F.shiftright(bit, 5).cast("int").alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(c, 32) AS INT))")).alias("bits"))
    marks = np.zeros((1 << FILTER_BITS) // 32, np.uint32)
    found = words.toArrow()  # two megabytes of bits at most
    marks[np.asarray(found.column("word"))] = np.asarray(found.column("bits")).astype(np.uint32)
    return marks


def _marked(marks: np.ndarray, c: np.ndarray) -> np.ndarray:
    place = c % (1 << FILTER_BITS)
    return (marks[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1


_SET = "c bigint, c2 bigint, n int, tokens binary, bitmap binary"


def _candidate_sets(docs: DataFrame, tokens: DataFrame, rule: Rule) -> DataFrame:
    """`c, c2, n, tokens, bitmap` of the sets in `tokens`; a set may come from several tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(_marks(tokens))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, texts in text_portions(batches, BYTES_AT_ONCE):
            sets = [s for s in token_sets(texts, rule) if len(s)]
            ids = [_set_ids(s) for s in sets]
            wanted = _marked(shared.value, np.array([i[0] for i in ids], np.int64))
            out = []
            for s, (c, c2), want in zip(sets, ids, wanted.tolist()):
                if want and c not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(c)
                    out.append((c, c2, len(s), pack(s), signature(s, signature_bits(len(s))).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["c", "c2", "n", "tokens", "bitmap"],
                )

    return staged(docs.select("text").mapInArrow(scan, _SET), "candidates")


def _only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `sets` that are in `ids`, and a few more, without moving the others."""
    shared = sets.sparkSession.sparkContext.broadcast(_marks(ids))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_marked(shared.value, np.asarray(batch.column(0)))))

    return staged(sets.mapInArrow(keep, _SET), "some-sets")


def _placed(tokens: DataFrame, turn: int) -> DataFrame:
    """`turn, token, part, c`: each set in the block of one of its tokens, chosen by hash.
    Blocks of more than `BLOCK` sets are cut at random, differently in each turn."""
    chosen = tokens.groupBy("c").agg(
        F.min(F.struct(F.xxhash64(F.lit(turn), "token"), "token")).alias("least")
    ).select("c", F.col("least.token").alias("token"))
    counts = chosen.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    part = F.pmod(F.xxhash64(F.lit(turn), "c"), F.ceil(F.col("held") / F.lit(float(BLOCK)))).cast("int")
    return chosen.join(counts, "token").select(F.lit(turn).alias("turn"), "token", part.alias("part"), "c")


def _block_edges(placed: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Connections found in the blocks of `_placed`."""
    keys = ["turn", "token", "part"]
    blocks = placed.join(sets, "c").select(*keys, "c", "c2", "tokens")

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _blocks(batches, 3):
            group = list({row[:2]: row for row in group}.values())
            if len(group) < 2:
                continue
            first = connected([unpack(row[2]) for row in group], rule)
            ends = [(group[i][:2], group[f][:2]) for i, f in enumerate(first.tolist()) if i != f]
            if ends:
                yield _edge_batch(ends)

    sorted_blocks = blocks.repartition(*keys).sortWithinPartitions(*keys)
    return staged(sorted_blocks.mapInArrow(connect, _EDGE), "round")


_EDGE = "a1 bigint, a2 bigint, b1 bigint, b2 bigint"


def _edge_batch(ends: list[tuple[tuple[int, int], tuple[int, int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([e[i][j] for e in ends], pa.int64()) for i in (0, 1) for j in (0, 1)],
        names=["a1", "a2", "b1", "b2"],
    )


def _not_connected(rows: DataFrame, rule: Rule) -> DataFrame:
    """Of `rows` (`token, c, n, label`) those in runs of like sizes that hold several labels.

    The sets of a token, in order of size, are cut where the next one is too large for a link with
    the last: linked sets are in one run, and a run of one label has nothing left to connect."""
    size = F.col("n").cast("long")
    by_size = Window.partitionBy("token").orderBy("n")
    opens = F.when(100 * F.lag(size).over(by_size) >= rule.percent * size, 0).otherwise(1)
    run = F.sum("_opens").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    inside = Window.partitionBy("token", "_run")
    runs = rows.withColumn("_opens", opens).withColumn("_run", run)
    ends = runs.withColumn("_low", F.min("label").over(inside)).withColumn("_high", F.max("label").over(inside))
    return ends.filter("_low <> _high").select(*rows.columns)


def _mixed(tokens: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The rows of tokens whose sets are not all connected, with their labels (`c, label`)."""
    return staged(_not_connected(tokens.join(labels, "c"), rule), "mixed")


def _mixed_pairs(mixed: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs that share a token of `mixed` (`token, c, n, weight, label`) and that the trees leave.

    Linked sets share several early tokens, so each set leaves out the last but one of them, by weight and in
    the order of how many sets hold a token: frequent tokens bring together the fewest. Of those
    rows only ones with a set of like size at the same token go on. Blocks of more than `BLOCK` sets are cut, and their parts meet in pairs."""
    held = mixed.groupBy("token").agg(F.count("*").alias("held"))
    last_first = Window.partitionBy("c", "n", "label").orderBy(F.desc("held"), F.desc("token"))  # of one set
    beyond = F.sum("weight").over(last_first.rowsBetween(Window.unboundedPreceding, 0))
    rows = mixed.join(held, "token").withColumn("beyond", beyond).filter(F.col("beyond") >= _enough(rule))
    rows = staged(_not_connected(rows.select("token", "c", "n", "label"), rule), "mixed")
    parts = F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("int").alias("parts")
    counts = rows.groupBy("token").agg(parts, F.min("label").alias("low"), F.max("label").alias("high"))
    counts = counts.filter("low <> high").drop("low", "high")
    part = F.pmod(F.xxhash64(F.lit(9), "c"), F.col("parts")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, F.col("part")).alias("i"), F.greatest(p, F.col("part")).alias("j")),
    )
    placed = rows.join(counts, "token").withColumn("part", part).withColumn("meet", F.explode(meets))
    blocks = placed.join(sets.select("c", "c2", "bitmap"), "c").select(
        "token", F.col("meet.i").alias("i"), F.col("meet.j").alias("j"), "c", "c2", "n", "label", "part", "bitmap"
    )

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, 3):
            rows = sorted({row[:2]: row for row in rows}.values(), key=lambda row: row[2])
            ends = []
            for group in _like_sized(rows, rule):
                labels = np.array([row[3] for row in group], np.int64)
                if (labels == labels[0]).all():
                    continue
                bits = 8 * min(len(row[5]) for row in group)
                bitmaps = np.stack([folded(np.frombuffer(row[5], np.uint8), bits) for row in group])
                tree = SignatureTree(bitmaps, np.array([row[2] for row in group], np.int64))
                own = np.array([row[4] for row in group])
                several = own if (own != own[0]).any() else None  # a part meets itself elsewhere
                ends += [tuple(sorted((group[a][:2], group[b][:2]))) for a, b in tree.pairs(rule, labels, several)]
            if ends:
                yield _edge_batch(ends)

    keys = ["token", "i", "j"]
    sorted_blocks = blocks.repartition(*keys).sortWithinPartitions(*keys)
    pairs = staged(sorted_blocks.mapInArrow(propose, _EDGE).distinct(), "pairs")
    discard(rows)
    return pairs


def _like_sized(rows: list[tuple], rule: Rule) -> Iterator[list[tuple]]:
    """Rows in order of size, cut where the next one is too large for a link with the last."""
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rule.percent * rows[i][2] > 100 * rows[i - 1][2]:
            yield rows[start:i]
            start = i


def _compared(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sets are similar."""
    a = sets.select(F.col("c").alias("a1"), F.col("c2").alias("a2"), F.col("tokens").alias("left"))
    b = sets.select(F.col("c").alias("b1"), F.col("c2").alias("b2"), F.col("tokens").alias("right"))
    rows = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("a1", "a2", "b1", "b2", "left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(unpack(x.as_py()), unpack(y.as_py()), rule) for x, y in zip(batch.column(4), batch.column(5))
            ]
            yield batch.select(range(4)).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(compare, _EDGE)


def jaccard_join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """`row, doc_id, n_shingles, component, component_id` of every row of `docs`
    (`doc_id, text`). `row` numbers the rows, `component` is the smallest row connected."""
    with work_on(docs.sparkSession, "jaccard") as work:
        placed = work.keep(_placed_rows(docs, rule))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "component").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "component", "component_id"
    )


def _placed_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    """`row, doc_id, n, component`, written; tables go as soon as what is made of them is written."""
    scanned = _sizes_and_sketch(docs, rule)
    rows = scanned.filter("kind = 'doc'").select("row", "doc_id", "n", "c", "c2")
    filled = rows.filter("n > 0")
    repeated = _repeated(_early_tokens(docs, _order(scanned), rule), rule)
    discard()  # the shuffle of all early tokens goes
    tokens = _with_partners(repeated, rule)
    discard(repeated)
    sets = _candidate_sets(docs, tokens, rule)

    # A set's node is the smallest row that holds it.
    nodes = staged(filled.groupBy("c", "c2").agg(F.min("row").alias("node")), "nodes")

    def as_nodes(ends: DataFrame) -> DataFrame:
        a = nodes.select(F.col("c").alias("a1"), F.col("c2").alias("a2"), F.col("node").alias("a"))
        b = nodes.select(F.col("c").alias("b1"), F.col("c2").alias("b2"), F.col("node").alias("b"))
        return ends.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("a", "b")

    def of_set(labels: DataFrame) -> DataFrame:
        return nodes.join(labels, "node", "left").select("c", F.coalesce("component", "node").alias("label"))

    def grown(labels: DataFrame, ends: DataFrame) -> DataFrame:
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = staged(connected_components(known.unionAll(as_nodes(ends))), "labels")
        discard(labels)
        return found

    edges = _block_edges(_placed(tokens, 0), sets, rule)
    labels = staged(connected_components(as_nodes(edges)), "labels")
    mixed = _mixed(tokens, of_set(labels), rule)
    left = _only(sets, mixed)
    discard(tokens, sets, edges)
    turns = [_placed(mixed, turn) for turn in range(1, ROUNDS)]
    edges = _block_edges(reduce(DataFrame.unionAll, turns), left, rule)
    labels = grown(labels, edges)
    mixed, before = _mixed(mixed.drop("label"), of_set(labels), rule), mixed
    discard(before, edges)
    pairs = _mixed_pairs(mixed, left, rule)
    discard(mixed)
    ends = pairs.select(F.col("a1").alias("c")).unionAll(pairs.select(F.col("b1").alias("c")))
    final = grown(labels, _compared(pairs, _only(left, ends), rule))
    discard(pairs, left)

    per_set = nodes.join(final, "node", "left").select("c", "c2", F.coalesce("component", "node").alias("component"))
    component = F.coalesce("component", "row").alias("component")
    return staged(rows.join(per_set, ["c", "c2"], "left").select("row", "doc_id", "n", component), "placed")


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows of `docs` as `whole`, with `file` and `at`, which name a row of a table.

    Rows of a table as it is read have such names; the rows of any other frame are written first.
    """
    whole = F.struct(*docs.columns).alias("whole")
    named = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    as_read = docs._jdf.queryExecution().analyzed().children().isEmpty()  # no step after the read
    if as_read and "_metadata" not in docs.columns:
        try:
            return docs.select(whole, *named)
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
    return staged(docs.select(whole), "rows").select("whole", *named)


def first_of_each_group(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of `docs` that stand for their group: of the smallest id, then place; rows with a
    null id come last. Rows without words form no group and stay. Columns are those of `docs`.

    Rows are told apart by their place in the files they are read from, so texts are not copied.
    """
    rows = _keyed(docs)
    plain = rows.select(F.struct("file", "at").alias("doc_id"), F.col("whole.text").alias("text"))
    found = jaccard_join(plain).select("doc_id.file", "doc_id.at", "component")
    ids = rows.select("file", "at", F.col("whole.doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "file", "at"))
    kept = found.join(ids, ["file", "at"]).groupBy("component").agg(first.alias("first")).select("first.file", "first.at")
    return rows.join(kept, ["file", "at"], "left_semi").select("whole.*")
