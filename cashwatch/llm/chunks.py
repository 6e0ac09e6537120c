"""Substring dedup by content-defined chunks with a gear rolling hash.

A text's bytes are cut where the gear hash of the last 32 bytes has six given bits zero, at
least 32 bytes after the cut before. Cuts follow the content, so an insertion moves only the
chunks around it. Chunks are compared by digest over all documents. A chunk that another document
holds too is repeated, in every document that holds it. Runs of repeated chunks of at least
`least_chars` characters are reported, shorter ones are chance. Of each digest the first
occurrence (by smallest document, then place) stays, and later ones can be removed.

A passage of fifty words holds a whole chunk by luck only, so a second kind of chunk finds those:
`PASSAGE_WORDS` words each, overlapping, from anchors to be had in any text. An anchor is the word
whose first 32 bytes have the least gear hash of `ANCHOR_WORDS` words in a row, the last of equal
ones. Any `FOUND_WORDS` words in a row that two documents share hold an anchor of both with its
chunk, so a document with such a passage is always found, and one whose longest is shorter than
a chunk never. Passages are the unions of such chunks that another document holds; white space
between words, of any kind and length, makes no difference to them.

Defined cases: a null or empty text has no chunks; a text without a cut is one chunk, however
long; what repeats within one text alone is not repeated; rows with equal or null ids are
documents of their own, ordered by id (nulls first), then by place in the input; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cashwatch.llm.common import staged, text_portions

MASK = np.uint32(0b111111 << 26)
LEAST_BYTES = 32
LEAST_CHARS = 150
BYTES_AT_ONCE = 2_000_000
PASSAGE_WORDS = 40  # of a chunk from an anchor
ANCHOR_WORDS = 11  # of which one is an anchor
FOUND_WORDS = PASSAGE_WORDS + ANCHOR_WORDS - 1


def gear_table(seed: int = 7) -> np.ndarray:
    """A random 32-bit number for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)


_GEAR = gear_table()


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The rolling hash h = 2 h + gear[byte] (mod 2^32) after each byte, by doubling."""
    h = _GEAR[raw]
    for shift in (1, 2, 4, 8, 16):
        h[shift:] += h[:-shift] << np.uint32(shift)
    return h


def cuts_of(raw: np.ndarray) -> list[int]:
    """Ends of the chunks."""
    places = np.flatnonzero((gear_hashes(raw) & MASK) == 0) + 1
    out, last = [], 0
    for p in places.tolist():
        if p - last >= LEAST_BYTES:
            out.append(p)
            last = p
    if last < len(raw):
        out.append(len(raw))
    return out


def chunks_of(text: str | None) -> Iterator[tuple[bytes, int, int]]:
    """Digest, start and end of each chunk. Offsets are code points; a character whose
    bytes a cut parts belongs to the earlier chunk."""
    raw = (text or "").encode("utf-8")
    if not raw:
        return
    data = np.frombuffer(raw, np.uint8)
    ends = cuts_of(data)
    chars = np.cumsum((data & 0xC0) != 0x80)[np.asarray(ends) - 1].tolist()
    start = start_char = 0
    for end, end_char in zip(ends, chars):
        yield hashlib.blake2b(raw[start:end], digest_size=12).digest(), start_char, end_char
        start, start_char = end, end_char


def anchored_chunks(text: str | None) -> Iterator[tuple[bytes, int, int]]:
    """Digest, start and end (code points) of the chunk of `PASSAGE_WORDS` words at each anchor.
    Equal chunks at anchors that follow each other are one row, as in text of one repeated word."""
    raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    word = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    edges = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(starts) < FOUND_WORDS:
        return
    word[starts[1:] - 1] = True  # one space before each word but the first
    spaced = raw.copy()
    spaced[starts[1:] - 1] = 0x20
    tight = spaced[word]
    upto = np.cumsum(ends - starts + 1)
    at = np.concatenate([[0], upto[:-1]])
    hashes = gear_hashes(tight)[at[: len(at) - PASSAGE_WORDS + 1] + LEAST_BYTES - 1]
    windows = np.lib.stride_tricks.sliding_window_view(hashes[::-1], ANCHOR_WORDS)
    first = np.unique(len(hashes) - 1 - np.arange(len(windows)) - windows.argmin(axis=1))
    last = first + PASSAGE_WORDS - 1
    chars = np.cumsum((raw & 0xC0) != 0x80)
    body = tight.tobytes()
    held = None
    places = (at[first], upto[last] - 1, chars[starts[first]] - 1, chars[ends[last] - 1])
    for a, b, start, end in zip(*(x.tolist() for x in places)):
        digest = hashlib.blake2b(body[a:b], digest_size=12).digest()
        if held is not None and held[0] == digest and start <= held[2]:
            held = (digest, held[1], end)
            continue
        if held is not None:
            yield held
        held = (digest, start, end)
    yield held


_CHUNK = "kind string, doc_row bigint, doc_id {id}, digest binary, start int, stop int"


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per chunk of `kind` "gear" and "passage"; a document without gear chunks gets one
    such row with a null digest. `doc_row` tells rows of equal id apart. Written once, so that
    numbers and rows stay."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc_row"), "doc_id", "text")

    def table(kind: str, batch: pa.RecordBatch, found: list[list[tuple]]) -> pa.RecordBatch:
        owner = pa.array(np.repeat(np.arange(batch.num_rows), [len(f) for f in found]))
        flat = [c for f in found for c in f]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind] * len(flat), pa.string()),
                batch.column(0).take(owner),
                batch.column(1).take(owner) if kind == "gear" else pa.nulls(len(flat), batch.column(1).type),
                pa.array([c[0] for c in flat], pa.binary()),
                pa.array([c[1] for c in flat], pa.int32()),
                pa.array([c[2] for c in flat], pa.int32()),
            ],
            names=["kind", "doc_row", "doc_id", "digest", "start", "stop"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_portions(batches, BYTES_AT_ONCE):
            yield table("gear", batch, [list(chunks_of(t)) or [(None, 0, 0)] for t in texts])
            yield table("passage", batch, [list(anchored_chunks(t)) for t in texts])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return staged(rows.mapInArrow(cut, _CHUNK.format(id=kind)), "chunks", ["kind"])


def _passages(chunks: DataFrame) -> DataFrame:
    """`doc_row, n_passages, passage_chars, passages`: the unions of anchored chunks that another
    document holds too."""
    held = staged(
        chunks.groupBy("digest")
        .agg(F.min("doc_row").alias("low"), F.max("doc_row").alias("high"))
        .filter("low <> high")
        .select("digest"),
        "held-passages",
    )
    repeated = chunks.join(held, "digest").select("doc_row", "start", "stop")
    by_place = Window.partitionBy("doc_row").orderBy("start", "stop")
    before = F.max("stop").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum("_opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    runs = (
        repeated.withColumn("_opens", F.when(F.col("start") <= before, 0).otherwise(1))
        .withColumn("_run", run)
        .groupBy("doc_row", "_run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("end"))
    )
    return runs.groupBy("doc_row").agg(
        F.count("*").alias("n_passages"),
        F.sum(F.col("end") - F.col("start")).cast("long").alias("passage_chars"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("passages"),
    )


def repeated_substrings(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """`doc_id, n_chunks, n_repeated, repeated_chars, removable_chars, spans, n_passages,
    passage_chars, passages` of every row of `docs` (`doc_id, text`). `spans` are the runs of
    repeated gear chunks and `passages` the repeated passages, `(start, end)` in code points."""
    both = chunk_table(docs)
    chunks = both.filter("kind = 'gear'")
    place = F.struct("doc_id", "doc_row", "start")
    # Written, so that the join deals the chunks out anew and can split a frequent digest's rows.
    held = staged(
        chunks.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_row").alias("low"), F.max("doc_row").alias("high"), F.min(place).alias("first"))
        .filter("low <> high")
        .select("digest", "first"),
        "held-chunks",
    )
    size = (F.col("stop") - F.col("start")).cast("long")
    later = F.when(place.eqNullSafe(F.col("first")), F.lit(0).cast("long")).otherwise(size)
    repeated = chunks.join(held, "digest").select("doc_row", "start", "stop", later.alias("later"))
    by_place = Window.partitionBy("doc_row").orderBy("start", "stop")
    opens = F.when(F.col("start") == F.lag("stop").over(by_place), 0).otherwise(1)
    run = F.sum("_opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    runs = (
        repeated.withColumn("_opens", opens)
        .withColumn("_run", run)
        .groupBy("doc_row", "_run")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("end"),
            F.count("*").alias("chunks"),
            F.sum("later").alias("later"),
        )
        .filter(F.col("end") - F.col("start") >= least_chars)
    )
    spans = runs.groupBy("doc_row").agg(
        F.sum("chunks").alias("n_repeated"),
        F.sum(F.col("end") - F.col("start")).cast("long").alias("repeated_chars"),
        F.sum("later").alias("removable_chars"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    per_doc = chunks.groupBy("doc_row", "doc_id").agg(F.count("digest").alias("n_chunks"))
    passages = _passages(both.filter("kind = 'passage'").select("doc_row", "digest", "start", "stop"))
    numbers = ("n_repeated", "repeated_chars", "removable_chars", "n_passages", "passage_chars")
    n_repeated, repeated_chars, removable_chars, n_passages, passage_chars = (
        F.coalesce(c, F.lit(0)).alias(c) for c in numbers
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    return per_doc.join(spans, "doc_row", "left").join(passages, "doc_row", "left").select(
        "doc_id",
        "n_chunks",
        n_repeated,
        repeated_chars,
        removable_chars,
        F.coalesce("spans", none).alias("spans"),
        n_passages,
        passage_chars,
        F.coalesce("passages", none).alias("passages"),
    )
