"""Ranked lexical search by the Best Position Algorithm.

Documents stay where they are read: a task gathers them into shards and builds, for every query
term, the list of its documents by falling impact. For an item, a round reads on in each of its
lists from the list's best position, the last one of the contiguous prefix that is seen. A document
met for the first time is scored by direct access to all lists, which marks its position in each
of them as seen, so best positions move ahead of what was read. No unseen document scores more than
the sum of the first unseen impacts. The search of a shard stops when that is strictly
below the k-th score that the task has found so far, in this shard or an earlier one.

Two scans: the first counts documents, terms and document frequencies of the query terms, the
second searches. Items go to the tasks as a broadcast value in blocks of `BLOCK_BYTES` of terms,
with two scans a block, so that the value's size does not grow with the items' table. What
a task returns are k rows per item; they are cut to the best k by salt before an item's rows meet.

Defined cases: a null text has no terms and is not counted; repeated rows of documents are
documents of their own; rows that repeat an item id are one item with the terms of all; an item
without terms, or without a document of positive score, has no rows; null ids are ids of their
own, and a null doc_id comes last among equal scores; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from cashwatch.llm.common import staged, text_portions

BLOCK_BYTES = 4_000_000  # of the items' terms in one broadcast value
BYTES_AT_ONCE = 8_000_000
SHARD_HITS = 2_000_000  # occurrences of query terms in one shard, or one document's
FIRST_READ = 8  # positions of each list read in the first round; later rounds read twice as many
SALTS = 64

# A term is a run of ASCII letters and digits and of all characters beyond ASCII.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8").translate(_LETTERS).split() if text else []


@dataclass
class Items:
    """Items of one block: ids, the terms of each as numbers, and the number of each term."""

    ids: list[object]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: Sequence[tuple[object, Sequence[bytes]]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        numbered = [np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in ts], np.int64) for _, ts in rows]
        return cls([i for i, _ in rows], numbered, vocabulary)


@dataclass
class Corpus:
    """Documents with a term, occurrences of all terms, and weights of the query terms."""

    documents: int
    occurrences: int
    weight: np.ndarray

    @classmethod
    def of(cls, documents: int, occurrences: int, frequency: np.ndarray) -> Corpus:
        weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * frequency + 1)))
        return cls(documents, occurrences, weight.astype(np.int64))


class Shard:
    """Impact lists of some documents.

    Postings lie by term and falling impact; `by_document` holds their places by document.
    """

    def __init__(self, documents: np.ndarray, term: np.ndarray, count: np.ndarray, lengths: np.ndarray, corpus: Corpus):
        """Postings (document, term, occurrences) and the length of every document in terms."""
        scaled = np.array([10 + 90 * int(n) * corpus.documents // corpus.occurrences for n in lengths], np.int64)
        impact = corpus.weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * scaled[documents]))
        order = np.lexsort((documents, -impact, term))
        order = order[impact[order] > 0]
        self.document, self.term, self.impact = documents[order], term[order], impact[order]
        self.starts = np.searchsorted(self.term, np.arange(len(corpus.weight) + 1))
        self.by_document = np.argsort(self.document, kind="stable")
        self.document_starts = np.searchsorted(self.document[self.by_document], np.arange(len(lengths) + 1))
        self.seen = np.zeros(len(self.term) + 1, bool)  # of postings, in the search that runs
        self.met = np.zeros(len(lengths), bool)
        self.wanted = np.zeros(len(corpus.weight), bool)

    def search(self, item: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that include the shard's best k; scores below `floor` may be left out.

        `floor` is a score that k documents elsewhere reach.
        """
        item = item[self.starts[item + 1] > self.starts[item]]
        best, ends = self.starts[item].copy(), self.starts[item + 1]  # the first unseen place of each list
        self.wanted[item] = True
        found, scores, places = [], [], []
        kth, read = floor, FIRST_READ
        while True:
            open_lists = best < ends
            bound = int(self.impact[best[open_lists]].sum())
            if bound == 0 or bound < kth:
                break
            ahead = (best[open_lists, None] + np.arange(read)).ravel()
            inside = (ahead < np.repeat(ends[open_lists], read)) & ~self.seen[np.minimum(ahead, len(self.term))]
            new = np.unique(self.document[ahead[inside]])
            new = new[~self.met[new]]
            self.met[new] = True
            # Direct access: all places of the new documents in the item's lists.
            first, size = self.document_starts[new], self.document_starts[new + 1] - self.document_starts[new]
            owner = np.repeat(np.arange(len(new)), size)
            at = self.by_document[np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)]
            own = self.wanted[self.term[at]]
            at, owner = at[own], owner[own]
            self.seen[at] = True
            total = np.zeros(len(new), np.int64)
            np.add.at(total, owner, self.impact[at])
            found.append(new)
            scores.append(total)
            places.append(at)
            for i in np.flatnonzero(open_lists):
                best[i] = self._first_unseen(int(best[i]), int(ends[i]))
            whole = np.concatenate(scores)
            if len(whole) >= k:
                kth = max(floor, int(np.partition(whole, len(whole) - k)[len(whole) - k]))
            read *= 2
        self.wanted[item] = False
        for new, at in zip(found, places):
            self.met[new] = False
            self.seen[at] = False
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        documents, whole = np.concatenate(found), np.concatenate(scores)
        good = whole >= max(kth, 1)
        return documents[good], whole[good]

    def _first_unseen(self, start: int, end: int) -> int:
        """The first place from `start` on that is not seen, or `end`."""
        step = 64
        while start < end:
            part = self.seen[start : min(end, start + step)]
            gap = int(part.argmin())
            if not part[gap]:
                return start + gap
            start += len(part)
            step *= 2
        return end


class Best:
    """The best k documents of each item so far: highest score, then smallest id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]

    def floor(self, item: int) -> int:
        rows = self.rows[item]
        return rows[-1][0] if len(rows) == self.k else 0

    def add(self, item: int, documents: Sequence[object], scores: Sequence[int]) -> None:
        new = [(s, d is None, 0 if d is None else d) for d, s in zip(documents, scores)]
        self.rows[item] = heapq.nsmallest(self.k, [*self.rows[item], *new], key=lambda r: (-r[0], r[1], r[2]))


def _hits(text: str | None, vocabulary: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """The number of a text's terms, and the occurrences of the query terms."""
    own = terms(text)
    return len(own), Counter(map(vocabulary.get, own))


def _counted(docs: DataFrame, items: Broadcast) -> Corpus:
    """Counts over all documents. A task returns a row per query term at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = items.value.vocabulary
        frequency: Counter[int] = Counter()
        documents = occurrences = 0
        for _, texts in text_portions(batches, BYTES_AT_ONCE):
            for text in texts:
                own = terms(text)
                documents += bool(own)
                occurrences += len(own)
                frequency.update(n for n in map(vocabulary.get, set(own)) if n is not None)
        columns = [[-1, *frequency], [documents, *frequency.values()], [occurrences, *[0] * len(frequency)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "n", "occurrences"])

    rows = (
        docs.select("text")
        .mapInArrow(count, "term bigint, n bigint, occurrences bigint")
        .groupBy("term")
        .agg(F.sum("n").alias("n"), F.sum("occurrences").alias("occurrences"))
        .collect()  # a row per term of the block
    )
    frequency = np.zeros(len(items.value.vocabulary), np.int64)
    documents = occurrences = 0
    for r in rows:
        if r.term < 0:
            documents, occurrences = r.n, r.occurrences
        else:
            frequency[r.term] = r.n
    return Corpus.of(documents, occurrences, frequency)


def _searched(docs: DataFrame, items: Broadcast, corpus: Corpus, k: int, item_type: pa.DataType, schema: str) -> DataFrame:
    """The best k documents of every task for each item of the block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Items = items.value
        best = Best(len(block.ids), k)
        ids: list[object] = []
        lengths: list[int] = []
        postings: list[tuple[list[int], list[int], int]] = []  # terms and occurrences of a document
        hits = 0

        def settle() -> None:
            nonlocal hits
            sizes = [len(p[0]) for p in postings]
            shard = Shard(
                np.repeat(np.arange(len(ids)), sizes),
                np.array([t for p in postings for t in p[0]], np.int64),
                np.array([c for p in postings for c in p[1]], np.int64),
                np.array(lengths, np.int64),
                corpus,
            )
            for i, wanted in enumerate(block.terms):
                documents, scores = shard.search(wanted, k, best.floor(i))
                if len(documents):
                    best.add(i, [ids[d] for d in documents.tolist()], scores.tolist())
            ids.clear(), lengths.clear(), postings.clear()
            hits = 0

        for batch, texts in text_portions(batches, BYTES_AT_ONCE):
            for name, text in zip(batch.column(0).to_pylist(), texts):
                n, found = _hits(text, block.vocabulary)
                found.pop(None, None)
                if found:
                    ids.append(name)
                    lengths.append(n)
                    postings.append((list(found), list(found.values())))
                    hits += len(found)
                    if hits >= SHARD_HITS:
                        settle()
        if ids:
            settle()
        rows = [(block.ids[i], None if missing else d, s) for i, own in enumerate(best.rows) for s, missing, d in own]
        if rows:
            columns = list(zip(*rows))
            kinds = (item_type, pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["item_id", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, schema)


def _item_terms(items: DataFrame) -> DataFrame:
    """`item_id, terms`: the distinct terms of every item that has one, as UTF-8."""
    kind = items.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_portions(batches, BYTES_AT_ONCE):
            found = [sorted(set(terms(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    each = items.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, terms array<binary>")
    return each.select("item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """`item_id, rank, doc_id, score`: the k highest-scoring documents (`doc_id, text`) of each item (`item_id, text`)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType
    schema = f"item_id {item_type.simpleString()}, doc_id bigint, score bigint"
    found = staged(_item_terms(items), "items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 8)
    total = found.agg(F.sum(size)).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    tops = []
    for block in range(blocks):
        rows = found.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        held = spark.sparkContext.broadcast(Items.of([(r.item_id, sorted(r.terms)) for r in rows]))
        tops.append(_searched(docs, held, _counted(docs, held), k, to_arrow_type(item_type), schema))
    best = reduce(DataFrame.unionAll, tops) if tops else spark.createDataFrame([], schema)
    by_score = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    within = Window.partitionBy("item_id", salt).orderBy(*by_score)
    cut = best.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*by_score))
    return cut.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
