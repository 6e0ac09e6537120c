"""Packing of tokenized documents into training sequences by multiway differencing.

A document is its token ids and one end id. Its full windows are sequences of their own; the
rest of it waits in the task until a group of rests fills `GROUP` windows but for `SLACK` tokens
each. A group is dealt to that many windows by the Karmarkar-Karp method: every rest starts as a
partial partition with one filled window; the two of the largest imbalance are merged, the
fullest windows of one with the emptiest of the other, until one is left. A few rests are first
cut into halves, quarters and so on, so that late merges have small parts to even out with.
Where a window exceeds the capacity, more rests are cut, and at last the window count rises.

Rows are packed where they are read: nothing is shuffled, a task holds one group and one portion
of texts, and groups do not grow with the input. What a task is left with at its end, less than
a group, is packed likewise; its last tokens, less than a window, go to sequences of powers of
two, which need no padding.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as
they come; a null id is passed on; an empty table gives an empty result; columns other than the
id and the text are ignored. A sequence's number holds the number of its task, so the input
should be a table that is read (a scan deals rows to tasks in the same way each time).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cashwatch.llm.bpe import _WORD, Encoder, Vocabulary, encode_words
from cashwatch.llm.common import text_portions

END_ID = 1
WINDOW = 2048
GROUP = 16  # windows that are filled together
SLACK = 2  # tokens left free in each of them, on average
CUTS = (6, 10, 14)  # rests that are cut, tried in this order
TASK_BITS = 33  # a sequence's number is its task's number and a count of so many bits

MEMORY = 500_000  # remembered words
LONGEST_KEPT = 200
AFTER_LATIN = "\u0250"  # the first letter after the Latin blocks
BYTES_AT_ONCE = 8_000_000

Rest = tuple[object, int, bytes, int]  # id, tokens of the document before it, token ids, tokens of the document
Piece = tuple[object, int, bytes, int, int, int]  # the same, sequence, offset


class Tokens:
    """Ids of texts, each distinct word of a portion looked up once.

    Words that come again are remembered; when there are too many, those that the portion at hand
    does not hold are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.cutter = Encoder(vocabulary)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _words(piece: str) -> list[str]:
        """The words of a piece: a plain word, perhaps with one sign behind it, is cut without a
        search. Of Latin letters all character tables know the same."""
        if piece.isascii() or max(piece) < AFTER_LATIN:
            if piece.isalpha():
                return [piece]
            if piece[:-1].isalpha() and not piece[-1].isalnum():
                return [piece[:-1], piece[-1]]
        return _WORD.findall(piece)

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > MEMORY:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        known = self.known
        for token, number in self.v.special.items():
            known[token.upper()] = number.to_bytes(4, "little")
        new = [p for p in pieces if p not in known]
        split = list(map(self._words, new))
        words = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known]
        known.update(zip(words, encode_words(words, self.v)))
        for piece, own in zip(new, split):
            if len(own) != 1:  # else it is the word itself
                known[piece] = b"".join([known[w] for w in own])
        ids = list(map(known.__getitem__, pieces))
        for piece in chain(words, new):
            if len(piece) > LONGEST_KEPT:
                known.pop(piece, None)
        return ids

    def of(self, texts: Sequence[str | None], end_id: int) -> tuple[bytes, list[int]]:
        """Little-endian 32-bit ids of all texts, each closed by `end_id`, and where each ends."""
        pieces = [self.cutter._pieces(t) if t else [] for t in texts]
        distinct = pa.array(list(chain.from_iterable(pieces)), pa.large_string()).dictionary_encode()
        ids = self._ids_of(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        stock = np.frombuffer(b"".join(ids), "<u4")
        which = np.asarray(distinct.indices)
        each = size[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat(start[which] - upto[:-1], each) + np.arange(upto[-1])
        ends = upto[np.cumsum([len(p) for p in pieces])]
        whole = np.insert(stock[at], ends, end_id).astype("<u4")
        return whole.tobytes(), (ends + np.arange(1, len(ends) + 1)).tolist()


def difference(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """Deal items to windows by Karmarkar-Karp multiway differencing; the items of each window.

    A partial partition keeps its windows from full to empty, less what the emptiest holds. The
    two of the largest difference between fullest and emptiest are merged until one is left.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    heap = [(-n, i, [n] + [0] * (windows - 1), [[i]] + [[] for _ in range(windows - 1)]) for i, n in enumerate(sizes)]
    heapq.heapify(heap)
    for turn in range(len(sizes), 2 * len(sizes) - 1):
        _, _, a, items_a = heapq.heappop(heap)
        _, _, b, items_b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b))]
        items = [x + y for x, y in zip(items_a, reversed(items_b))]
        order = sorted(range(windows), key=sums.__getitem__, reverse=True)
        least = sums[order[-1]]
        merged = [sums[w] - least for w in order]
        heapq.heappush(heap, (-merged[0], turn, merged, [items[w] for w in order]))
    return heap[0][3]


def _split(rest: Rest, at: int) -> tuple[Rest, Rest]:
    key, start, ids, total = rest
    return (key, start, ids[: 4 * at], total), (key, start + at, ids[4 * at :], total)


def _halves(rest: Rest) -> list[Rest]:
    """A half, a quarter and so on of the rest, down to one token."""
    out = []
    while len(rest[2]) > 4:
        first, rest = _split(rest, (len(rest[2]) // 4 + 1) // 2)
        out.append(first)
    return [*out, rest]


def balanced(rests: list[Rest], windows: int, capacity: int) -> list[list[Rest]]:
    """The rests in windows of at most `capacity` tokens: more are cut, then windows added."""
    rests = sorted(rests, key=lambda r: len(r[2]), reverse=True)
    while True:
        for cuts in CUTS:
            parts = [p for r in rests[:cuts] for p in _halves(r)] + rests[cuts:]
            dealt = difference([len(p[2]) // 4 for p in parts], windows)
            filled = [[parts[i] for i in w] for w in dealt]
            if max(sum(len(p[2]) for p in w) for w in filled) <= 4 * capacity:
                return filled
            if cuts >= len(rests):
                break
        windows += 1


class Packer:
    """Packs the documents of one task as they come; `pieces` gathers what is settled."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.target = GROUP * (window - min(SLACK, window - 1))
        self.rests: list[Rest] = []
        self.held = 0
        self.pieces: list[Piece] = []

    def _emit(self, parts: Sequence[Rest]) -> None:
        offset = 0
        for part in parts:
            self.pieces.append((*part, self.sequence, offset))
            offset += len(part[2]) // 4
        self.sequence += offset > 0

    def add(self, key: object, ids: bytes) -> None:
        total = len(ids) // 4
        full = total - total % self.window
        for start in range(0, full, self.window):
            self._emit([(key, start, ids[4 * start : 4 * (start + self.window)], total)])
        rest = (key, full, ids[4 * full :], total)
        while rest[2]:
            now, rest = _split(rest, min(len(rest[2]) // 4, self.target - self.held))
            self.rests.append(now)
            self.held += len(now[2]) // 4
            if self.held == self.target:
                self._flush(GROUP)

    def _flush(self, windows: int) -> None:
        for parts in balanced(self.rests, windows, self.window):
            self._emit(parts)
        self.rests, self.held = [], 0

    def close(self) -> None:
        """Full windows of what is left, then sequences of powers of two."""
        windows = self.held // self.window
        room = windows * (self.window - min(SLACK, self.window - 1))
        waiting, self.rests, self.held = self.rests, [], 0
        tail = []
        for rest in waiting:
            now, later = _split(rest, min(len(rest[2]) // 4, room - self.held))
            if now[2]:
                self.rests.append(now)
                self.held += len(now[2]) // 4
            if later[2]:
                tail.append(later)
        if windows:
            self._flush(windows)
        left = sum(len(r[2]) for r in tail) // 4
        while left:
            size = min(1 << (left.bit_length() - 1), self.window)
            left -= size
            parts = []
            while size:
                now, later = _split(tail[0], min(size, len(tail[0][2]) // 4))
                parts.append(now)
                size -= len(now[2]) // 4
                tail[:1] = [later] if later[2] else []
            self._emit(parts)

    def taken(self) -> list[Piece]:
        out, self.pieces = self.pieces, []
        return out


def packed(
    docs: DataFrame, vocabulary_path: str, window: int = WINDOW, end_id: int = END_ID, key: str = "doc_id"
) -> DataFrame:
    """One row per piece: the document's `key`, `start`, `token_ids` (little-endian 32-bit, as
    binary), `length`, `doc_tokens`, and where it lies: `sequence_id`, `offset`.

    Every token lies in exactly one piece, and the pieces of a sequence follow each other without
    a gap. The vocabulary, a file of fixed size, goes to the tasks as a broadcast value.
    """
    docs = docs.select(key, "text")
    kind = docs.schema[key].dataType.simpleString()
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))

    def rows(pieces: list[Piece], key_type: pa.DataType) -> pa.RecordBatch:
        keys, start, ids, total, sequence, offset = zip(*pieces)
        numbers = [start, [len(x) // 4 for x in ids], total, sequence, offset]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, key_type), pa.array(ids, pa.binary()), *[pa.array(n, pa.int64()) for n in numbers]],
            names=[key, "token_ids", "start", "length", "doc_tokens", "sequence_id", "offset"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(vocabulary.value)
        packer = Packer(window, TaskContext.get().partitionId() << TASK_BITS)
        key_type = None
        for batch, texts in text_portions(batches, BYTES_AT_ONCE):
            key_type = batch.column(0).type
            ids, ends = tokens.of(texts, end_id)
            for name, a, b in zip(batch.column(0).to_pylist(), [0, *ends], ends):
                packer.add(name, ids[4 * a : 4 * b])
            if done := packer.taken():
                yield rows(done, key_type)
        packer.close()
        if done := packer.taken():
            yield rows(done, key_type)

    fields = "token_ids binary, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.mapInArrow(pack, f"`{key}` {kind}, {fields}")
