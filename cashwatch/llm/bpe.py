"""Byte-pair encoding with a pair occurrence index, and decoding.

A task gathers the words of a batch of texts that it has not met yet and lays their symbols
out in one sequence. An index maps each adjacent pair to all its positions there. The ranks
of the pairs present are applied in ascending order: a rank merges all its positions at once
and adds the pairs this makes to the index. A text is then the concatenation of its words'
ids. What a task remembers of words is cleared when it is full, which costs time only.

Defined cases: a null text is an empty one and has no tokens; special tokens written in a text
are those tokens; repeated rows have equal results; an empty table gives an empty result; other
columns of the input are passed through.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cashwatch.llm.common import text_portions

MEMORY = 120_000
LONGEST_KEPT = 200  # longer words are encoded but not remembered
BYTES_AT_ONCE = 3_000_000  # of text that a task holds in pieces
_GAP, _GONE = -1, -2

# How the vocabulary's text is cut into words, after NFC, single spaces and
# lower case. White space is listed, as libraries differ on the information separators.
_SPACE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_SPACES = regex.compile(rf"[{_SPACE}]+")
WORD_END = "</w>"
# Lower case of capitals newer than some libraries' character tables.
_NEWER_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_NEWER_CAPITALS |= {c: c + 32 for c in range(0x10D50, 0x10D66)}
_NEWER = regex.compile(f"[{''.join(map(chr, _NEWER_CAPITALS))}]")
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself where it prints, else the next free letter from 256."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in prints else next(free)) for b in range(256)]


@dataclass
class Vocabulary:
    """Ids of bytes (inside and at the end of a word), merges by pair, and texts by id."""

    inside: np.ndarray
    at_end: np.ndarray
    pairs: list[tuple[int, int, int]]  # by rank: left, right, merged
    special: dict[str, int]
    tokens: dict[int, str]

    def __post_init__(self) -> None:
        keys = np.array([(a << 32) | b for a, b, _ in self.pairs], np.int64)
        self._rank_at = np.argsort(keys, kind="stable")
        self._keys = keys[self._rank_at]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        return cls(
            inside=np.array([ids[c] for c in letters], np.int64),
            at_end=np.array([ids[c + WORD_END] for c in letters], np.int64),
            pairs=[(ids[a], ids[b], ids[a + b]) for a, b in spec["model"]["merges"]],
            special=special,
            tokens={i: t for t, i in [*ids.items(), *special.items()]},
        )

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 where a pair has none."""
        keys = (left << 32) | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._rank_at[at], -1)


def encode_words(words: Sequence[str], v: Vocabulary) -> list[bytes]:
    """Ids of each word as little-endian 32-bit numbers. All words share one pair index."""
    if not words:
        return []
    raw = [w.encode("utf-8") for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    last = np.cumsum(lengths + 1) - 2  # of each word, which a separator follows
    letters = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
    symbols = v.inside[letters]
    symbols[last] = v.at_end[letters[last]]
    symbols[last + 1] = _GAP
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)

    index: dict[int, list[np.ndarray]] = {}  # rank of a pair -> positions of its left symbol
    active: list[int] = []

    def note(left: np.ndarray, right: np.ndarray) -> None:
        ranks = v.ranks(symbols[left], symbols[right])
        found = np.flatnonzero(ranks >= 0)
        if len(found) == 0:
            return
        order = found[np.argsort(ranks[found], kind="stable")]
        ranks, left = ranks[order], left[order]
        starts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()]
        for rank, start, stop in zip(ranks[starts].tolist(), starts, [*starts[1:], len(left)]):
            if rank in index:
                index[rank].append(left[start:stop])
            else:
                index[rank] = [left[start:stop]]
                heapq.heappush(active, rank)

    note(np.arange(n - 1), np.arange(1, n))
    while active:
        rank = heapq.heappop(active)
        left_symbol, right_symbol, merged = v.pairs[rank]
        lists = index.pop(rank)
        i = np.unique(np.concatenate(lists) if len(lists) > 1 else lists[0])
        i = i[symbols[i] == left_symbol]
        i = i[symbols[after[i]] == right_symbol]  # else an earlier merge used one of the two
        if left_symbol == right_symbol:
            i = _every_other(i, after)
        if len(i) == 0:
            continue
        j = after[i]
        k = after[j]
        symbols[i], symbols[j] = merged, _GONE
        after[i], before[k] = k, i
        h = before[i]
        known = h >= 0
        note(np.concatenate([i, h[known]]), np.concatenate([k, i[known]]))

    alive = symbols >= 0
    ids = symbols[alive].astype("<u4")
    ends = np.cumsum(alive)[last + 1]
    whole = ids.tobytes()
    return [whole[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _every_other(i: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping places of a doubled symbol, the first, third and so on of each run."""
    chained = np.zeros(len(i), bool)
    chained[1:] = after[i[:-1]] == i[1:]
    run = np.maximum.accumulate(np.where(chained, 0, np.arange(len(i))))
    return i[(np.arange(len(i)) - run) % 2 == 0]


def lowered(text: str) -> str:
    """NFC and lower case, letter by letter: without the special final form of sigma."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        if _NEWER.search(text):
            text = text.translate(_NEWER_CAPITALS)
    return text.lower()


class Encoder:
    """Encodes batches of texts; remembers the ids of what stood between spaces, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def _cut(self, text: str) -> list[str]:
        """The text between white space. No word crosses it, so chunks are encoded for themselves."""
        text = lowered(text)
        # str.split also cuts at four control characters that are no white space here.
        return _SPACES.split(text) if any(c in text for c in _SEPARATORS) else text.split()

    def _pieces(self, text: str) -> list[str]:
        """Chunks; special tokens, cut out before anything else, stand in capitals."""
        if self.special is None or "<|" not in text or not self.special.search(text):
            return self._cut(text)
        out: list[str] = []
        at = 0
        for m in self.special.finditer(text):
            out += [*self._cut(text[at : m.start()]), m[0].upper()]
            at = m.end()
        return out + self._cut(text[at:])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; the new words of all texts share one index."""
        if len(self.chunks) > MEMORY or len(self.words) > MEMORY:
            self.chunks.clear()
            self.words.clear()
        for token, number in self.v.special.items():
            self.chunks[token.upper()] = number.to_bytes(4, "little")
        cut = [self._pieces(text or "") for text in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in self.chunks]
        split = [_WORD.findall(p) for p in new]
        words = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in self.words]
        self.words.update(zip(words, encode_words(words, self.v)))
        for piece, own in zip(new, split):
            self.chunks[piece] = b"".join(map(self.words.__getitem__, own))
        out = [b"".join(map(self.chunks.__getitem__, pieces)) for pieces in cut]
        for memory, added in ((self.words, words), (self.chunks, new)):
            for x in added:
                if len(x) > LONGEST_KEPT:
                    del memory[x]
        return out

    def decode(self, ids: bytes) -> str:
        """Token texts joined by spaces: the vocabulary names no decoder."""
        return " ".join(map(self.v.tokens.__getitem__, array("I", ids)))


def with_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """`docs` plus `token_ids` (little-endian 32-bit ids as binary), `n_tokens` and `decoded`.

    Columns of these names that `docs` has are replaced. The vocabulary, a file of fixed size,
    goes to the tasks as a broadcast value.
    """
    new = ["token_ids", "n_tokens", "decoded"]
    docs = docs.drop(*new)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch, texts in text_portions(batches, BYTES_AT_ONCE):
            ids = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(ids, pa.binary()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(map(encoder.decode, ids), pa.string()),
                ],
                names=[*batch.schema.names, *new],
            )

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(encode, ", ".join([*types, "token_ids binary, n_tokens bigint, decoded string"]))
