"""Packing: every token once, gapless sequences, little padding, the ids of the library."""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cashwatch.llm.packing import GROUP, Packer, balanced, difference, packed
from cashwatch.llm.queries import op11_packing, vocabulary_path

SF = "/root/testdata/sf0.01"


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [array("I", [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]).tobytes() for t in texts]


def padding(lengths, window):
    return sum(window - n for n in lengths if n & (n - 1))


def rejoined(pieces):
    """Documents and sequences put together from (key, start, ids, total, sequence, offset); asserts no gap."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for key, start, ids, total, sequence, offset in pieces:
        assert ids
        docs[key].append((start, ids, total))
        sequences[sequence].append((offset, ids))
    whole = {}
    for key, parts in docs.items():
        at = 0
        for start, ids, total in sorted(parts):
            assert start == at
            at += len(ids) // 4
        assert {total for *_, total in parts} == {at}
        whole[key] = b"".join(ids for _, ids, _ in sorted(parts))
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, ids in sorted(parts):
            assert offset == at
            at += len(ids) // 4
        lengths.append(at)
    return whole, lengths


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=150), st.sampled_from([1, 2, 3, 16, 64]))
def test_any_documents_come_back_whole(sizes, window):
    packer = Packer(window, 0)
    docs = {k: array("I", range(k, k + n)).tobytes() for k, n in enumerate(sizes)}
    for k, ids in docs.items():
        packer.add(k, ids)
    packer.close()
    whole, lengths = rejoined(packer.taken())
    assert whole == docs
    assert all(0 < n <= window for n in lengths)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=80), st.integers(1, 9))
def test_differencing_deals_every_item_once_and_near_equal(sizes, windows):
    dealt = difference(sizes, windows)
    assert sorted(i for w in dealt for i in w) == list(range(len(sizes))) and len(dealt) == windows
    sums = [sum(sizes[i] for i in w) for w in dealt]
    assert max(sums) - min(sums) <= max(sizes)


def test_differencing_of_a_known_case():
    # Two-way differencing of 8, 7, 6, 5, 4 ends with a difference of 2: 14 and 16.
    assert sorted(sum((8, 7, 6, 5, 4)[i] for i in w) for w in difference([8, 7, 6, 5, 4], 2)) == [14, 16]


def test_the_window_count_rises_when_capacity_is_exceeded():
    rests = [("a", 0, b"\0" * 4 * 10, 10)] * 5
    filled = balanced(rests, 2, 16)
    assert len(filled) > 2 and all(sum(len(p[2]) for p in w) <= 64 for w in filled)
    assert sum(len(p[2]) for w in filled for p in w) == 200


def test_whole_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in packed(docs, vocabulary_path()).select(
        "doc_id", "start", "token_ids", "doc_tokens", "sequence_id", "offset").collect()]
    whole, lengths = rejoined([(k, s, bytes(i), t, q, o) for k, s, i, t, q, o in rows])
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert whole == dict(zip(texts, library_ids(texts.values())))
    assert padding(lengths, 2048) < 0.003 * sum(lengths)
    digests = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in op11_packing(spark, SF).collect()}
    assert digests == {(k, s): (len(i) // 4, zlib.crc32(bytes(i))) for k, s, i, *_ in rows}


def test_edges(spark):
    long = "word " * 50_000
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, long), (5, " \t\n")] + [(6, None)] * 3000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("x")).withColumn("token_ids", F.lit(1)).coalesce(1)
    found = packed(docs, vocabulary_path()).collect()
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
    assert [r.length for r in by_id[1]] == [1] and bytes(by_id[1][0].token_ids) == b"\1\0\0\0"
    assert sum(r.length for r in by_id[3]) == 6 and sum(r.length for r in by_id[None]) == 2
    assert sum(r.length for r in by_id[4]) == 50_001 and len(by_id[6]) == 3000
    sequences = defaultdict(int)
    for r in found:
        sequences[r.sequence_id] += r.length
    assert padding(sequences.values(), 2048) <= 2 * GROUP * (len(sequences) // GROUP + 1)
    empty = packed(docs.limit(0), vocabulary_path())
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_padding_is_little_however_rows_lie(spark, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(parts)
    lengths = [r.n for r in packed(docs, vocabulary_path()).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert padding(lengths, 2048) < 0.003 * sum(lengths)
