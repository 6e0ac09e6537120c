"""Registered queries over whole tables, against plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from cashwatch.llm.queries import QUERIES, vocabulary_path
from tests.llm import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    return [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64)


def by_id(spark, name, key="doc_id"):
    rows = [r.asDict() for r in QUERIES[name](spark, DATA).collect()]
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_op1_nearest_neighbours(spark, vectors):
    ids, x = vectors
    found = defaultdict(list)
    for r in QUERIES["op1_nearest_neighbours"](spark, DATA).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in ids if i % 20 == 0}
    place = {i: n for n, i in enumerate(ids)}
    hits = wanted = 0
    for query, rows in found.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert all(abs(s - x[place[query]] @ x[place[v]]) < 1e-12 and v != query for _, v, s in rows)
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        scores = x @ x[place[query]]
        best = sorted((-scores[place[i]], i) for i in ids if i != query)[:20]
        hits += len({i for _, i in best} & {v for _, v, _ in rows})
        wanted += 20
    assert hits / wanted >= 0.9


def test_op2_language_id(spark, docs):
    rows = QUERIES["op2_language_id"](spark, DATA).collect()
    found = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(found) == len(docs)
    right = [found[d["doc_id"]]["language"] == d["lang"] for d in docs]
    assert np.mean(right) > 0.97
    assert np.mean([found[d["doc_id"]]["accepted"] for d in docs]) > 0.97
    assert sum(r["page_id"] is not None for r in rows) == spark.read.parquet(f"{DATA}/pages.parquet").count()


def test_op3_ngram_jaccard(spark, docs):
    found = by_id(spark, "op3_ngram_jaccard")
    expected = brute.jaccard_components([(d["doc_id"], d["text"]) for d in docs])
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in found.items()} == expected


def test_op4_substring_dedup(spark, docs):
    found = by_id(spark, "op4_substring_dedup")
    rows = sorted((d["doc_id"], d["text"]) for d in docs)
    for (doc_id, _), (chunks, repeated, chars, removable, spans) in zip(rows, brute.repeated_runs(rows)):
        row = found[doc_id]
        assert [row["n_chunks"], row["n_repeated"], row["repeated_chars"]] == [chunks, repeated, chars], doc_id
        assert row["removable_chars"] == removable
        assert row["spans"] == ",".join(f"{a}:{b}" for a, b in spans)
    assert sum(r["n_repeated"] > 0 for r in found.values()) > 5


def test_op5_secret_scan(spark, docs):
    found = by_id(spark, "op5_secret_scan")
    for d in docs:
        spans, row = brute.secret_spans(d["text"]), found[d["doc_id"]]
        kinds = Counter(s[2] for s in spans)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [kinds[k] for k in ("assign", "access", "hex")]
        assert row["base_sha256"] == brute.digest(brute.joined(spans))
        assert set(filter(None, brute.joined(spans).split(","))) <= set(row["spans"].split(","))


def test_op6_bpe(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    library.no_truncation()
    library.no_padding()
    found = by_id(spark, "op6_bpe")
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        row = found[d["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == brute.digest(library.decode(ids, skip_special_tokens=False))


def test_op7_embedding_near_dedup(spark, vectors):
    ids, x = vectors
    found = by_id(spark, "op7_embedding_near_dedup", "vec_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    root = brute.groups(len(ids), lambda i, j: near[i, j])
    least = {r: min(i for i, s in zip(ids, root) if s == r) for r in set(root)}
    for n, i in enumerate(ids):
        row = found[i]
        assert row["n_links"] == near[n].sum() - 1
        assert row["component_id"] == least[root[n]]
        assert row["kept"] == (i == row["component_id"])


def test_op8_sharding(spark, docs):
    found = by_id(spark, "op8_sharding")
    assert len(found) == len(docs)
    counts = Counter(r["shard"] for r in found.values())
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    groups = defaultdict(list)
    for d in docs:
        row = found[d["doc_id"]]
        assert row["size"] == len((d["text"] or "").encode()) + 8 and row["text_crc32"] == brute.crc(d["text"])
        slots[row["shard"]].append(row["slot"])
        groups[d["text"]].append(row["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    several = [g for g in groups.values() if len(g) > 1]
    together = sum(max(Counter(g).values()) for g in several)
    assert together >= 0.8 * sum(map(len, several))


def test_op9_mixing(spark, docs):
    found = by_id(spark, "op9_mixing")
    assert {k: r["taken"] for k, r in by_id(spark, "op9_mixing").items()} == {k: r["taken"] for k, r in found.items()}
    sizes, taken, target = Counter(), Counter(), {}
    for d in docs:
        row = found[d["doc_id"]]
        assert row["size"] == len(brute.words(d["text"]))
        assert 0 <= row["taken"] <= 2 * row["size"]
        sizes[d["source"]] += row["size"]
        taken[d["source"]] += row["taken"]
        target[d["source"]] = row["target"]
    expected = brute.targets(sizes)
    for source, size in sizes.items():
        assert target[source] == pytest.approx(expected[source], rel=1e-9)
        assert abs(taken[source] - target[source]) <= 1
    for d in docs:
        assert found[d["doc_id"]]["source_size"] == sizes[d["source"]]


def test_op10_pii(spark, docs):
    found = by_id(spark, "op10_pii")
    for d in docs:
        spans, row = brute.pii_spans(d["text"]), found[d["doc_id"]]
        kinds = Counter(s[2] for s in spans)
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert row["base_sha256"] == brute.digest(brute.joined(spans))
        assert set(filter(None, brute.joined(spans).split(","))) <= set(row["spans"].split(","))
