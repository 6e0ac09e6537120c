"""Ranked search against SQL; the algorithm's bounds and its early stop."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cashwatch.llm import ranked
from cashwatch.llm.queries import op13_ranked_search
from cashwatch.llm.ranked import Corpus, Shard, ranked_search, terms
from cashwatch.llm.sql import ORACLE_SQL

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def by_sql(documents, benchmark):
    con = duckdb.connect()
    for name, rows, key in (("documents", documents, "doc_id"), ("benchmark", benchmark, "item_id")):
        if isinstance(rows, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{rows}'")
        else:
            con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    return sorted(con.execute(ORACLE_SQL["op13_ranked_search"]).fetchall(), key=str)


def rows_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("hits", [ranked.SHARD_HITS, 5000])
def test_whole_tables_equal_sql(spark, monkeypatch, hits):
    monkeypatch.setattr(ranked, "SHARD_HITS", hits)
    sf = "/root/testdata/sf0.01"
    found = rows_of(op13_ranked_search(spark, sf))
    assert found == by_sql(f"{sf}/documents.parquet", f"{sf}/benchmark.parquet") and found


def test_many_blocks_of_items_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 100)
    monkeypatch.setattr(ranked, "SHARD_HITS", 20)
    monkeypatch.setattr(ranked, "SALTS", 2)
    rng = random.Random(5)
    words = ["ä", "B2", "cat", "Dog", "e-f", "x\x00y", "ſ", "İ", "10.5"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(6)))) for i in range(120)] + [(7, None), (500, "cat Dog"), (501, "cat Dog")]
    items = [(i, " ".join(rng.choices(words, k=3))) for i in range(12)] + [(3, "more CAT"), (90, None), (91, "--"), (92, "absent")]
    found = rows_of(ranked_search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)))
    assert found == by_sql(docs, items)


def test_edges(spark):
    long = "needle " + "hay " * 100_000
    docs = [(1, long), (2, "needle"), (2, "needle"), (None, "needle"), (3, ""), (4, None), (5, "other words")]
    items = [(1, "needle"), (None, "needle needle"), (2, None)]
    frame = spark.createDataFrame(docs, DOCS).withColumns({"item_id": F.lit("x"), "rank": F.lit(1), "term": F.lit(2)})
    wanted = spark.createDataFrame(items, ITEMS).withColumns({"doc_id": F.lit("y"), "terms": F.lit(0)})
    found = rows_of(ranked_search(frame, wanted))
    assert found == by_sql(docs, items)
    assert [r[2] for r in sorted((r for r in found if r[0] == 1), key=lambda r: r[1])] == [2, 2, None, 1]
    assert ranked_search(frame.limit(0), wanted).count() == 0
    assert ranked_search(frame, wanted.limit(0)).count() == 0


def test_terms():
    assert terms("Äb-C9_d\x7fé x") == ["Äb".encode(), b"c9", b"d", "é x".encode()]
    assert terms(None) == terms("") == terms(" ._-") == []


class _Counted(np.ndarray):
    """Notes how many places are looked up."""

    read: list[int] = []

    def __getitem__(self, at):
        _Counted.read.append(len(at))
        return np.asarray(self).__getitem__(at)


def test_stops_early_and_misses_nothing():
    rng = np.random.default_rng(3)
    documents, vocabulary, k = 5000, 40, 10
    held = rng.random((documents, vocabulary)) < 0.2
    count = np.where(held, rng.geometric(0.5, held.shape), 0)
    count[:20, :5] = 200
    d, t = np.nonzero(count)
    corpus = Corpus.of(documents, int(count.sum()), held.sum(0) + 5)
    shard = Shard(d, t, count[d, t].astype(np.int64), count.sum(1), corpus)
    scaled = 10 + 90 * count.sum(1) * documents // int(count.sum())
    for item in (np.arange(5), np.array([7]), np.arange(30, 40)):
        impact = corpus.weight[item] * ((1_000_000_000 * count[:, item]) // np.maximum(1, 1000 * count[:, item] + 8 * scaled[:, None]))
        scores = impact.sum(1)
        for floor in (0, int(np.sort(scores)[-3]), int(scores.max()) + 1):
            found, own = shard.search(item, k, floor)
            assert (scores[found] == own).all()
            least = max(floor, np.sort(scores)[-k])
            assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
        assert not shard.seen.any() and not shard.met.any() and not shard.wanted.any()
    # Twenty documents lead by far: the rounds end long before two thirds of all documents are met.
    read = []
    shard.by_document = shard.by_document.view(_Counted)
    _Counted.read = read
    shard.search(np.arange(5), k, 0)
    assert 0 < sum(read) < 0.25 * len(d)
