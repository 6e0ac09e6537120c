"""Rows of a token meet only sets of like size, and no linked pair is lost by it."""

from __future__ import annotations

import random

import pytest

from cashwatch.llm import jaccard
from cashwatch.llm.jaccard import Rule, jaccard_join
from tests.llm import brute


def test_tokens_without_a_set_of_like_size_are_dropped(spark):
    rng = random.Random(2)
    rows = [(1, 10, 100), (1, 11, 79), (1, 12, 126), (2, 10, 100), (2, 11, 80), (2, 11, 80), (3, 10, 100), (3, 10, 100)]
    rows += [(rng.randrange(10, 600), c, 1 + c % 97) for c in range(2000) for _ in range(rng.randrange(4))]
    frame = spark.createDataFrame(rows, "token long, c long, n int").repartition(5)
    kept = [tuple(r) for r in jaccard._repeated(frame, Rule()).collect()]
    distinct = set(rows)
    expected = {
        (t, c, n)
        for t, c, n in distinct
        if any(t == u and c != d and 100 * min(n, m) >= 80 * max(n, m) for u, d, m in distinct)
    }
    assert len(kept) == len(set(kept)) and set(kept) == expected
    assert {(2, 10, 100), (2, 11, 80)} <= expected and not {t for t, _, _ in expected} & {1, 3}


@pytest.mark.parametrize("block", [4, 1024])
def test_components_of_texts_of_all_sizes_around_shared_passages(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(6)
    texts = []
    for _ in range(25):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(1, 6)):
            more = [f"v{rng.randrange(40)}" for _ in range(rng.randrange(0, len(words) // 2 + 2))]
            texts.append(" ".join(rng.choice([words + more, words, words[: len(words) * 9 // 10 + 1]])))
    rows = [*enumerate(texts), (len(texts), None), (len(texts) + 1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(frame).collect()}
    expected = brute.jaccard_components(rows)
    assert found == expected and sum(k != v[1] for k, v in found.items()) > 20


def test_runs_of_like_sizes_with_one_label_are_dropped(spark):
    rows = [(1, 10, 100, 1), (1, 11, 90, 1), (1, 12, 40, 2), (2, 10, 100, 1), (2, 11, 90, 2), (2, 13, 72, 2), (2, 14, 50, 3)]
    frame = spark.createDataFrame(rows, "token long, c long, n int, label long").repartition(3)
    kept = sorted(tuple(r) for r in jaccard._not_connected(frame, Rule()).collect())
    assert kept == [(2, 10, 100, 1), (2, 11, 90, 2), (2, 13, 72, 2)]


def test_tokens_of_the_very_same_sets_become_one(spark):
    rows = [(t, c, 100) for t in range(30) for c in (10, 11, 12)]  # a passage that three sets share
    rows += [(t, c, 100) for t in range(30, 36) for c in (10, 11)] + [(90, 12, 100)]
    rows += [(t, c, 100) for t in range(40, 43) for c in (20, 21)]  # too few tokens for a link
    frame = spark.createDataFrame(rows, "token long, c long, n int").repartition(5)
    found = sorted((r.token, r.c, r.n, r.weight) for r in jaccard._with_partners(frame, Rule()).collect())
    assert found == [(0, 10, 100, 30), (0, 11, 100, 30), (0, 12, 100, 30), (30, 10, 100, 6), (30, 11, 100, 6)]
