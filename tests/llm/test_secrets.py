"""Secret scan of texts with many matches."""

from __future__ import annotations

import time

import pytest

from cashwatch.llm import secrets
from cashwatch.llm.secrets import STRONG, WEAK, find_secrets
from tests.llm import brute


def spans_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in find_secrets(rows).collect()}
    return [[(s.start, s.place, s.kind, s.end) for s in found[i].strong] for i in range(len(texts))]


@pytest.mark.parametrize("portion", [1, 3, 64])
def test_strong_spans_in_any_portions(spark, monkeypatch, portion):
    monkeypatch.setattr(secrets, "PORTION", portion)
    hexes = [f"{i:026x}" for i in range(130)]
    texts = [" é ".join(hexes[:n]) + " password = 'abc12345' token:x AKIA" + "Q7" * 10 for n in (0, 1, 2, 3, 63, 64, 65, 128, 129)]
    texts += [None, "", "secret=short", "ÄÖ" * 50 + "api_key: 0123456789abcdef0123456789"]
    assert spans_of(spark, texts) == [sorted(brute.secret_spans(t)) for t in texts]


def test_many_matches_in_one_text_take_linear_time(spark):
    text = " ".join(f"{i:026x}" for i in range(32_000))
    start = time.monotonic()
    (found,) = spans_of(spark, [text])
    assert len(found) == 32_000 and found == sorted(brute.secret_spans(text))
    assert time.monotonic() - start < 60


def test_every_kind_has_a_pattern():
    assert set(STRONG) | set(WEAK) == set(secrets.KINDS)
