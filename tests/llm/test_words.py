"""Words of pieces and the ids that a packing task remembers."""

from __future__ import annotations

import random

import pytest

from cashwatch.llm import packing
from cashwatch.llm.bpe import _WORD, Encoder, Vocabulary
from cashwatch.llm.packing import Tokens
from cashwatch.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("public_tokenizers")
    return Vocabulary.load(vocabulary_path())


def test_plain_words_are_cut_without_a_search(monkeypatch):
    rng = random.Random(3)
    signs = "abzé'ßüöñªº²½·.,!-_\"­ɏɐ́я7٣\x1c"
    pieces = ["", "a", "a.", "é,", "it's", "s'", "'s", ".", "ab..", "x7", "ab²", "aª", "ab­"]
    pieces += ["".join(rng.choices(signs, k=rng.randrange(1, 6))) for _ in range(5000)]
    assert [Tokens._words(p) for p in pieces] == [_WORD.findall(p) for p in pieces]

    monkeypatch.setattr(packing, "_WORD", None)
    assert [Tokens._words(p) for p in ("plain", "word,", "größe", "año.")] == [["plain"], ["word", ","], ["größe"], ["año", "."]]


def test_forgetting_words_changes_no_ids(monkeypatch, vocabulary):
    rng = random.Random(4)
    letters = ["th", "er", "ab", "aaaa", "ß", ".", ",", "'s", "7", "x" * 210, "<|endoftext|>"]
    texts = ["".join(rng.choice([*letters, " ", " "]) for _ in range(300)) for _ in range(30)] + [None, ""]
    end = (1).to_bytes(4, "little")
    expected = [x + end for x in Encoder(vocabulary).encode(texts)]
    monkeypatch.setattr(packing, "MEMORY", 40)
    tokens = Tokens(vocabulary)
    most = 0
    for at in range(0, len(texts), 4):
        ids, ends = tokens.of(texts[at : at + 4], 1)
        assert [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends)] == expected[at : at + 4]
        assert all(len(w) <= packing.LONGEST_KEPT for w in tokens.known)
        most = max(most, len(tokens.known))
    assert most < 2000
