"""Passages of fifty words that two documents share, against the plain windows of words."""

from __future__ import annotations

import random
import re

from cashwatch.llm import chunks
from cashwatch.llm.chunks import anchored_chunks, repeated_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows(text, k):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def holders(texts, k):
    """The texts that share `k` words in a row with another one."""
    own = [windows(t, k) for t in texts]
    return [any(s & t for j, t in enumerate(own) if j != i) for i, s in enumerate(own)]


def made_up():
    rng = random.Random(5)

    def prose(n):
        return " ".join(rng.choice(["the", "of", "and", "ü", "a"]) + str(rng.randrange(400)) for _ in range(n))

    texts = [prose(rng.randrange(400)) for _ in range(20)]
    for size in [*range(36, 62)] * 3:
        passage = prose(size)
        for _ in range(2):
            texts.append(f"{prose(rng.randrange(90))} {passage} {prose(rng.randrange(90))}")
    spaced = prose(50)
    texts += [spaced, prose(30) + "\n" + spaced.replace(" ", " \t\n") + "\r\n" + prose(30)]
    texts += ["Retionly " * 70 + prose(40), prose(60) + " Retionly" * 55]  # one word, out of step
    texts += ["a b " * 40, "x a b" + " a b" * 30, prose(70)]
    own = prose(80)
    return [*texts, f"{own} and {own}", None, "", "few words"]


def test_every_shared_passage_of_fifty_words_is_found(spark):
    texts = made_up()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in repeated_substrings(rows).collect()}
    assert len(found) == len(texts)
    long, short = holders(texts, chunks.FOUND_WORDS), holders(texts, chunks.PASSAGE_WORDS)
    assert chunks.FOUND_WORDS == 50 and sum(long) > 60 and sum(not s for s in short) > 20
    missed_by_runs = 0
    for i, text in enumerate(texts):
        flagged = found[i].n_passages > 0
        assert flagged >= long[i] and flagged <= short[i], (i, text)
        assert found[i].n_passages == len(found[i].passages)
        assert found[i].passage_chars == sum(p.end - p.start for p in found[i].passages)
        others = set().union(*(windows(t, chunks.PASSAGE_WORDS) for j, t in enumerate(texts) if j != i))
        for p in found[i].passages:
            inside = WORD.findall(text[p.start : p.end])
            assert tuple(inside[: chunks.PASSAGE_WORDS]) in others
            assert tuple(inside[-chunks.PASSAGE_WORDS :]) in others
        missed_by_runs += long[i] and found[i].n_repeated == 0
    assert missed_by_runs > 5  # what the runs of gear chunks alone leave out


def test_one_repeated_word_is_few_chunks():
    assert len(list(anchored_chunks("Retionly " * 5000))) == 1
    assert list(anchored_chunks(" ".join(map(str, range(49))))) == []
    assert len(list(anchored_chunks(" ".join(map(str, range(50)))))) == 1
