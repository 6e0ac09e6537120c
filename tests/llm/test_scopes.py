"""Intermediate tables: what is left after an operator is what its result reads."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from cashwatch.llm.common import discard, shared_base, staged, work_on
from cashwatch.llm.jaccard import first_of_each_group, jaccard_join
from cashwatch.llm.trie import conversation_trie

SF = "/root/testdata/sf0.001"


def tables(spark, before=frozenset()):
    base = shared_base(spark).removeprefix("file:")
    return {str(p.parent) for p in Path(base).rglob("*.parquet") if "llm-" in str(p)} - before


def test_nothing_is_left_but_what_the_result_reads(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = tables(spark)
    result = jaccard_join(docs)
    assert [Path(t).name.rsplit("-", 1)[0] for t in tables(spark, before)] == ["placed"]
    assert result.count() == docs.count()
    before = tables(spark)
    kept = first_of_each_group(docs)
    assert [Path(t).name.rsplit("-", 1)[0] for t in tables(spark, before)] == ["placed"]
    assert 0 < kept.count() < docs.count()
    before = tables(spark)
    conversation_trie(spark.read.parquet(f"{SF}/conversations.parquet"))
    assert [Path(t).name.rsplit("-", 1)[0] for t in tables(spark, before)] == ["nodes"]


def test_rows_of_any_frame_keep_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = {tuple(r) for r in first_of_each_group(docs).collect()}
    twice = docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    found = [tuple(r) for r in first_of_each_group(twice).collect()]
    assert set(found) >= plain
    words = [r for r in found if r[1] and r[1].split()]
    assert len(words) == len(set(words)) == len([r for r in plain if r[1] and r[1].split()])


def test_scopes_nest(spark):
    before = tables(spark)
    with work_on(spark, "outer") as outer:
        with work_on(spark, "inner") as inner:
            a, b = staged(spark.range(3), "a"), staged(spark.range(4), "b")
            inner.keep(a)
        assert len(tables(spark, before)) == 1 and a.count() == 3
        c = staged(a, "c")
        discard(a)
        outer.keep(c)
    assert len(tables(spark, before)) == 1 and c.count() == 3
    loose = staged(spark.range(2), "loose")
    discard(loose)
    assert loose.count() == 2
