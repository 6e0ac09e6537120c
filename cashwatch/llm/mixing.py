"""Mixing sources to target weights: random keys, prefix sums by range, exact cuts.

A document's key is a hash of its id and text, so its place within its source is random
but the same in every run. Token counts are summed by source and key range, the ranges are
summed up within a source, and only the one range in which a source's budget ends is sorted.
The cut is then a key per source: every document compares its own key with it, so documents
are never sorted or moved as a whole.

Defined cases: a null text has size 0 and takes nothing; the null source is a source, last
in order; an empty table gives an empty result; rows that repeat an id and text share one key
and, at the cut, divide the words left evenly among them (the remainder is lost); other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cashwatch.llm.common import WORD, key_range, staged


@dataclass(frozen=True)
class Mix:
    """`weights` repeat over the sources in order; `share` is the total as a multiple of all
    sizes; `most` bounds a source's target as a multiple of its size."""

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    seed: int = 17


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL. Words are counted without being kept."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "\x01")
    return F.length(F.regexp_replace(gaps, r"[\x20\x09-\x0D]+", "")).cast("long")


def random_key(mix: Mix, doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(mix.seed), doc_id, text)


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """`source, source_size` to `source, source_size, target`; one row per source.

    A source is capped when its cap per weight lies below the level that the rest would get.
    Sources in the order of cap per weight are capped up to some point and not beyond it, so
    one running sum finds the level. The windows hold one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    rows = (
        sizes.withColumn("_weight", F.element_at(weights, (F.pmod(place, F.lit(len(mix.weights))) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(mix.most))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(mix.share))
    )
    by_level = everything.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_level.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(from_here)
    rows = rows.withColumn("_level", level).withColumn("_capped", F.col("_cap") <= F.col("_level") * F.col("_weight"))
    free = ~F.col("_capped")
    spent = F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0.0))
    common = (F.col("_total") - spent) / F.sum(F.when(free, F.col("_weight"))).over(everything)
    return rows.withColumn("_common", common).select(
        "source",
        "source_size",
        F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_common") * F.col("_weight")).alias("target"),
    )


def cuts(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: whole epochs, the key of the cut and what is taken at that key.

    `sized` has `source, size, key`.
    """
    ranged = sized.withColumn("_range", key_range(F.col("key")))
    words = ranged.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    budget = F.round("target").cast("long")
    plan = (
        targets(words.groupBy("source").agg(F.sum("_words").alias("source_size")), mix)
        .withColumn("_budget", budget)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0)))
        .withColumn("_rest", F.col("_budget") - F.col("epochs") * F.col("source_size"))
    )

    upto = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    summed = words.withColumn("_end", F.sum("_words").over(upto))
    rest = plan.select(F.col("source").alias("_of"), "_rest")
    left = F.col("_rest") - F.col("_end") + F.col("_words")
    end_range = (
        summed.join(rest, F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("_left", left)
        .filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_words")))
        .select("_of", F.col("_range").alias("_at"), "_left")
    )
    in_range = ranged.join(
        end_range, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at"))
    ).select("source", "key", "size", "_left")
    keys = in_range.groupBy("source", "key", "_left").agg(
        F.sum("size").alias("_at_key"), F.count("*").alias("_rows")
    )
    upto = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    end_key = keys.withColumn("_left", F.col("_left") - F.sum("_at_key").over(upto) + F.col("_at_key")).filter(
        (F.col("_left") > 0) & (F.col("_left") <= F.col("_at_key"))
    )
    whole = F.col("_left") == F.col("_at_key")
    end_key = end_key.select(
        F.col("source").alias("_source"),
        F.col("key").alias("cut_key"),
        F.when(~whole, F.expr("_left div _rows")).alias("cut_words"),
    )
    return plan.join(end_key, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        F.col("source").alias("cut_source"), "source_size", "target", "epochs", "cut_key", "cut_words"
    )


def with_taken(sized: DataFrame, cut: DataFrame) -> DataFrame:
    """Add the source's columns of `cuts` and `taken`, a document's words in the mix."""
    last = (
        F.when(F.col("cut_key").isNull() | (F.col("key") > F.col("cut_key")), F.lit(0))
        .when(F.col("key") < F.col("cut_key"), F.col("size"))
        .otherwise(F.least(F.col("size"), F.coalesce("cut_words", "size")))
    )
    joined = sized.join(cut, F.col("source").eqNullSafe(F.col("cut_source")))
    return joined.withColumn("last_words", last).withColumn(
        "taken", F.col("epochs") * F.col("size") + F.col("last_words")
    )


def sized_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    text = F.col("text")
    return docs.select(
        "doc_id", "source", word_count(text).alias("size"), random_key(mix, F.col("doc_id"), text).alias("key")
    )


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """`doc_id, source, size, source_size, target, epochs, taken` of every document of
    `docs` (`doc_id, text, source`). The texts are read once."""
    sized = staged(sized_documents(docs, mix), "mix")
    # Written, so that the join back goes by the size of a row per source and splits no source by key.
    return with_taken(sized, staged(cuts(sized, mix), "cuts")).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "taken"
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: a row of `docs` for each epoch that takes the document.

    The one document of a source in which its budget ends is cut after the words that fit;
    `n_chars` follows the text. Columns are those of `docs`.
    """
    cut = staged(cuts(staged(sized_documents(docs, mix), "mix"), mix), "cuts")
    row = docs.select(F.struct(*docs.columns).alias("_row"), "source", "doc_id", "text").select(
        "_row", "source", word_count(F.col("text")).alias("size"),
        random_key(mix, F.col("doc_id"), F.col("text")).alias("key"),
    )
    taken = with_taken(row, cut).filter("taken > 0")
    whole = F.array_repeat(F.col("size"), F.col("epochs").cast("int"))
    last = F.when(F.col("last_words") > 0, F.array("last_words")).otherwise(F.array().cast("array<bigint>"))
    copies = taken.select("_row", "size", F.explode(F.concat(whole, last)).alias("_words"))
    text = F.col("_row.text")
    cut_text = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("_words").cast("int")), " ")
    text = F.when(F.col("_words") < F.col("size"), cut_text).otherwise(text)
    out = copies.withColumn("_text", text)
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return out.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
