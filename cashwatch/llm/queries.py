"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cashwatch.llm.bpe import with_tokens
from cashwatch.llm.chunks import repeated_substrings
from cashwatch.llm.common import span_text
from cashwatch.llm.jaccard import jaccard_join
from cashwatch.llm.language import RESULTS, document_evidence, fit, identify, page_evidence
from cashwatch.llm.mixing import mix_sources
from cashwatch.llm.multiindex import near_duplicates
from cashwatch.llm.nearest import nearest_neighbours
from cashwatch.llm.packing import packed
from cashwatch.llm.pii import BASE, find_pii
from cashwatch.llm.ranked import ranked_search
from cashwatch.llm.secrets import STRONG, find_secrets
from cashwatch.llm.sharding import balanced_shards
from cashwatch.llm.sql import ORACLE_SQL  # noqa: F401
from cashwatch.llm.trie import conversation_trie

VOCABULARY = "word_bpe_49k.json"
SHARDS = 24


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _counts(spans: Column, kinds: list[str]) -> list[Column]:
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [count(kind) for kind in kinds]


def op1_nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    return nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op2_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Languages of all pages and of all documents; of the latter the source is the host."""
    docs = _documents(spark, d)
    model = fit(docs.select("text", "lang"))
    pages = identify(page_evidence(spark.read.parquet(f"{d}/pages.parquet")), model, keep_text=False)
    found = identify(document_evidence(docs.select("doc_id", "text", "source", "lang")), model, keep_text=False)
    return pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", *RESULTS).unionByName(
        found.select("row.doc_id", F.lit(None).cast("long").alias("page_id"), *RESULTS)
    )


def op3_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join(_documents(spark, d)).select("doc_id", "n_shingles", "component_id")


def op4_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    def joined(spans: str) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",").alias(spans)

    return repeated_substrings(_documents(spark, d)).select(
        "doc_id",
        "n_chunks",
        "n_repeated",
        "repeated_chars",
        "removable_chars",
        joined("spans"),
        "n_passages",
        "passage_chars",
        joined("passages"),
    )


def op5_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    strong = F.col("strong")
    return find_secrets(_documents(spark, d)).select(
        "doc_id",
        *_counts(strong, list(STRONG)),
        _digest(span_text(strong)).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op6_bpe(spark: SparkSession, d: str) -> DataFrame:
    tokens = with_tokens(_documents(spark, d).select("doc_id", "text"), vocabulary_path())
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        _digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op7_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{d}/embeddings.parquet"), threshold=0.95)


def op8_sharding(spark: SparkSession, d: str) -> DataFrame:
    return balanced_shards(_documents(spark, d), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(_documents(spark, d)).select("doc_id", "size", "source_size", "target", "taken")


def op10_pii(spark: SparkSession, d: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(BASE))
    return find_pii(_documents(spark, d)).select(
        "doc_id",
        *_counts(spans, BASE),
        _digest(span_text(base)).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    return packed(_documents(spark, d), vocabulary_path()).select(
        "doc_id",
        "start",
        "length",
        F.crc32("token_ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op12_conversation_trie(spark: SparkSession, d: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{d}/conversations.parquet"))


def op13_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_language_id,
        op3_ngram_jaccard,
        op4_substring_dedup,
        op5_secret_scan,
        op6_bpe,
        op7_embedding_near_dedup,
        op8_sharding,
        op9_mixing,
        op10_pii,
        op11_packing,
        op12_conversation_trie,
        op13_ranked_search,
    )
}
