"""From raw documents to a tokenized training mix, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashwatch.llm.bpe import with_tokens
from cashwatch.llm.common import staged
from cashwatch.llm.jaccard import first_of_each_group
from cashwatch.llm.language import document_evidence, fit, identify
from cashwatch.llm.mixing import mixed_documents
from cashwatch.llm.pii import redacted
from cashwatch.llm.queries import vocabulary_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined, with that language as `lang`."""
    columns = docs.columns
    found = identify(document_evidence(docs), fit(docs.select("text", "lang"))).filter("accepted")
    own = {"lang": found["language"], "text": found["text"]}
    return found.select(*[own.get(c, found["row"][c]).alias(c) for c in columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return first_of_each_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by tags."""
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document comes once for each epoch that takes it."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, lang, source, n_tokens, token_ids` of every row of the mix."""
    tokens = with_tokens(docs, vocabulary_path())
    return tokens.select("doc_id", "lang", "source", "n_tokens", "token_ids")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("pii", pii),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: SQL can't express the near copies, the text models or the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
