"""The corpus pipeline: language, copies, benchmark leaks, source mix, token files.

Every stage is a function of (spark, docs, sf_dir) and calls one operator on all rows
its predecessor kept. The first four return the columns they are given; a
document is dropped by the language stage (rejected), the copies stage (not the one that
stays), the leaks stage (holds a test item) or the mix (not taken), and the
mix returns it as often as it is taken. The last returns what reading the
token files back gives. Null ids and texts, empty texts, repeated rows, empty tables and
further columns are treated as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwatch.llm import decontaminate, language_id, mixing, near_copies, token_store
from clickwatch.llm.common import free_name, held_out, table
from clickwatch.session import stage as written

TOKENIZER = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the model learns from the labelled corpus."""
    corpus = table(spark, sf_dir, "documents")
    model = language_id.fit(corpus.filter(~held_out(F.col("doc_id"))))
    named = free_name(docs, "named")
    marked = docs.withColumn(named, language_id.identified(F.col("text"), model, docs))
    return marked.filter(~F.col(named)["rejected"]).drop(named)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five-word Jaccard similarity of 0.8 or more."""
    return near_copies.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, documents as often as they are taken."""
    return mixing.mix_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back."""
    return token_store.encoded_documents(docs, token_store.Layout(public_tokenizers.path(TOKENIZER)))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark leaks", drop_benchmark_leaks),
    ("source mix", mix_sources),
    ("token files", write_token_files),
]
#: MinHash, a trained model and a tokenizer have no SQL; the stages are tested against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = written(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
