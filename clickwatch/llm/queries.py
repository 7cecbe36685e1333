"""Registered queries of the operators and their SQL, thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwatch.llm import (
    ann,
    decontaminate,
    filter_audit,
    language_id,
    mixing,
    pii,
    secret_scan,
    simhash,
    suffix_dedup,
    token_align,
    token_store,
    toxicity,
    url_filter,
)
from clickwatch.llm.common import held_out, table

TOXIC_FROM = 0.3
TOKENIZER = "word_bpe_49k.json"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    learnt = docs.filter(~held_out(F.col("doc_id")))
    model = toxicity.fit(learnt, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    scored = toxicity.scored(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data pseudonymised, and what was found."""
    done = pii.pseudonymised(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "text", *[f"n_{kind}" for kind in pii.KINDS])


@query
def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found inside a document."""
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


ORACLE["op4_benchmark_leaks"] = decontaminate.contained_items_sql()


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document in a mix of all sources."""
    report = mixing.mix_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op5_source_mix"] = mixing.mix_sql()


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: contract patterns and structurally confirmed keys."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")


@query
def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~held_out(F.col("doc_id"))))
    named = language_id.identified(F.col("text"), model, docs).alias("named")
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), named).select("doc_id", "held_out", "named.*")


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded into keyed token files, and read back from them by key."""
    layout = token_store.Layout(public_tokenizers.path(TOKENIZER))
    return token_store.encoded_documents(table(spark, sf_dir, "documents"), layout)


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), every=20)


@query
def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules, else by the weighted vocabulary."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op10_url_verdicts"] = url_filter.judge_sql()


@query
def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps once all strings of 100 bytes that start earlier are removed."""
    kept = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effect of five filters at every step of all 120 orders, per language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = filter_audit.audit_sql()


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other in every document."""
    tokenizers = token_align.Tokenizers(public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    return token_align.aligned(table(spark, sf_dir, "documents"), tokenizers)
