"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    alignment,
    fingerprints,
    language_id,
    license_scan,
    lm_scoring,
    merkle,
    mixing,
    near_dedup,
    packing,
    quality_rules,
    rule_classifier,
    top_k,
    warc,
)
from tillroll.llm.frames import read_table
from tillroll.session import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's trigram score under the counts of all documents."""
    scored = lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))
    orders = ("n_unigram", "n_bigram", "n_trigram")
    return scored.select(
        "doc_id",
        "n_words",
        *[F.col("n_by_order")[i].alias(name) for i, name in enumerate(orders)],
        (F.round("log_score", 5) + F.lit(0.0)).alias("log_score"),
        F.round("mean_log_score", 5).alias("mean_log_score"),
    )


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language; texts are modelled on all documents."""
    pages, docs = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents")
    return language_id.identify(pages, docs)


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in every document."""
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


@query
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, as the archives read back."""
    path = new_path(spark, "archives")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and how far it moves when a third of the text changes."""
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return rule_classifier.classify(docs, labels)[0]


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document; trusted is what is labelled good."""
    docs = read_table(spark, sf_dir, "documents")
    trusted = quality_rules.trusted_of(read_table(spark, sf_dir, "labels"))
    scored = quality_rules.with_quality(docs, quality_rules.log_ratios(docs, trusted))
    return scored.select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "log_ratio", "kept"),
    )


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path())


@query
def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, repeated so that a source's share is that of the root of its size."""
    docs = read_table(spark, sf_dir, "documents")
    return mixing.replicate(docs, mixing.power_weights(docs))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest, and whether it holds after a third were changed."""
    return merkle.verified_rows(read_table(spark, sf_dir, "documents"))


@query
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, aligned, and how common its links are. The ranks
    are those of byte_bpe_50k.json."""
    docs = read_table(spark, sf_dir, "documents")
    return alignment.aligned_documents(
        docs, tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_path("piece_bpe_32k.model")
    )


@query
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best others for every hundredth vector."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k.search(vectors, F.col("vec_id") % 100 == 0)
