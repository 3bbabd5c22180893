"""A training corpus from raw documents, in five stages.

Each stage takes the documents that the stage before kept and returns documents with the same columns;
the last returns where their token pieces go. Between stages the rows are written to the shared folder
and read again, so a lost executor costs part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import mixing, near_dedup, packing, quality_rules, rule_classifier, text_statistics
from tillroll.llm.frames import beside, read_table, stored
from tillroll.llm.queries import tokenizer_path


#: Labelled documents that the classifier learns from, at most.
LEARNT_FROM = 200_000


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like those labelled as good."""
    trusted = quality_rules.trusted_of(read_table(spark, sf_dir, "labels"))
    ratios = quality_rules.log_ratios(docs, trusted)
    judged = quality_rules.with_quality(beside(docs, "text"), ratios)
    return judged.filter("kept").select("__row.*")


def reject_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for good. It learns from labelled documents, also from
    those that an earlier stage rejected, since few bad ones are left to learn from: from all, or,
    of more than ``LEARNT_FROM``, from about so many, chosen by a hash of the key."""
    labels = read_table(spark, sf_dir, "labels")
    learnt = rule_classifier.bounded_labels(labels, LEARNT_FROM)
    every = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # At most about LEARNT_FROM keys: the texts stay where they are.
    keys = F.broadcast(learnt.select("doc_id").distinct())
    known = text_statistics.with_statistics(every.join(keys, "doc_id", "left_semi"), keep=["doc_id"])
    model = rule_classifier.learn(stored(known, "statistics"), learnt)
    rows = text_statistics.with_statistics(beside(docs, "text"), keep=["__row"])
    return rows.filter(model.score() >= rule_classifier.THRESHOLD).select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that a source's share is that of the root of its size."""
    mixed = mixing.replicate(beside(docs, "doc_id", "source"), mixing.power_weights(docs))
    return mixed.select("__row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", reject_by_rules),
    ("quality_classifier", reject_by_classifier),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages hash, learn and tokenize, which SQL cannot express; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
