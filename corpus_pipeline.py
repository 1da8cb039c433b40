"""A training corpus from raw documents: five stages, each a job over what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, cleaning, decontaminate, neardup, toxicity
from tidemark.llm.frames import kept, table
from tidemark.llm.queries import VOCABULARY


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, trained on the labelled ones among them, does not score as toxic."""
    return toxicity.accepted(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def _quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lose no more than half to the line rules; texts as they were."""
    return cleaning.cleaned(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return neardup.deduplicated(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def _encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian), their count, and hashes of ids and of the bytes they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", _toxicity),
    ("quality_rules", _quality_rules),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("byte_bpe", _encoding),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
