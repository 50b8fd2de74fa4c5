"""A corpus from documents: rules, toxicity, near-duplicates, mix, piece ids.

Each stage works on all documents that the one before kept, and all but the last
return documents with their columns. Results are written and read between stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caseweave.llm.common import materialise, table
from caseweave.llm.mixing import mixed_documents
from caseweave.llm.near_dedup import deduplicated
from caseweave.llm.piece_codec import encode_decode
from caseweave.llm.quality_rules import kept_documents
from caseweave.llm.toxicity import clean_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_dedup_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

# SQL has no expression for the stages that learn and encode. Tests compare near-duplicates,
# mix and pieces with brute force, and run() with the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
