"""A cleaning pipeline over documents: each stage reads what its predecessor wrote.

Rows without a doc_id or text pass through the filters like empty documents; without labels nothing is toxic,
without benchmark items nothing is contaminated.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.llm import decontaminate, neardup, packing, pii, toxicity
from careledger.llm.common import staged, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the graded model doesn't find toxic."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.one_of_each(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars brought up to date."""
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in the training sequences."""
    return packing.pack(staged(packing.pieces(docs, TOKENIZER), "pieces"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", reject_contaminated),
    ("pii", redact_pii),
    ("packing", pack),
]

# The stages rest on trained models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
