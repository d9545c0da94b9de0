"""The corpus pipeline over ``documents``: five stages, each one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexikin.llm.common import written
from lexikin.llm.exact_dedup import deduplicated
from lexikin.llm.mixing import mixed_rows
from lexikin.llm.near_dedup import without_near_copies
from lexikin.llm.pieces import encoded
from lexikin.llm.toxicity import train_toxicity, with_toxicity

REJECTED_FROM = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = with_toxicity(docs.select(F.struct("*").alias("doc"), "text"), train_toxicity(docs, labels))
    return scored.where(F.col("score") < REJECTED_FROM).select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    return deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles one stays."""
    return without_near_copies(docs, size=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by flattened weights: every document at least once, none over twice, in the
    order of the mixture: pass by pass, and in each the blocks as permuted."""
    mixed = mixed_rows(docs, repeats=2.0)
    ordered = mixed.orderBy("mix_epoch", "mix_block_order", "mix_block", "mix_row_order")
    return ordered.select(*(F.col(f"`{c}`") for c in docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids and ids of each text of the mixture."""
    ids = encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]
#: No stage but the second can be put as SQL: scores, sketches and seeded hashes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
