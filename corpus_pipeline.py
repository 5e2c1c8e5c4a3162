"""Training corpus from ``documents``: clean, deduplicated, redacted and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet under the shared checkpoint folder and reads again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import bpe, dedup, jaccard, packing, pii, toxicity
from carelake.llm.common import materialize, table

#: Near duplicates: word shingles of this width, overlap in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents the classifier rejects; it is trained on ``labels``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).filter("predicted = 0").select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the row with the smallest doc_id stays."""
    return dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one with the smallest doc_id stays.

    Rows are numbered first, so that rows that share a doc_id, or have none, are documents of their own;
    null ids count as the largest.
    """
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.jaccard_components(numbered, SHINGLE_WORDS, SIMILARITY, key="_row")
    linked = groups.select("_row", F.col("component_id").alias("_group")).join(numbered.select("_row", "doc_id"), "_row")
    best = linked.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("best"))
    stays = best.select(F.col("best._row").alias("_row"))
    gone = materialize(linked.select("_row").join(stays, "_row", "left_anti"), "near-copies")
    few = gone.count() <= jaccard.BROADCAST_IDS
    return numbered.join(F.broadcast(gone) if few else gone, "_row", "left_anti").select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text is replaced by its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with the sequence of at most 1024 tokens it went to."""
    pieces = bpe.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)
    return packing.pack(pieces.drop("ids"), 1024)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learned scores, tokens and search cannot be expressed in SQL; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
