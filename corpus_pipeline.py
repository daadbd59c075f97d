"""A training corpus from ``documents``: five corpus operators in a row.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over everything its
predecessor kept; :func:`run` writes each stage's result to the shared
checkpoint folder as Parquet and reads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastebud.llm import mixing, piece_viterbi, quality_rules, simhash, weak_quality
from tastebud.llm.common import prepare, staged


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    prepare(spark)
    return weak_quality.quality_scores(docs, weak_quality.fit_quality(docs), carry=True).where("kept").select("row.*")


def host_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and whose host is not rejected."""
    prepare(spark)
    return quality_rules.host_quality_rules(docs, carry=True).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    prepare(spark)
    return simhash.near_duplicates(docs, carry=True).where("keeper").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their targets; a document taken twice is two rows."""
    prepare(spark)
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix: ``doc_id, n_tokens, ids``."""
    prepare(spark)
    return piece_viterbi.encode_documents(docs, piece_viterbi.load_pieces())


STAGES = [("quality_classifier", classify), ("quality_rules", host_rules), ("simhash_near_dedup", near_dedup),
          ("mixing", mix), ("sentencepiece", encode)]

#: SimHash near-duplicates (a transitive closure over 64-bit XXH64 sums) have no plain SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
