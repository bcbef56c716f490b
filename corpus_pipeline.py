"""The corpus pipeline: its stages in order, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystone.llm import exact_dedup, mixing, near_dedup, segmentation, toxicity
from tallystone.session import materialize


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are predicted toxic. Learns from the labelled rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.learn_toxicity(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.drop_duplicates_of_text(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document of the mix, with its source: doc_id, source, sample, ids and their scores, and whether
    the ids decode to its text."""
    return segmentation.sample_segmentations(docs, carry={"source": docs["source"]}, checked=True)


STAGES = [
    ("toxicity", keep_clean), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix),
    ("segmentation", encode),
]

#: SQL expresses neither the scores of toxicity nor sampled segmentations; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
