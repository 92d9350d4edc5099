"""A corpus from raw documents to sampled tokens, one written table after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadrisk.llm import host_rules, secrets, segmentation, simhash, winnowing
from roadrisk.llm.common import small_batches, table
from roadrisk.operators.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose host is refused, go."""
    small_batches(spark)
    return host_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    small_batches(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    return winnowing.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are masked; every document stays."""
    return secrets.redact(docs)


def sampled_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct segmentations of each text with their inclusion scores."""
    small_batches(spark)
    return segmentation.encode_samples(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("sampled pieces", sampled_pieces),
]

# The segmentation has no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents.  Each is written to the shared folder and read again, so none is done twice."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
