"""One query per operator over its whole table, and a DuckDB statement where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, factorisation, host_rules, oracles, periodic_runs, secrets, segmentation, sharding, simhash,
               suffix_dedup, templates, url_rules, weak_labels, winnowing)
from .common import table


def op1_gumbel_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.encode_samples(table(spark, sf_dir, "documents"), with_text=True).select(
        "doc_id", "rank", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
        F.crc32("decoded").alias("decoded_crc32"), "log_prob", "perturbed", "log_inclusion")


def op2_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(table(spark, sf_dir, "pages"))


def op3_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents")).drop("row")
    return judged.withColumn("host_rate", F.round("host_rate", 9))


def op8_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents")).drop("row", "root")


def op9_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kind(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", kind(0).alias("n_assign"), kind(1).alias("n_access"), kind(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_rules.RULES), "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), text=True)
    found = found.withColumn("groups_sha256", F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256))).drop("groups")
    return alignment.scored(found).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def line(run: Column) -> Column:
        return F.concat_ws("", F.concat_ws(",", *[run[name].cast("string") for name in ("start", "length", "period")]), F.lit("\n"))

    found = periodic_runs.periodic_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents")))
    return found.withColumn("best", periodic_runs.strongest("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_gumbel_segmentation, op2_template_extraction, op3_winnowing_decontamination, op4_factorisation_quality,
        op5_lpf_dedup, op6_feistel_sharding, op7_host_rules, op8_gray_simhash, op9_weak_toxicity,
        op10_randomness_secrets, op11_url_rules, op12_diagonal_alignment, op13_periodic_runs)
}

ORACLES: dict[str, str] = dict(oracles.ORACLES)
