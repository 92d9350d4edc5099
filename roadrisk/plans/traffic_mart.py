"""City congestion mart (C11, C24, E1, D2, G1) and segment speeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import indicator
from ..functions.traffic import against_city, congestion_score

MART_ORDER = ("congestion_score", "city", "road_name")


def scored_flow(staged: DataFrame) -> DataFrame:
    return staged.withColumn("congestion_score", congestion_score(F.col("speed_reduction_pct")))


def city_summary(scored: DataFrame) -> DataFrame:
    """One row per city and state; the partial aggregation keeps a hot city cheap."""
    return scored.groupBy("city", "state").agg(
        F.count(F.lit(1)).alias("total_segments"),
        F.avg("current_speed_mph").alias("avg_current_speed"),
        F.avg("free_flow_speed_mph").alias("avg_free_flow_speed"),
        F.avg("speed_reduction_pct").alias("avg_speed_reduction_pct"),
        F.avg("congestion_score").alias("avg_congestion_score"),
        F.avg("delay_sec").alias("avg_delay_seconds"),
        F.sum(indicator(F.col("road_closure"))).alias("closed_roads_count"),
        F.max("timestamp").alias("last_updated"),
    )


def traffic_mart(staged: DataFrame) -> DataFrame:
    """Every reading with its city's congestion; a NULL state has no city row.

    Unordered: ``ordered_mart`` gives the report order where it is read.
    """
    scored = scored_flow(staged)
    context = city_summary(scored).select(
        "city", "state", F.col("avg_congestion_score").alias("city_avg_congestion"),
        F.col("total_segments").alias("city_total_segments"),
        F.col("closed_roads_count").alias("city_closed_roads"))
    # The summary has one row per city: Spark sees its size before the join runs.
    joined = scored.join(context, ["city", "state"], "left")
    score, average = F.col("congestion_score"), F.col("city_avg_congestion")
    return joined.select(
        "flow_id", "city", "state", "road_name", "timestamp", "latitude", "longitude",
        "current_speed_mph", "free_flow_speed_mph", "speed_reduction_pct", "congestion_score", "congestion_level",
        "delay_sec", "confidence_level", "road_closure",
        "city_avg_congestion", "city_total_segments", "city_closed_roads",
        (score - average).alias("congestion_vs_city_avg"),
        against_city(score, average).alias("relative_congestion_level"),
    )


def ordered_mart(mart: DataFrame) -> DataFrame:
    score, *rest = MART_ORDER
    return mart.orderBy(F.col(score).desc_nulls_first(), *[F.col(name).asc_nulls_last() for name in rest], "flow_id")


def segment_speed(staged: DataFrame) -> DataFrame:
    """Average speed per road segment."""
    return staged.groupBy("city", "road_name").agg(
        F.count(F.lit(1)).alias("readings"), F.avg("current_speed_mph").alias("avg_speed_mph"))
