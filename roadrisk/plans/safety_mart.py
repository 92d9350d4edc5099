"""Safety summaries and the stacked mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.bands import indicator
from ..functions.times import Moment, clock
from ..operators.shared import written

USED = (
    "city", "county", "state", "street", "severity", "severity_label", "accident_date", "accident_hour", "day_name",
    "is_weekend", "sunrise_sunset", "weather_main", "weather_description", "temperature_f", "visibility_mi",
    "wind_speed_mph", "humidity_pct", "risk_score", "risk_category", "has_weather_hazard",
    "has_infrastructure_risk", "has_junction", "has_traffic_signal",
)


def _count() -> Column:
    return F.count(F.lit(1)).alias("accident_count")


def _sum_true(name: str, alias: str) -> Column:
    return F.sum(indicator(F.col(name))).alias(alias)


def city_severity(correlation: DataFrame) -> DataFrame:
    return correlation.groupBy("city", "county", "state", "severity", "severity_label").agg(
        _count(),
        *[F.avg(name).alias(f"avg_{name}") for name in
          ("temperature_f", "visibility_mi", "wind_speed_mph", "humidity_pct")],
        _sum_true("has_weather_hazard", "weather_related_count"),
        _sum_true("has_infrastructure_risk", "infrastructure_related_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.min("accident_date").alias("earliest_accident"), F.max("accident_date").alias("latest_accident"),
    )


def weather_conditions(correlation: DataFrame) -> DataFrame:
    return correlation.groupBy("weather_main", "weather_description").agg(
        _count(), F.avg("severity").alias("avg_severity"), F.avg("risk_score").alias("avg_risk_score"),
        F.sum(indicator(F.col("severity") >= fixed.SERIOUS_FROM)).alias("severe_accident_count"),
    )


def time_patterns(correlation: DataFrame) -> DataFrame:
    return correlation.groupBy("day_name", "accident_hour", "is_weekend", "sunrise_sunset").agg(
        _count(), F.avg("severity").alias("avg_severity"), F.avg("risk_score").alias("avg_risk_score"),
        _sum_true("has_weather_hazard", "weather_related_count"),
    )


def hot_spots(correlation: DataFrame, severity_order: bool = False) -> DataFrame:
    """The hundred streets with the highest mean risk among those with five accidents or more.

    ``max_risk_category`` is the greatest text (Medium > Low > High);
    ``severity_order=True`` ranks the categories by their meaning instead.
    """
    worst = F.max("risk_category")
    if severity_order:
        worst = F.max_by("risk_category", "risk_score")
    streets = correlation.groupBy("city", "county", "state", "street").agg(
        _count(), F.avg("severity").alias("avg_severity"), F.avg("risk_score").alias("avg_risk_score"),
        worst.alias("max_risk_category"),
        _sum_true("has_junction", "junction_accidents"),
        _sum_true("has_traffic_signal", "traffic_signal_accidents"),
        _sum_true("has_weather_hazard", "weather_related_accidents"),
    ).where(F.col("accident_count") >= fixed.HOT_SPOT_MIN_ACCIDENTS)
    return streets.orderBy(F.col("avg_risk_score").desc_nulls_first(), "city", "county", "state", "street").limit(
        fixed.HOT_SPOT_ROWS)


def safety_mart(correlation: DataFrame, as_of: Moment = None, keep: bool = True) -> DataFrame:
    """The four summaries as one long table.

    Four aggregates read the correlation, so its used columns are written once
    (``keep``) instead of joining four times.  The existence guard of the source
    is implied: without rows there are no groups.
    """
    rows = correlation.select(*USED)
    if keep:
        rows = written(rows, "correlation")
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("long")

    def branch(metric: str, source: DataFrame, place: bool, category: Column, weather: Column, road: Column,
               detail: Column) -> DataFrame:
        return source.select(
            F.lit(metric).alias("metric_type"),
            *[(F.col(name) if place else none).alias(name) for name in ("city", "county", "state")],
            category.alias("category"), "accident_count", "avg_risk_score",
            weather.alias("weather_related_count"), road.alias("infrastructure_related_count"),
            detail.alias("detail"))

    hour = F.concat(F.col("day_name"), F.lit(" "), F.lpad(F.col("accident_hour").cast("string"), 2, "0"), F.lit(":00"))
    branches = [
        branch("city_severity", city_severity(rows), True, F.col("severity_label"),
               F.col("weather_related_count"), F.col("infrastructure_related_count"), none),
        branch("weather_condition", weather_conditions(rows), False, F.col("weather_main"),
               F.col("accident_count"), zero, F.col("weather_description")),
        branch("time_pattern", time_patterns(rows), False, hour,
               F.col("weather_related_count"), zero, F.col("sunrise_sunset")),
        branch("high_risk_location", hot_spots(rows), True, F.col("street"),
               F.col("weather_related_accidents"), F.col("junction_accidents") + F.col("traffic_signal_accidents"),
               F.col("max_risk_category")),
    ]
    first, *others = branches
    for other in others:
        first = first.unionByName(other)
    return first.withColumn("dashboard_updated_at", clock(as_of))


def ordered_mart(mart: DataFrame) -> DataFrame:
    return mart.orderBy("metric_type", F.col("avg_risk_score").desc_nulls_first(), "category", "detail",
                        "city", "county", "state")
