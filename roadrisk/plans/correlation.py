"""Accidents with the weather of their hour, and the risk of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.bands import any_of
from ..functions.risk import accident_category, accident_score
from ..functions.times import Moment, clock
from ..operators.joins import spread_left_join

KEYS = ["city", "date", "hour"]
ACCIDENT_COLUMNS = (
    "accident_id", "severity", "severity_label", "start_time", "end_time", "accident_date", "accident_hour",
    "day_of_week", "day_name", "is_weekend", "city", "county", "state", "accident_lat", "accident_lng", "street",
    "zipcode", "distance_affected_mi", "description", "has_amenity", "has_bump", "has_junction",
    "has_traffic_signal", "has_crossing", "has_stop", "has_roundabout", "has_railway", "has_give_way",
    "has_traffic_calming",
)
LIGHT_COLUMNS = ("sunrise_sunset", "civil_twilight")


def accident_weather(accidents: DataFrame, weather: DataFrame, as_of: Moment = None,
                     run_started_at: str | None = None, salts: int = 1) -> DataFrame:
    """All accidents, matched on city, day and hour; no rows at all while there is no weather.

    A repeated weather key repeats the accident, as in any left join.
    """
    left = (accidents.withColumnsRenamed({"latitude": "accident_lat", "longitude": "accident_lng"})
            .select(*ACCIDENT_COLUMNS, *LIGHT_COLUMNS,
                    F.col("accident_date").alias("date"), F.col("accident_hour").alias("hour")))
    measured = weather.withColumnRenamed("wind_deg", "wind_direction_deg")
    right = measured.select(*KEYS, *[F.col(name).alias(f"w_{name}") for name in fixed.WEATHER_MATCH_DEFAULTS])
    joined = spread_left_join(left, right, KEYS, spread_by="accident_id", salts=salts)

    matched = joined.withColumns({
        name: F.coalesce(F.col(f"w_{name}"), F.lit(default))
        for name, default in fixed.WEATHER_MATCH_DEFAULTS.items()})
    scored = matched.withColumn("risk_score", accident_score(
        F.col("severity"), F.col("sunrise_sunset"), {name: F.col(name) for name in fixed.RISK_WEIGHTS}))
    run = F.lit(run_started_at) if run_started_at else F.date_format(clock(as_of), "yyyy-MM-dd HH:mm:ss")
    rows = scored.select(
        *ACCIDENT_COLUMNS, *fixed.WEATHER_MATCH_DEFAULTS, *LIGHT_COLUMNS, "risk_score",
        accident_category(F.col("risk_score")).alias("risk_category"),
        any_of(F.col(name) for name in fixed.WEATHER_HAZARDS).alias("has_weather_hazard"),
        any_of(F.col(name) for name in fixed.ROAD_RISKS).alias("has_infrastructure_risk"),
        clock(as_of).alias("dbt_updated_at"), run.alias("dbt_run_timestamp"),
    )
    # An uncorrelated EXISTS: Spark asks the weather for one row.
    return rows.where(weather.select(F.lit(1)).exists())
