"""Current-weather fact: classes, regional and state-wide comparison, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.bands import any_of, below
from ..functions.times import Moment, clock, day_period
from ..functions.weather import comfort_fact, compass_fact
from ..operators.ranking import Ranking, row_numbers
from ..operators.shared import written

RANKED = {"temp": "temperature_f", "humidity": "humidity_pct", "wind": "wind_speed_mph"}
RANKINGS = (
    [Ranking(f"region_{short}_rank", column, within="region") for short, column in RANKED.items()]
    + [Ranking(f"state_{short}_rank", column) for short, column in RANKED.items()]
)
ROW_KEY = "_row_key"
NO_REGION = "\x00"


def weather_metrics(staged: DataFrame) -> DataFrame:
    temperature, humidity = F.col("temperature_f"), F.col("humidity_pct")
    wind, rain = F.col("wind_speed_mph"), F.col("precipitation_in")
    return staged.select(
        "record_id", "city", "state", "region", "county", "latitude", "longitude",
        F.col("timestamp_utc").alias("weather_timestamp"), F.col("date").alias("weather_date"), "hour",
        day_period(F.col("hour")).alias("time_of_day"),
        "temperature_f", "feels_like_f", "temp_min_f", "temp_max_f",
        F.round(F.col("feels_like_f") - temperature, 1).alias("heat_index_difference"),
        "temperature_category", below(temperature, fixed.TEMPERATURE_DETAILED).alias("temperature_category_detailed"),
        "pressure_msl_hpa", "surface_pressure_hpa", "humidity_pct", "cloud_cover_pct",
        below(humidity, fixed.HUMIDITY).alias("humidity_category"),
        "wind_speed_mph", "wind_direction_deg", "wind_gusts_mph", "wind_category",
        compass_fact(F.col("wind_direction_deg")).alias("wind_direction_cardinal"),
        "precipitation_in", "rain_in", "snowfall_in", "precipitation_category",
        any_of(F.col(name) > 0 for name in ("precipitation_in", "rain_in", "snowfall_in")).alias("has_precipitation"),
        "weather_code", "weather_main", "weather_description", "weather_icon",
        "is_freezing", "is_high_wind", "is_heavy_rain", "has_snow",
        comfort_fact(temperature, humidity, wind, rain).alias("comfort_index"),
        "data_source", "load_timestamp",
    )


def region_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("region").agg(
        F.avg("temperature_f").alias("region_avg_temp"), F.max("temperature_f").alias("region_max_temp"),
        F.min("temperature_f").alias("region_min_temp"),
        F.avg("humidity_pct").alias("region_avg_humidity"), F.max("humidity_pct").alias("region_max_humidity"),
        F.min("humidity_pct").alias("region_min_humidity"),
        F.avg("wind_speed_mph").alias("region_avg_wind_speed"), F.max("wind_speed_mph").alias("region_max_wind_speed"),
    )


def weather_fact(staged: DataFrame, as_of: Moment = None, partitions: int | None = None) -> DataFrame:
    """One row per reading.  Whole-partition windows are aggregates joined back; ranks come from sorted ranges.

    The readings get a row key and are written once, since the summaries, the
    six rankings and the detail all read them.
    """
    rows = written(weather_metrics(staged).withColumn(ROW_KEY, F.monotonically_increasing_id()), "weather-readings")
    # NULL regions form one group, as in a window; the join needs a key for them.
    keyed = rows.withColumn("_region", F.coalesce("region", F.lit(NO_REGION)))
    regions = region_summary(rows).withColumn("_region", F.coalesce("region", F.lit(NO_REGION))).drop("region")
    compared = keyed.join(regions, "_region", "left").drop("_region")

    state = rows.agg(F.struct(
        F.avg("temperature_f").alias("avg_temp"), F.max("temperature_f").alias("max_temp"),
        F.min("temperature_f").alias("min_temp"), F.avg("humidity_pct").alias("avg_humidity")).alias("state")).scalar()
    compared = compared.withColumn("_state", state).withColumns({
        f"state_{name}": F.col(f"_state.{name}") for name in ("avg_temp", "max_temp", "min_temp", "avg_humidity")})

    ranks = row_numbers(rows, RANKINGS, ["record_id", ROW_KEY], partitions)
    return compared.drop("_state").join(ranks, ROW_KEY).drop(ROW_KEY).withColumns({
        "temp_diff_from_region_avg": F.round(F.col("temperature_f") - F.col("region_avg_temp"), 1),
        "temp_diff_from_state_avg": F.round(F.col("temperature_f") - F.col("state_avg_temp"), 1),
        "humidity_diff_from_region_avg": F.round(F.col("humidity_pct") - F.col("region_avg_humidity"), 1),
        "wind_diff_from_region_avg": F.round(F.col("wind_speed_mph") - F.col("region_avg_wind_speed"), 1),
        "mart_created_at": clock(as_of),
    })
