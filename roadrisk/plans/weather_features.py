"""Cleaned weather tables with derived columns (C27, C28), all as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, times, weather
from ..operators.fill import nan_as_null


def _calendar(rows: DataFrame) -> DataFrame:
    moment = F.col("timestamp_utc")
    return rows.withColumns({
        "date": F.to_date(moment), "hour": F.hour(moment), "day_of_week": times.monday0(moment),
        "day_name": F.date_format(moment, "EEEE"), "month": F.month(moment), "year": F.year(moment),
    })


def history_features(hourly: DataFrame) -> DataFrame:
    """Hourly weather with Celsius, condition, heat index and extreme flags; missing numbers become 0 last."""
    rows = _calendar(nan_as_null(hourly))
    temperature, humidity = F.col("temperature_f"), F.col("relative_humidity_pct")
    derived = rows.withColumns({
        "temperature_c": weather.celsius(temperature),
        "weather_condition": weather.condition(F.col("weather_code")),
        "heat_index_f": weather.heat_index(temperature, humidity),
        **weather.extreme_flags(temperature, F.col("wind_speed_mph"), F.col("precipitation_mm")),
    })
    return derived.na.fill(0)


def current_features(current: DataFrame) -> DataFrame:
    """Current weather with thirty derived columns; labels come before the fill of missing values."""
    timed = nan_as_null(current).withColumn("timestamp_utc", F.col("timestamp_str").try_cast("timestamp_ntz"))
    rows = _calendar(timed.drop("timestamp_str"))
    moment, temperature, feels = F.col("timestamp_utc"), F.col("temperature_f"), F.col("feels_like_f")
    humidity, wind = F.col("humidity_pct"), F.col("wind_speed_mph")
    derived = rows.withColumns({
        "month_name": F.date_format(moment, "MMMM"),
        "is_weekend": F.col("day_of_week").isin(5, 6),
        "time_of_day": times.day_period(F.col("hour")),
        "temperature_c": weather.celsius(temperature),
        "feels_like_c": weather.celsius(feels),
        "temp_feels_diff": temperature - feels,
        "heat_index_f": weather.heat_index(temperature, humidity),
        "wind_chill_f": weather.wind_chill(temperature, wind),
        "precipitation_mm": F.col("precipitation_in") * fixed.IN_TO_MM,
        "rain_mm": F.col("rain_in") * fixed.IN_TO_MM,
        "snowfall_mm": F.col("snowfall_in") * fixed.IN_TO_MM,
        **weather.condition_flags(F.col("weather_main")),
        "comfort_level": weather.comfort_cleaned(temperature, humidity),
        **weather.extreme_flags(temperature, wind, F.col("precipitation_in")),
        "is_high_humidity": F.coalesce(humidity > 80, F.lit(False)),
        "wind_direction_cardinal": weather.compass_cleaned(F.col("wind_direction_deg")),
        "aqi_estimate": weather.air_quality(F.col("pressure_msl_hpa"), humidity),
    })
    return derived.na.fill(0).na.fill("Unknown")
