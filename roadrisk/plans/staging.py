"""Cleaning of the raw tables (C1–C10).  Each function is a lazy view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, times
from ..functions.bands import below, flag, lookup, reached
from ..functions.text import is_true_text, text_or
from ..functions.times import Moment, clock
from ..functions.traffic import congestion_level, speed_reduction_pct
from ..functions.weather import (current_flags, history_flags, history_labels, precipitation_current,
                                 precipitation_history)
from ..operators.fill import fill_defaults, nan_as_null


def stage_accidents(raw: DataFrame, as_of: Moment = None) -> DataFrame:
    """Valid accidents of the state, with labels, calendar parts, text defaults and real booleans.

    The filters work on raw columns, before any default is put in.
    """
    low, high = fixed.SEVERITY_RANGE
    kept = raw.where(
        F.col("accident_id").isNotNull()
        & (F.col("state") == fixed.TARGET_STATE)
        & F.col("start_lat").between(*fixed.LATITUDE_RANGE)
        & F.col("start_lng").between(*fixed.LONGITUDE_RANGE)
        & F.col("severity").between(low, high)
    )
    start = F.col("start_time")
    timed = kept.withColumn("start_time", start.try_cast("timestamp_ntz")).where(start.isNotNull())
    text = {name: text_or(F.col(name), default).alias(name) for name, default in fixed.STAGING_TEXT_DEFAULTS.items()}
    flags = [is_true_text(F.col(name)).alias(f"has_{name}") for name in fixed.ROAD_FLAGS]
    return timed.select(
        "accident_id",
        F.col("severity").cast("int").alias("severity"),
        lookup(F.col("severity"), fixed.SEVERITY_LABELS, fixed.UNKNOWN_SEVERITY).alias("severity_label"),
        start, F.col("end_time").try_cast("timestamp_ntz").alias("end_time"),
        F.to_date(start).alias("accident_date"), F.hour(start).alias("accident_hour"),
        times.sunday0(start).alias("day_of_week"), times.short_day_name(start).alias("day_name"),
        times.is_calendar_weekend(start).alias("is_weekend"),
        F.col("start_lat").alias("latitude"), F.col("start_lng").alias("longitude"),
        *[text[name] for name in ("street", "city", "county", "state", "zipcode", "timezone")],
        F.col("distance_mi").alias("distance_affected_mi"), text["description"],
        F.col("weather_timestamp").try_cast("timestamp_ntz").alias("weather_timestamp"),
        "temperature_f", "wind_chill_f", "humidity_pct", "pressure_in", "visibility_mi",
        text["wind_direction"], "wind_speed_mph", "precipitation_in", text["weather_condition"],
        *flags, text["sunrise_sunset"], text["civil_twilight"],
        "load_timestamp", clock(as_of).alias("dbt_updated_at"),
    )


def clean_accidents(raw: DataFrame) -> DataFrame:
    """Cleaned accident table: world-wide coordinate check, numeric and text defaults, typed times."""
    low, high = fixed.SEVERITY_RANGE
    valid = nan_as_null(raw).where(
        F.col("start_lat").between(-90, 90) & F.col("start_lng").between(-180, 180)
        & F.col("severity").between(low, high))
    typed = valid.withColumns({
        **{name: F.date_trunc("second", F.col(name).try_cast("timestamp_ntz")).cast("timestamp_ntz")
           for name in ("start_time", "end_time", "weather_timestamp")},
        **{name: is_true_text(F.col(name)) for name in fixed.ROAD_FLAGS},
    })
    return fill_defaults(typed, fixed.CLEANED_NUMBER_DEFAULTS, fixed.CLEANED_TEXT_COLUMNS, fixed.ROAD_FLAGS)


def stage_weather_history(raw: DataFrame, as_of: Moment = None) -> DataFrame:
    """Hourly weather of the state: calendar parts, inches, code labels, classes and flags."""
    kept = raw.where(F.col("record_id").isNotNull() & F.col("timestamp_utc").isNotNull()
                     & (F.col("state") == fixed.TARGET_STATE))
    moment, temperature, wind = F.col("timestamp_utc"), F.col("temperature_f"), F.col("wind_speed_mph")
    day = F.to_date(moment)
    labels = history_labels(F.col("weather_code"))
    flags = history_flags(temperature, wind, F.col("rain_mm"), F.col("snowfall_mm"))
    nothing = F.lit(None).cast("double")

    def inches(name: str):
        return F.round(F.col(name) * fixed.MM_TO_IN, 3)

    return kept.select(
        "record_id", "city", "state", "region", "county", F.lit("US").alias("country"), "latitude", "longitude",
        moment.alias("timestamp"), day.alias("date"), F.hour(moment).alias("hour"),
        times.sunday0(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        times.is_calendar_weekend(day).alias("is_weekend"),
        temperature, *[temperature.alias(name) for name in ("feels_like_f", "temp_min_f", "temp_max_f")],
        F.round(F.col("pressure_msl_hpa") * fixed.HPA_TO_INHG, 2).alias("pressure_in"),
        F.col("relative_humidity_pct").alias("humidity_pct"), nothing.alias("visibility_mi"),
        F.col("cloud_cover_pct").alias("clouds_pct"),
        wind, F.col("wind_direction_deg").alias("wind_deg"), F.col("wind_gusts_mph").alias("wind_gust_mph"),
        inches("rain_mm").alias("rain_1h_in"), nothing.alias("rain_3h_in"),
        inches("snowfall_mm").alias("snow_1h_in"), nothing.alias("snow_3h_in"),
        inches("precipitation_mm").alias("total_precip_1h_in"),
        "weather_code", *[label.alias(name) for name, label in labels.items()],
        below(temperature, fixed.TEMPERATURE_HISTORY).alias("temperature_category"),
        F.lit("Unknown").alias("visibility_category"),
        below(wind, fixed.WIND_HISTORY).alias("wind_category"),
        precipitation_history(F.col("precipitation_mm")).alias("precipitation_category"),
        *[value.alias(name) for name, value in flags.items()],
        "load_timestamp", "data_source", clock(as_of).alias("dbt_updated_at"),
    )


def stage_weather_current(raw: DataFrame) -> DataFrame:
    """Current weather with a temperature and a valid place, plus classes and flags."""
    kept = raw.where(F.col("temperature_f").isNotNull() & F.col("latitude").between(-90, 90)
                     & F.col("longitude").between(-180, 180))
    temperature, wind, rain = F.col("temperature_f"), F.col("wind_speed_mph"), F.col("precipitation_in")
    flags = current_flags(temperature, wind, rain, F.col("snowfall_in"))
    return kept.select(
        "record_id", "city", "state", "region", "county", "latitude", "longitude",
        F.col("timestamp_str").cast("timestamp_ntz").alias("timestamp_utc"), "date", "hour",
        "temperature_f", "feels_like_f", "temp_min_f", "temp_max_f",
        reached(temperature, fixed.TEMPERATURE_CURRENT).alias("temperature_category"),
        "pressure_msl_hpa", "surface_pressure_hpa", "humidity_pct",
        "wind_speed_mph", "wind_direction_deg", "wind_gusts_mph",
        reached(wind, fixed.WIND_CURRENT).alias("wind_category"),
        "cloud_cover_pct", "precipitation_in", "rain_in", "snowfall_in",
        precipitation_current(rain).alias("precipitation_category"),
        "weather_code", "weather_main", "weather_description", "weather_icon",
        *[value.alias(name) for name, value in flags.items()],
        "raw_json", "load_timestamp", "data_source",
    )


def stage_flow(raw: DataFrame) -> DataFrame:
    """Flow readings with both speeds known, plus reduction, congestion level and delay."""
    current, free = F.col("current_speed"), F.col("free_flow_speed")
    return raw.where((current >= 0) & (free >= 0)).select(
        "flow_id", "city", "state", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "latitude", "longitude",
        current.alias("current_speed_mph"), free.alias("free_flow_speed_mph"),
        speed_reduction_pct(free, current).alias("speed_reduction_pct"),
        congestion_level(free, current).alias("congestion_level"),
        F.col("current_travel_time").alias("current_travel_time_sec"),
        F.col("free_flow_travel_time").alias("free_flow_travel_time_sec"),
        (F.col("current_travel_time") - F.col("free_flow_travel_time")).alias("delay_sec"),
        F.col("confidence").alias("confidence_level"), flag(F.col("road_closure")).alias("road_closure"),
        "road_name", "load_timestamp", "raw_json",
    )
