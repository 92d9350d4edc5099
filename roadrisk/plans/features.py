"""Daily and trailing aggregates and the feature tables of the forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.bands import indicator
from ..functions.times import Moment, clock, hours_before, sunday0, today


# Day of a reading, by which the raw snapshots are stored.
EVENT_DATE = "event_date"


def daily_accidents(accidents: DataFrame, as_of: Moment = None, days: int | None = fixed.HISTORY_DAYS) -> DataFrame:
    """Accidents per city and day; ``days=None`` keeps the whole history (R2)."""
    rows = accidents.where(F.col("start_time").isNotNull() & F.col("city").isNotNull())
    if days is not None:
        rows = rows.where(F.col("start_time") >= F.date_sub(today(as_of), days).cast("timestamp_ntz"))
    return rows.groupBy(F.to_date("start_time").alias("date"), "city").agg(
        F.count(F.lit(1)).alias("accident_count"), F.avg("severity").alias("avg_severity"),
        F.count_if(F.col("severity") >= fixed.SERIOUS_FROM).alias("severe_accident_count"))


def daily_weather(weather: DataFrame, as_of: Moment = None, days: int = fixed.HISTORY_DAYS) -> DataFrame:
    since = F.date_sub(today(as_of), days).cast("timestamp_ntz")
    rows = weather.where(F.col("city").isNotNull() & (F.col("timestamp_utc") >= since))
    return rows.groupBy(F.to_date("timestamp_utc").alias("date"), "city").agg(
        F.avg("temperature_f").alias("avg_temp_f"), F.avg("relative_humidity_pct").alias("avg_humidity_pct"),
        F.avg("wind_speed_mph").alias("avg_wind_speed_mph"), F.avg("wind_gusts_mph").alias("avg_wind_gusts_mph"),
        F.sum("precipitation_mm").alias("total_precipitation_mm"), F.sum("rain_mm").alias("total_rain_mm"),
        F.sum("snowfall_mm").alias("total_snowfall_mm"), F.avg("cloud_cover_pct").alias("avg_cloud_cover_pct"),
        F.avg("pressure_msl_hpa").alias("avg_pressure_hpa"), F.max("wind_speed_mph").alias("max_wind_speed_mph"),
        F.min("temperature_f").alias("min_temp_f"), F.max("temperature_f").alias("max_temp_f"))


def zero_filled(daily: DataFrame) -> DataFrame:
    """Daily accidents with a row for every day from a city's first to its last one; days without accidents count 0.

    The calendar of a city is made from its own two dates, one row per day, and joined with the days that have accidents.
    """
    span = daily.groupBy("city").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    days = span.select("city", F.explode(F.sequence("_first", "_last")).alias("date"))
    counts = ("accident_count", "severe_accident_count")
    return days.join(daily, ["date", "city"], "left").select(
        "date", "city", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) if name in counts else F.col(name)
                          for name in daily.columns if name not in ("date", "city")])


def calendar_features(day: Column, weekend_dows: tuple[int, ...] = fixed.ML_WEEKEND_DOWS) -> dict[str, Column]:
    """On a 0-based day of week the default weekend (1, 7) marks Mondays only; pass (0, 6) for the calendar one."""
    dow = sunday0(day)
    return {"day_of_week": dow, "is_weekend": indicator(dow.isin(*weekend_dows)), "month": F.month(day)}


def training_table(accidents: DataFrame, weather: DataFrame, as_of: Moment = None,
                   weekend_dows: tuple[int, ...] = fixed.ML_WEEKEND_DOWS, zero_fill: bool = False) -> DataFrame:
    """City-days with three accidents or more, with weather, calendar and risk features.  Gaps stay gaps.

    With ``zero_fill`` every day from a city's first to its last one is a row, whatever its count.
    """
    daily = daily_accidents(accidents, as_of)
    counted = zero_filled(daily) if zero_fill else daily.where(F.col("accident_count") >= fixed.MIN_DAILY_ACCIDENTS)
    # Both sides are aggregates on the join keys, so their partitioning serves the join.
    joined = counted.join(daily_weather(weather, as_of), ["date", "city"], "left")
    calendar = calendar_features(F.col("date"), weekend_dows)
    known = joined.withColumns({
        "freezing_temp": indicator(F.coalesce("avg_temp_f", F.lit(fixed.DAILY_WEATHER_DEFAULTS["avg_temp_f"]))
                                   < fixed.FREEZING_F),
        # The flag takes missing wind as calm, the feature as its default.
        "high_wind": indicator(F.col("max_wind_speed_mph") > fixed.HIGH_WIND_MPH),
        "heavy_precipitation": indicator(F.col("total_precipitation_mm") > fixed.HEAVY_PRECIPITATION_DAY_MM),
        "snow_present": indicator(F.col("total_snowfall_mm") > 0),
    })
    return known.select(
        "date", "city", "accident_count", "avg_severity", "severe_accident_count",
        *[F.coalesce(F.col(name), F.lit(default)).alias(name)
          for name, default in fixed.DAILY_WEATHER_DEFAULTS.items()],
        *[value.alias(name) for name, value in calendar.items()], F.quarter("date").alias("quarter"),
        "heavy_precipitation", "high_wind", "freezing_temp", "snow_present")


def training_view(training: DataFrame, as_of: Moment = None) -> DataFrame:
    """The columns a model reads."""
    since = F.date_sub(today(as_of), fixed.HISTORY_DAYS)
    return training.where(F.col("date") >= since).select(
        "date", "city", "accident_count", *fixed.TRAINING_FEATURES)


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """Fail early when there is nothing to work on."""
    if rows.isEmpty():
        raise ValueError(f"no {what} available")
    return rows


def _since(rows: DataFrame, time: str, as_of: Moment, hours: int) -> DataFrame:
    """Rows of the trailing hours by their time text; a table stored by day reads only the days in question."""
    first = hours_before(clock(as_of), hours)
    recent = F.col(time).try_cast("timestamp_ntz") >= first
    if EVENT_DATE in rows.columns:
        recent &= F.col(EVENT_DATE) >= F.to_date(first)
    return rows.where(recent)


def _recent_weather(current: DataFrame, as_of: Moment, hours: int) -> DataFrame:
    return _since(current, "timestamp_str", as_of, hours)


def _signals(precipitation_above: float) -> list[Column]:
    return [
        F.avg("temperature_f").alias("current_temp_f"), F.avg("humidity_pct").alias("current_humidity_pct"),
        F.avg("wind_speed_mph").alias("current_wind_speed_mph"),
        F.avg("cloud_cover_pct").alias("current_cloud_cover_pct"),
        F.max(indicator(F.col("wind_speed_mph") > fixed.HIGH_WIND_MPH)).alias("has_high_wind"),
        F.max(indicator(F.col("temperature_f") < fixed.FREEZING_F)).alias("has_freezing_temp"),
        F.max(indicator(F.col("precipitation_in") > precipitation_above)).alias("has_precipitation"),
    ]


def latest_weather_for_features(current: DataFrame, as_of: Moment = None) -> DataFrame:
    """Per city over the trailing six hours; precipitation as a mean in millimetres."""
    return _recent_weather(current, as_of, fixed.FORECAST_WEATHER_HOURS).groupBy("city").agg(
        *_signals(fixed.FUTURE_PRECIPITATION_IN),
        (F.avg("precipitation_in") * fixed.IN_TO_MM).alias("current_precipitation_mm"))


def latest_weather_for_adjustment(current: DataFrame, as_of: Moment = None) -> DataFrame:
    """Per city over the trailing day; precipitation as a sum in inches."""
    return _recent_weather(current, as_of, fixed.ADJUST_HOURS).groupBy("city").agg(
        *_signals(fixed.ADJUST_PRECIPITATION_IN), F.sum("precipitation_in").alias("current_precipitation_in"))


def latest_traffic(flow: DataFrame, as_of: Moment = None) -> DataFrame:
    """Per city over the trailing day; congestion from the unrounded ratio."""
    free, current = F.col("free_flow_speed"), F.col("current_speed")
    congestion = F.when(free > 0, (free - current) / free * 100).otherwise(F.lit(0.0))
    return _since(flow, "timestamp", as_of, fixed.ADJUST_HOURS).groupBy("city").agg(
        F.avg(current).alias("avg_current_speed"), F.avg(free).alias("avg_free_flow_speed"),
        F.avg(congestion).alias("avg_congestion_pct"), F.count(F.lit(1)).alias("traffic_data_points"))


def future_features(view: DataFrame, current: DataFrame, as_of: Moment = None, horizon: int = fixed.HORIZON_DAYS,
                    weekend_dows: tuple[int, ...] = fixed.ML_WEEKEND_DOWS) -> DataFrame:
    """The coming days of every trained city, with recent weather standing in for the forecast."""
    last = F.date_add(today(as_of), horizon - 1)
    days = view.select("city").distinct().withColumn("date", F.explode(F.sequence(today(as_of), last)))
    joined = days.join(latest_weather_for_features(current, as_of), "city", "left")
    defaults = fixed.DAILY_WEATHER_DEFAULTS
    rain = F.coalesce("current_precipitation_mm", F.lit(defaults["total_precipitation_mm"]))
    calendar = calendar_features(F.col("date"), weekend_dows)
    return joined.select(
        "date", "city",
        F.coalesce("current_temp_f", F.lit(defaults["avg_temp_f"])).alias("avg_temp_f"),
        F.coalesce("current_humidity_pct", F.lit(defaults["avg_humidity_pct"])).alias("avg_humidity_pct"),
        F.coalesce("current_wind_speed_mph", F.lit(defaults["avg_wind_speed_mph"])).alias("avg_wind_speed_mph"),
        rain.alias("total_precipitation_mm"), rain.alias("total_rain_mm"), F.lit(0.0).alias("total_snowfall_mm"),
        *[value.alias(name) for name, value in calendar.items()],
        F.coalesce("has_precipitation", F.lit(0)).alias("heavy_precipitation"),
        F.coalesce("has_high_wind", F.lit(0)).alias("high_wind"),
        F.coalesce("has_freezing_temp", F.lit(0)).alias("freezing_temp"), F.lit(0).alias("snow_present"))
