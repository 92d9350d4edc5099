"""The runs that fill the layered tables below one root folder.

Every run reads stored tables and writes stored tables, so each can be repeated
on its own.  Staging models stay lazy views; analytics and marts are tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions.times import Moment
from .operators import quality, sinks
from .plans import (correlation, features, forecast, safety_mart, staging, traffic_mart, weather_fact,
                    weather_features)
from .sources import accidents, cities, payloads
from .sources.tables import read_table, table_path, trailing_days


def _landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LANDED).json(path)


def _raw(spark: SparkSession, root: str, layer: str, table: str, schema: str) -> DataFrame:
    return read_table(spark, root, layer, table, schema)


def _raw_by_day(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """A raw snapshot that is stored by the day of its readings, for the trailing filters to prune."""
    return _raw(spark, root, "raw", table, f"{schema}, {features.EVENT_DATE} date")


def _replace_by_day(rows: DataFrame, path: str, time: str) -> None:
    day = F.to_date(F.col(time).try_cast("timestamp_ntz"))
    sinks.replace(rows.withColumn(features.EVENT_DATE, day), path, [features.EVENT_DATE])


def _quarantine(root: str, source: str, landed: DataFrame, schema: str, as_of: Moment) -> None:
    """Broken answers of one load, with the reason; the good ones of the load go on without them."""
    broken = payloads.unreadable(landed, schema).select(
        F.lit(source).alias("source"), "city", "fetched_at", payloads.CORRUPT, F.lit("broken JSON").alias("reason"))
    sinks.append(sinks.with_audit(broken, as_of), table_path(root, "raw", "quarantine"),
                 new_by=["source", "city", "fetched_at", payloads.CORRUPT])


# --- loads --------------------------------------------------------------------------------------


def load_accidents(spark: SparkSession, root: str, csv_path: str, as_of: Moment = None) -> bool:
    """Accident CSV files into the raw table (append of new ids) and the cleaned one (at most once a day).

    Records that are no accident go into quarantine, once each however often a file is loaded.
    """
    raw = table_path(root, "raw_archive", "traffic_accidents_raw")
    broken = accidents.broken_records(spark, csv_path).select(
        F.lit("accidents").alias("source"), F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("fetched_at"), payloads.CORRUPT, "reason")
    sinks.append(sinks.with_audit(broken, as_of), table_path(root, "raw", "quarantine"),
                 new_by=["source", "city", "fetched_at", payloads.CORRUPT])
    sinks.append(accidents.read_records(spark, csv_path, as_of=as_of), raw, new_by=["accident_id"],
                 order=["load_timestamp"])
    stored = _raw(spark, root, "raw_archive", "traffic_accidents_raw", schemas.ACCIDENTS_RAW)
    cleaned = staging.clean_accidents(stored).drop("load_timestamp")
    audited = sinks.with_audit(cleaned, as_of, "csv")
    return sinks.refresh_once_a_day(audited, table_path(root, "raw_archive", "traffic_accidents_historical"), as_of)


def load_weather_history(spark: SparkSession, root: str, landed_path: str, as_of: Moment = None) -> None:
    """Hourly answers of the last days into the raw table and the cleaned one."""
    landed = _landed(spark, landed_path)
    _quarantine(root, "hourly weather", landed, schemas.HOURLY_PAYLOAD, as_of)
    hours = payloads.hourly_weather(landed, cities.city_dimension(spark))
    recent = sinks.with_audit(trailing_days(hours, "timestamp_utc", as_of), as_of, "hourly answers")
    sinks.replace(recent, table_path(root, "raw_archive", "weather_california_historical_raw"))
    stored = _raw(spark, root, "raw_archive", "weather_california_historical_raw", schemas.WEATHER_HISTORICAL_RAW)
    sinks.replace(weather_features.history_features(stored),
                  table_path(root, "raw_archive", "weather_california_historical_etl"))


def load_current_weather(spark: SparkSession, root: str, landed_path: str, as_of: Moment = None) -> None:
    """Current answers as a snapshot: raw table, cleaned table and weather fact."""
    landed = _landed(spark, landed_path)
    _quarantine(root, "current weather", landed, schemas.CURRENT_PAYLOAD, as_of)
    now = payloads.current_weather(landed, cities.city_dimension(spark))
    _replace_by_day(sinks.with_audit(now, as_of, "current answers"),
                    table_path(root, "raw", "weather_california_realtime_raw"), "timestamp_str")
    stored = _raw(spark, root, "raw", "weather_california_realtime_raw", schemas.WEATHER_REALTIME_RAW)
    sinks.replace(weather_features.current_features(stored), table_path(root, "raw", "weather_california_realtime_etl"))
    sinks.replace(weather_fact.weather_fact(staging.stage_weather_current(stored), as_of),
                  table_path(root, "marts", "fct_weather_current"))


def load_traffic(spark: SparkSession, root: str, flow_path: str, incident_path: str, as_of: Moment = None) -> None:
    """Flow and incident answers as a snapshot: raw tables, cleaned tables and the traffic mart."""
    dimension = cities.city_dimension(spark)
    flow, incidents = _landed(spark, flow_path), _landed(spark, incident_path)
    _quarantine(root, "flow", flow, schemas.FLOW_PAYLOAD, as_of)
    _quarantine(root, "incidents", incidents, schemas.INCIDENTS_PAYLOAD, as_of)
    _replace_by_day(sinks.with_audit(payloads.flow_raw(flow, dimension), as_of),
                    table_path(root, "raw", "traffic_flow_raw"), "timestamp")
    for name, rows in (("traffic_flow_realtime", payloads.flow_cleaned(flow, dimension)),
                       ("traffic_incidents_raw", sinks.with_audit(payloads.incidents_raw(incidents, dimension), as_of)),
                       ("traffic_incidents_realtime", payloads.incidents_cleaned(incidents, dimension))):
        sinks.replace(rows, table_path(root, "raw", name))
    stored = _raw(spark, root, "raw", "traffic_flow_raw", schemas.TRAFFIC_FLOW_RAW)
    sinks.replace(traffic_mart.traffic_mart(staging.stage_flow(stored)),
                  table_path(root, "marts", "mart_realtime_traffic_dashboard"))


# --- builds ---------------------------------------------------------------------------------------


def build_safety(spark: SparkSession, root: str, as_of: Moment = None) -> None:
    """Correlation table and safety mart from the raw accidents and the raw hourly weather."""
    crashes = staging.stage_accidents(
        _raw(spark, root, "raw_archive", "traffic_accidents_raw", schemas.ACCIDENTS_RAW), as_of)
    hours = staging.stage_weather_history(
        _raw(spark, root, "raw_archive", "weather_california_historical_raw", schemas.WEATHER_HISTORICAL_RAW), as_of)
    sinks.replace(correlation.accident_weather(crashes, hours, as_of),
                  table_path(root, "analytics", "accident_weather_correlation"))
    stored = read_table(spark, root, "analytics", "accident_weather_correlation")
    sinks.replace(safety_mart.safety_mart(stored, as_of, keep=False),
                  table_path(root, "marts", "mart_traffic_safety_dashboard"))


def build_forecast(spark: SparkSession, root: str, as_of: Moment = None, method: str = "trend") -> DataFrame:
    """Training, future, forecast and adjusted tables; returns the risk assessment as a lazy view.

    ``method`` is ``trend`` (per city, closed form), ``features`` (per city, ridge regression on the features) or
    ``pooled`` (one linear model of all cities).  Cities that the trend leaves out are listed with the reason.
    """
    def keep(rows: DataFrame, table: str) -> DataFrame:
        sinks.replace(rows, table_path(root, "ml_predictions", table))
        return read_table(spark, root, "ml_predictions", table)

    crashes = _raw(spark, root, "raw_archive", "traffic_accidents_historical", schemas.ACCIDENTS_HISTORICAL)
    hours = _raw(spark, root, "raw_archive", "weather_california_historical_raw", schemas.WEATHER_HISTORICAL_RAW)
    now = _raw_by_day(spark, root, "weather_california_realtime_raw", schemas.WEATHER_REALTIME_RAW)
    flow = _raw_by_day(spark, root, "traffic_flow_raw", schemas.TRAFFIC_FLOW_RAW)

    training = keep(features.training_table(crashes, hours, as_of), "accident_training_enriched")
    features.require_rows(training, "training data")
    view = features.training_view(training, as_of)
    future = keep(features.future_features(view, now, as_of), "future_exogenous_data")
    if method == "trend":
        predicted = forecast.forecast_trend(forecast.fit_trend(view, as_of), future, as_of)
        keep(forecast.skipped_series(view), "accident_forecast_skipped")
    elif method == "features":
        predicted = forecast.forecast_city_ridge(forecast.fit_city_ridge(view), future)
    elif method == "pooled":
        predicted = forecast.forecast_features(*forecast.fit_features(view), future)
    else:
        raise ValueError(f"unknown method {method!r}")
    predicted = keep(predicted, "accident_forecast")
    final = keep(forecast.adjusted_forecast(training, predicted, now, flow, as_of), "accident_forecast_final")
    return sinks.publish_view(forecast.risk_assessment(final), "accident_risk_assessment_realtime")


def quality_report(spark: SparkSession, root: str, as_of: Moment = None) -> DataFrame:
    """Failures of all declared checks on the tables below ``root``."""
    models = {
        "stg_traffic_accidents": staging.stage_accidents(
            _raw(spark, root, "raw_archive", "traffic_accidents_raw", schemas.ACCIDENTS_RAW), as_of),
        "stg_weather_historical": staging.stage_weather_history(_raw(
            spark, root, "raw_archive", "weather_california_historical_raw", schemas.WEATHER_HISTORICAL_RAW), as_of),
        "stg_traffic_flow_realtime": staging.stage_flow(
            _raw(spark, root, "raw", "traffic_flow_raw", schemas.TRAFFIC_FLOW_RAW)),
        "accident_weather_correlation": read_table(spark, root, "analytics", "accident_weather_correlation"),
        "fct_weather_current": read_table(spark, root, "marts", "fct_weather_current"),
    }
    first, *others = [quality.run_checks(rows, model) for model, rows in models.items()]
    for other in others:
        first = first.unionByName(other)
    return first
