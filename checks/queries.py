"""One query per operator over the driver's tables, and its DuckDB statement."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.functions import fixed, times
from roadrisk.operators import fill, joins, quality, shared, sinks
from roadrisk.plans import (correlation, features, forecast, joint_forecast, safety_mart, staging, traffic_mart, trends,
                            weather_fact, weather_features)
from roadrisk.sources import accidents, cities, payloads, records, tables
from roadrisk.streaming import landing, panes, windows

from . import oracle
from .oracle import NOW, TODAY, rnd
from .roles import AS_OF, raw, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = oracle.sql(sql, *needs)
        return build
    return register


# --- shared inputs ---------------------------------------------------------------------------


def staged_accidents(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_accidents(raw(spark, sf, "accidents_raw"), AS_OF)


def cleaned_accidents(spark: SparkSession, sf: str) -> DataFrame:
    return staging.clean_accidents(raw(spark, sf, "accidents_raw"))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "weather_historical_raw")


def staged_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_weather_history(hourly(spark, sf), AS_OF)


def current(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "weather_realtime_raw")


def flow(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "traffic_flow_raw")


def staged_flow(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_flow(flow(spark, sf))


def correlated(spark: SparkSession, sf: str) -> DataFrame:
    return correlation.accident_weather(staged_accidents(spark, sf), staged_hourly(spark, sf), AS_OF)


def training(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_table(cleaned_accidents(spark, sf), hourly(spark, sf), AS_OF)


def coming(spark: SparkSession, sf: str, trained: DataFrame) -> DataFrame:
    return features.future_features(features.training_view(trained, AS_OF), current(spark, sf), AS_OF)


def trend_forecast(spark: SparkSession, sf: str, trained: DataFrame) -> DataFrame:
    model = forecast.fit_trend(features.training_view(trained, AS_OF), AS_OF)
    return forecast.forecast_trend(model, coming(spark, sf, trained), AS_OF)


def final(spark: SparkSession, sf: str) -> DataFrame:
    trained = shared.written(training(spark, sf), "training")
    return forecast.adjusted_forecast(
        trained, trend_forecast(spark, sf, trained), current(spark, sf), flow(spark, sf), AS_OF)


def rounded(rows: DataFrame, digits: int, *names: str) -> DataFrame:
    """Results of long floating computations, rounded to what both engines agree on."""
    return rows.withColumns({name: F.round(F.col(name), digits) for name in names})


# --- sources ---------------------------------------------------------------------------------------

_CSV_HEADERS = {name: header for header, name in fixed.rows(fixed.ACCIDENT_COLUMNS, header=False)}


@query("scan_filter_rename", """
    SELECT * EXCLUDE (load_timestamp) REPLACE (nullif(trim(street), '') AS street, nullif(end_time, 'n/a') AS end_time)
    FROM accidents_raw WHERE state = 'CA'""", ("accidents_raw",))
def scan_filter_rename(spark: SparkSession, sf: str) -> DataFrame:
    """Written as a CSV file with the service's header, then read back as accidents of one state."""
    path = shared.scratch_path(spark, "accidents-csv")
    source = raw(spark, sf, "accidents_raw").withColumn("street", F.trim("street"))
    source.select(*[F.col(name).cast("string").alias(header) for name, header in _CSV_HEADERS.items()]).write.option(
        "header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return accidents.read_csv(spark, path, as_of=AS_OF).drop("load_timestamp")


@query("csv_line_breaks", """
    SELECT accident_id, severity, CASE WHEN severity % 2 = 0 THEN accident_id || ' "said",' || chr(10) || chr(10) || 'then, ' || severity
                                       ELSE 'one line' END AS description,
           state, NULL AS broken, NULL AS reason FROM accidents_raw
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, accident_id || ',"two' || chr(10) || 'lines"', 'wrong number of fields'
    FROM accidents_raw WHERE severity = 3""", ("accidents_raw",))
def csv_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Accidents written as CSV with line breaks, quotes and commas inside fields, next to broken records: all come back."""
    path = shared.scratch_path(spark, "accidents-csv")
    said = F.concat("accident_id", F.lit(' "said",\n\nthen, '), F.col("severity").cast("string"))
    source = raw(spark, sf, "accidents_raw").withColumn(
        "description", F.when(F.col("severity") % 2 == 0, said).otherwise("one line"))
    source.select(*[F.col(name).cast("string").alias(header) for name, header in _CSV_HEADERS.items()]).write.option(
        "header", True).option("escape", '"').csv(path)
    source.where("severity = 3").select(F.concat("accident_id", F.lit(',"two\nlines"'))).write.mode("append").text(path)
    header = ",".join(_CSV_HEADERS.values())
    read = records.parsed(spark, path, header)
    good = accidents.project(read.where("reason IS NULL")).select("accident_id", "severity", "description", "state")
    bad = read.where("reason IS NOT NULL").select(F.col(records.CORRUPT).alias("broken"), "reason")
    return good.unionByName(bad, allowMissingColumns=True)


@query("clean_accidents_validated", "SELECT * FROM accidents_clean", ("accidents_clean",))
def clean_accidents_validated(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned_accidents(spark, sf)


_FLOW_JSON = "json_extract_string(payload, '$.flowSegmentData.{}')"


def _flow(name: str) -> str:
    return _FLOW_JSON.format(name)


@query("json_parse_defaults", f"""
    SELECT *, CASE WHEN free_flow_speed_mph > 0
                   THEN {rnd("(free_flow_speed_mph - current_speed_mph) / free_flow_speed_mph * 100", 2)}
                   ELSE 0e0 END AS speed_reduction_pct,
           current_travel_time_sec - free_flow_travel_time_sec AS delay_sec
    FROM (SELECT city || '_' || replace(replace(fetched_at, ' ', '_'), ':', '') AS flow_id, city, 'CA' AS state,
                 ifnull({_flow("frc")}, 'Unknown') AS road_name, city || '_segment' AS road_segment_id,
                 cast(fetched_at AS timestamp) AS timestamp, lat AS latitude, lon AS longitude,
                 ifnull(cast({_flow("currentSpeed")} AS double), 0) AS current_speed_mph,
                 ifnull(cast({_flow("freeFlowSpeed")} AS double), 0) AS free_flow_speed_mph,
                 ifnull(cast({_flow("currentTravelTime")} AS int), 0) AS current_travel_time_sec,
                 ifnull(cast({_flow("freeFlowTravelTime")} AS int), 0) AS free_flow_travel_time_sec,
                 ifnull(cast({_flow("confidence")} AS double), 0.5e0) AS confidence_level,
                 ifnull(cast({_flow("roadClosure")} AS boolean), false) AS road_closure
          FROM (SELECT * FROM landed_flow WHERE json_valid(payload)) JOIN cities ON city = name)""",
       ("landed_flow", "cities"))
def json_parse_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.flow_cleaned(raw(spark, sf, "landed_flow"), cities.city_dimension(spark))


@query("json_parse_raw", f"""
    SELECT city || '_' || replace(replace(fetched_at, ' ', '_'), ':', '') AS flow_id, city, 'CA' AS state,
           fetched_at AS timestamp, lat AS latitude, lon AS longitude,
           cast({_flow("currentSpeed")} AS double) AS current_speed,
           cast({_flow("freeFlowSpeed")} AS double) AS free_flow_speed,
           cast({_flow("currentTravelTime")} AS int) AS current_travel_time,
           cast({_flow("freeFlowTravelTime")} AS int) AS free_flow_travel_time,
           cast({_flow("confidence")} AS double) AS confidence,
           ifnull(cast({_flow("roadClosure")} AS boolean), false) AS road_closure,
           ifnull({_flow("frc")}, 'Unknown') AS road_name,
           replace(replace(substring(payload, 21, length(payload) - 21), ': ', ':'), ', ', ',') AS raw_json
    FROM (SELECT * FROM landed_flow WHERE json_valid(payload)) JOIN cities ON city = name""",
       ("landed_flow", "cities"))
def json_parse_raw(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.flow_raw(raw(spark, sf, "landed_flow"), cities.city_dimension(spark))


def _hour(name: str) -> str:
    return f"try_cast(json_extract_string(payload, '$.hourly.{name}[' || i || ']') AS double)"


@query("array_zip_explode", f"""
    SELECT replace(city, ' ', '_') || '_' || replace(replace(replace(t, '-', ''), ':', ''), 'T', '_') AS record_id,
           city, 'CA' AS state, region, county, lat AS latitude, lon AS longitude,
           cast(replace(t, 'Z', '') AS timestamp) AS timestamp_utc,
           {_hour("temperature_2m")} AS temperature_f, {_hour("relative_humidity_2m")} AS relative_humidity_pct,
           {_hour("precipitation")} AS precipitation_mm, {_hour("rain")} AS rain_mm,
           {_hour("snowfall")} AS snowfall_mm, {_hour("cloud_cover")} AS cloud_cover_pct,
           {_hour("pressure_msl")} AS pressure_msl_hpa, {_hour("wind_speed_10m")} AS wind_speed_mph,
           {_hour("wind_direction_10m")} AS wind_direction_deg, {_hour("wind_gusts_10m")} AS wind_gusts_mph,
           cast({_hour("weather_code")} AS int) AS weather_code
    FROM (SELECT *, json_extract_string(payload, '$.hourly.time[' || i || ']') AS t
          FROM (SELECT *, unnest(range(cast(json_array_length(payload, '$.hourly.time') AS bigint))) AS i
                FROM landed_hourly)) JOIN cities ON city = name""", ("landed_hourly", "cities"))
def array_zip_explode(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.hourly_weather(raw(spark, sf, "landed_hourly"), cities.city_dimension(spark))


def _now(name: str) -> str:
    return f"cast(json_extract_string(payload, '$.current.{name}') AS double)"


@query("current_weather_parse", f"""
    SELECT replace(city, ' ', '_') || '_' || strftime(t, '%Y%m%d_%H%M') AS record_id, city, 'CA' AS state,
           p.region, p.county, lat AS latitude, lon AS longitude, strftime(t, '%Y-%m-%d %H:%M:%S') AS timestamp_str,
           strftime(t, '%Y-%m-%d') AS date, cast(hour(t) AS int) AS hour,
           {_now("temperature_2m")} AS temperature_f, {_now("temperature_2m")} AS temp_min_f,
           {_now("temperature_2m")} AS temp_max_f, {_now("apparent_temperature")} AS feels_like_f,
           {_now("pressure_msl")} AS pressure_msl_hpa, {_now("surface_pressure")} AS surface_pressure_hpa,
           {_now("relative_humidity_2m")} AS humidity_pct, {_now("wind_speed_10m")} AS wind_speed_mph,
           {_now("wind_direction_10m")} AS wind_direction_deg, {_now("wind_gusts_10m")} AS wind_gusts_mph,
           {_now("cloud_cover")} AS cloud_cover_pct, {_now("precipitation")} AS precipitation_in,
           {_now("rain")} AS rain_in, {_now("snowfall")} AS snowfall_in, wc AS weather_code,
           ifnull(main_current, 'Unknown') AS weather_main,
           CASE WHEN main_current IS NULL THEN 'unknown' ELSE description END AS weather_description,
           CASE WHEN main_current IS NULL THEN '01d' ELSE icon END AS weather_icon, payload AS raw_json
    FROM (SELECT *, cast(ifnull(json_extract_string(payload, '$.current.time'), fetched_at) AS timestamp) AS t,
                 cast(ifnull({_now("weather_code")}, 0) AS int) AS wc
          FROM landed_current) JOIN cities p ON city = name LEFT JOIN codes ON code = wc""",
       ("landed_current", "cities", "codes"))
def current_weather_parse(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.current_weather(raw(spark, sf, "landed_current"), cities.city_dimension(spark))


_INCIDENTS_SQL = """
    (SELECT l.city, lat, lon, fetched_at, i, json_extract(payload, '$.incidents[' || i || ']') AS inc
     FROM (SELECT *, unnest(range(4)) AS i FROM landed_incidents) l JOIN cities c ON l.city = c.name)"""


def _inc(path: str) -> str:
    return f"json_extract_string(inc, '$.{path}')"


@query("incident_explode_coords", f"""
    SELECT ifnull({_inc("properties.id")}, 'INC_' || city || '_' || i) AS incident_id, city, 'CA' AS state,
           fetched_at AS timestamp,
           CASE {_inc("geometry.type")} WHEN 'LineString' THEN cast({_inc("geometry.coordinates[0][1]")} AS double)
                WHEN 'Point' THEN cast({_inc("geometry.coordinates[1]")} AS double) ELSE lat END AS latitude,
           CASE {_inc("geometry.type")} WHEN 'LineString' THEN cast({_inc("geometry.coordinates[0][0]")} AS double)
                WHEN 'Point' THEN cast({_inc("geometry.coordinates[0]")} AS double) ELSE lon END AS longitude,
           {_inc("properties.iconCategory")} AS icon_category,
           cast({_inc("properties.magnitudeOfDelay")} AS int) AS magnitude_of_delay,
           {_inc("properties.events[0].description")} AS description, {_inc("properties.startTime")} AS start_time,
           {_inc("properties.endTime")} AS end_time
    FROM {_INCIDENTS_SQL}""", ("landed_incidents", "cities"))
def incident_explode_coords(spark: SparkSession, sf: str) -> DataFrame:
    rows = payloads.incidents_raw(raw(spark, sf, "landed_incidents"), cities.city_dimension(spark))
    return rows.drop("raw_json")


_INCIDENT_ROWS = f"""
    SELECT ifnull({_inc("properties.id")}, 'INC_' || city || '_' || i) AS incident_id, city, 'CA' AS state,
           cast(fetched_at AS timestamp) AS timestamp,
           coalesce(cast({_inc("geometry.coordinates[0][1]")} AS double),
                    cast({_inc("geometry.coordinates[1]")} AS double), lat) AS latitude,
           coalesce(cast({_inc("geometry.coordinates[0][0]")} AS double),
                    try_cast({_inc("geometry.coordinates[0]")} AS double), lon) AS longitude,
           {_inc("properties.events[0].description")} AS street,
           ifnull({_inc("properties.iconCategory")}, 'UNKNOWN') AS incident_type,
           CASE WHEN m < 3 THEN (['MINOR', 'MODERATE', 'MAJOR'])[m + 1] ELSE 'CRITICAL' END AS severity,
           ifnull({_inc("properties.events[0].description")}, 'No description') AS description,
           ifnull(cast(round(cast({_inc("properties.delay")} AS int) / 60) AS int), 0) AS delay_minutes, 0 AS length_meters,
           0 AS affected_road_count,
           cast(replace(ifnull({_inc("properties.startTime")}, fetched_at), 'Z', '') AS timestamp) AS start_time,
           cast({_inc("properties.endTime")} AS timestamp) AS end_time, true AS is_active
    FROM (SELECT *, ifnull(cast({_inc("properties.magnitudeOfDelay")} AS int), 0) AS m FROM {_INCIDENTS_SQL})"""


@query("incident_severity", _INCIDENT_ROWS, ("landed_incidents", "cities"))
def incident_severity(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.incidents_cleaned(raw(spark, sf, "landed_incidents"), cities.city_dimension(spark))


@query("timestamp_two_formats", """
    SELECT accident_id, try_cast(start_time AS timestamp) AS parsed,
           strftime(try_cast(start_time AS timestamp), '%Y-%m-%d %H:%M:%S') AS text
    FROM accidents_raw""", ("accidents_raw",))
def timestamp_two_formats(spark: SparkSession, sf: str) -> DataFrame:
    parsed = times.parse_time(F.col("start_time"))
    return raw(spark, sf, "accidents_raw").select(
        "accident_id", parsed.alias("parsed"), times.time_text(parsed).alias("text"))


@query("city_bbox_range_join", """
    SELECT event_id, latitude, longitude, name AS box_city, lon - 0.1e0 AS min_lon, lat - 0.1e0 AS min_lat,
           lon + 0.1e0 AS max_lon, lat + 0.1e0 AS max_lat
    FROM (SELECT event_id, 32.5e0 + (event_id * 7919 % 950) / 1e2 AS latitude,
                 -124.5e0 + (event_id * 7907 % 1050) / 1e2 AS longitude FROM events)
         JOIN cities ON latitude >= lat - 0.1e0 AND latitude <= lat + 0.1e0
                    AND longitude >= lon - 0.1e0 AND longitude <= lon + 0.1e0""", ("cities",))
def city_bbox_range_join(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "events").select(
        "event_id", (F.lit(32.5) + F.col("event_id") * 7919 % 950 / 1e2).alias("latitude"),
        (F.lit(-124.5) + F.col("event_id") * 7907 % 1050 / 1e2).alias("longitude"))
    return joins.inside_city_boxes(points, cities.city_dimension(spark))


@query("incident_city_boxes", f"""
    SELECT incident_id, latitude, longitude, name AS box_city
    FROM (SELECT incident_id, latitude, longitude FROM ({_INCIDENT_ROWS}))
         JOIN cities ON latitude >= lat - 0.1e0 AND latitude <= lat + 0.1e0
                    AND longitude >= lon - 0.1e0 AND longitude <= lon + 0.1e0""", ("landed_incidents", "cities"))
def incident_city_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents and every city whose box holds them."""
    rows = payloads.incidents_cleaned(raw(spark, sf, "landed_incidents"), cities.city_dimension(spark))
    return joins.inside_city_boxes(rows.select("incident_id", "latitude", "longitude"),
                                   cities.city_dimension(spark)).select("incident_id", "latitude", "longitude", "box_city")


_LAST_DAY = "2024-01-30"


@query("trailing_extract", f"""
    SELECT * FROM events WHERE cast(ts AS date) BETWEEN date '{_LAST_DAY}' - 5 AND date '{_LAST_DAY}'""")
def trailing_extract(spark: SparkSession, sf: str) -> DataFrame:
    return tables.trailing_days(table(spark, sf, "events"), "ts", _LAST_DAY)


@query("city_dimension_join", """
    SELECT city, region, county, lat AS latitude, lon AS longitude, count(*) AS answers
    FROM landed_flow JOIN cities ON city = name GROUP BY ALL""", ("landed_flow", "cities"))
def city_dimension_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = payloads.at_city(raw(spark, sf, "landed_flow"), cities.city_dimension(spark))
    return rows.groupBy("city", "region", "county", "latitude", "longitude").agg(F.count(F.lit(1)).alias("answers"))


# --- cleaning ----------------------------------------------------------------------------------------------


@query("clean_accidents", "SELECT * FROM stg_accidents", ("stg_accidents",))
def clean_accidents(spark: SparkSession, sf: str) -> DataFrame:
    return staged_accidents(spark, sf)


@query("fill_defaults", """
    SELECT accident_id, ifnull(distance_mi, 0e0) AS distance_mi, ifnull(temperature_f, 70e0) AS temperature_f,
           ifnull(humidity_pct, 50e0) AS humidity_pct, ifnull(pressure_in, 29.92e0) AS pressure_in,
           ifnull(street, '') AS street, ifnull(try_cast(trim(junction) AS boolean), false) AS junction,
           wind_chill_f
    FROM accidents_raw""", ("accidents_raw",))
def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw(spark, sf, "accidents_raw").select(
        "accident_id", "distance_mi", F.coalesce("temperature_f", F.lit(float("nan"))).alias("temperature_f"),
        "humidity_pct", "pressure_in", "street", F.trim("junction").try_cast("boolean").alias("junction"),
        F.coalesce("wind_chill_f", F.lit(float("nan"))).alias("wind_chill_f"))
    numbers = {name: fixed.CLEANED_NUMBER_DEFAULTS[name] for name in
               ("distance_mi", "temperature_f", "humidity_pct", "pressure_in")}
    return fill.fill_defaults(fill.nan_as_null(rows), numbers, ("street",), ("junction",))


@query("weather_hist_staging", "SELECT * FROM stg_weather", ("stg_weather",))
def weather_hist_staging(spark: SparkSession, sf: str) -> DataFrame:
    return staged_hourly(spark, sf)


@query("weather_rt_staging", "SELECT * FROM stg_current", ("stg_current",))
def weather_rt_staging(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_weather_current(current(spark, sf))


@query("weather_history_features", f"""
    SELECT record_id, city, state, region, county, latitude, longitude, timestamp_utc,
           cast(timestamp_utc AS date) AS date, cast(hour(timestamp_utc) AS int) AS hour,
           cast(isodow(timestamp_utc) - 1 AS int) AS day_of_week, dayname(timestamp_utc) AS day_name,
           cast(month(timestamp_utc) AS int) AS month, cast(year(timestamp_utc) AS int) AS year,
           ifnull(temperature_f, 0) AS temperature_f,
           {rnd("ifnull((temperature_f - 32) * 5 / 9, 0)", 6)} AS temperature_c,
           {", ".join(f"ifnull({n}, 0) AS {n}" for n in (
               "relative_humidity_pct", "precipitation_mm", "rain_mm", "snowfall_mm", "cloud_cover_pct",
               "pressure_msl_hpa", "wind_speed_mph", "wind_direction_deg", "wind_gusts_mph", "weather_code"))},
           CASE WHEN weather_code IS NULL THEN 'Unknown' ELSE ifnull(label, 'Other') END AS weather_condition,
           {rnd("ifnull(" + oracle.heat("temperature_f", "relative_humidity_pct") + ", 0)", 6)} AS heat_index_f,
           {oracle.yes("temperature_f > 100")} AS is_extreme_heat,
           {oracle.yes("temperature_f < 32")} AS is_extreme_cold, {oracle.yes("wind_speed_mph > 25")} AS is_high_wind,
           {oracle.yes("precipitation_mm > 0")} AS is_precipitation, load_timestamp, data_source
    FROM weather_historical_raw LEFT JOIN conditions ON code = weather_code""",
       ("weather_historical_raw", "conditions"))
def weather_history_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(weather_features.history_features(hourly(spark, sf)), 6, "temperature_c", "heat_index_f")


_IN = fixed.IN_TO_MM


@query("weather_etl_features", f"""
    SELECT record_id, city, state, region, county, latitude, longitude, t AS timestamp_utc,
           cast(t AS date) AS date, cast(hour(t) AS int) AS hour, cast(isodow(t) - 1 AS int) AS day_of_week,
           dayname(t) AS day_name, cast(month(t) AS int) AS month, monthname(t) AS month_name,
           cast(year(t) AS int) AS year, isodow(t) >= 6 AS is_weekend, {oracle.period("hour(t)")} AS time_of_day,
           {", ".join(f"ifnull({n}, 0) AS {n}" for n in (
               "temperature_f", "feels_like_f", "temp_min_f", "temp_max_f", "pressure_msl_hpa",
               "surface_pressure_hpa", "humidity_pct", "wind_speed_mph", "wind_direction_deg", "wind_gusts_mph",
               "cloud_cover_pct", "precipitation_in", "rain_in", "snowfall_in", "weather_code"))},
           {rnd("ifnull((temperature_f - 32) * 5 / 9, 0)", 6)} AS temperature_c,
           {rnd("ifnull((feels_like_f - 32) * 5 / 9, 0)", 6)} AS feels_like_c,
           ifnull(temperature_f - feels_like_f, 0) AS temp_feels_diff,
           {rnd("ifnull(" + oracle.heat("temperature_f", "humidity_pct") + ", 0)", 6)} AS heat_index_f,
           {rnd("ifnull(" + oracle.chill("temperature_f", "wind_speed_mph") + ", 0)", 6)} AS wind_chill_f,
           {rnd(f"ifnull(precipitation_in * {_IN}e0, 0)", 6)} AS precipitation_mm,
           {rnd(f"ifnull(rain_in * {_IN}e0, 0)", 6)} AS rain_mm,
           {rnd(f"ifnull(snowfall_in * {_IN}e0, 0)", 6)} AS snowfall_mm,
           w = 'Clear' AS is_clear, w = 'Clouds' AS is_cloudy, w = 'Rain' OR w = 'Drizzle' AS is_rainy,
           w = 'Thunderstorm' AS is_stormy, w = 'Snow' AS is_snowy, w = 'Fog' AS is_foggy,
           w = 'Fog' OR w = 'Snow' AS is_low_visibility,
           CASE WHEN temperature_f + humidity_pct IS NULL THEN 'Unknown'
                ELSE (CASE WHEN humidity_pct < 60
                      THEN ['Very Cold', 'Cold', 'Comfortable', 'Warm', 'Very Hot', 'Extreme Heat']
                      ELSE ['Very Cold', 'Cold', 'Humid', 'Hot & Humid', 'Very Hot', 'Extreme Heat'] END)
                     [1 + cast(temperature_f >= 32 AS int) + cast(temperature_f >= 50 AS int)
                        + cast(temperature_f > 75 AS int) + cast(temperature_f > 85 AS int)
                        + cast(temperature_f > 95 AS int)] END AS comfort_level,
           {oracle.yes("temperature_f > 100")} AS is_extreme_heat,
           {oracle.yes("temperature_f < 32")} AS is_extreme_cold, {oracle.yes("wind_speed_mph > 25")} AS is_high_wind,
           {oracle.yes("humidity_pct > 80")} AS is_high_humidity,
           {oracle.yes("precipitation_in > 0")} AS is_precipitation,
           ifnull({oracle.compass("wind_direction_deg", False)}, 'Unknown') AS wind_direction_cardinal,
           CASE WHEN {oracle.yes("pressure_msl_hpa > 1013 AND humidity_pct < 70")} THEN 'Good'
                WHEN {oracle.yes("pressure_msl_hpa > 1000")} THEN 'Moderate' ELSE 'Poor' END AS aqi_estimate,
           ifnull(weather_main, 'Unknown') AS weather_main, weather_description, weather_icon,
           ifnull(raw_json, 'Unknown') AS raw_json, load_timestamp, data_source
    FROM (SELECT *, cast(timestamp_str AS timestamp) AS t, ifnull(weather_main, '') AS w
          FROM weather_realtime_raw)""", ("weather_realtime_raw",))
def weather_etl_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(weather_features.current_features(current(spark, sf)), 6, "temperature_c", "feels_like_c",
                   "heat_index_f", "wind_chill_f", "precipitation_mm", "rain_mm", "snowfall_mm")


@query("flow_staging", "SELECT * FROM stg_flow", ("stg_flow",))
def flow_staging(spark: SparkSession, sf: str) -> DataFrame:
    return staged_flow(spark, sf)


# --- traffic -----------------------------------------------------------------------------------------------------


@query("city_traffic_summary", """
    SELECT city, state, count(*) AS total_segments, avg(current_speed_mph) AS avg_current_speed,
           avg(free_flow_speed_mph) AS avg_free_flow_speed, avg(speed_reduction_pct) AS avg_speed_reduction_pct,
           avg(congestion_score) AS avg_congestion_score, avg(delay_sec) AS avg_delay_seconds,
           count(*) FILTER (road_closure) AS closed_roads_count, max(timestamp) AS last_updated
    FROM scored_flow GROUP BY city, state""", ("scored_flow",))
def city_traffic_summary(spark: SparkSession, sf: str) -> DataFrame:
    return traffic_mart.city_summary(traffic_mart.scored_flow(staged_flow(spark, sf)))


@query("traffic_mart", "SELECT * FROM traffic_mart", ("traffic_mart",))
def traffic_mart_query(spark: SparkSession, sf: str) -> DataFrame:
    return traffic_mart.traffic_mart(staged_flow(spark, sf))


@query("traffic_mart_ordered", "SELECT * FROM traffic_mart ORDER BY congestion_score DESC, city, road_name, flow_id",
       ("traffic_mart",))
def traffic_mart_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return traffic_mart.ordered_mart(traffic_mart.traffic_mart(staged_flow(spark, sf)))


@query("segment_speed", """
    SELECT city, road_name, count(*) AS readings, avg(current_speed_mph) AS avg_speed_mph
    FROM stg_flow GROUP BY city, road_name""", ("stg_flow",))
def segment_speed(spark: SparkSession, sf: str) -> DataFrame:
    return traffic_mart.segment_speed(staged_flow(spark, sf))


# --- accidents and weather ------------------------------------------------------------------------------------------


_STAMPED = f"""SELECT *, {NOW} AS dbt_updated_at, strftime({NOW}, '%Y-%m-%d %H:%M:%S') AS dbt_run_timestamp
    FROM correlation"""


@query("accident_weather_join", _STAMPED, ("correlation",))
def accident_weather_join(spark: SparkSession, sf: str) -> DataFrame:
    return correlated(spark, sf)


@query("accident_weather_spread", _STAMPED, ("correlation",))
def accident_weather_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The same join with every key spread over four tasks, whatever its rows."""
    return correlation.accident_weather(staged_accidents(spark, sf), staged_hourly(spark, sf), AS_OF, salts=4)


@query("safety_city_severity", "SELECT * FROM safety_city", ("safety_city",))
def safety_city_severity(spark: SparkSession, sf: str) -> DataFrame:
    return safety_mart.city_severity(correlated(spark, sf))


@query("safety_condition", "SELECT * FROM safety_conditions", ("safety_conditions",))
def safety_condition(spark: SparkSession, sf: str) -> DataFrame:
    return safety_mart.weather_conditions(correlated(spark, sf))


@query("safety_time_pattern", "SELECT * FROM safety_times", ("safety_times",))
def safety_time_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return safety_mart.time_patterns(correlated(spark, sf))


@query("safety_hotspots", "SELECT * FROM safety_spots", ("safety_spots",))
def safety_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    return safety_mart.hot_spots(correlated(spark, sf))


@query("safety_mart", f"SELECT *, {NOW} AS dashboard_updated_at FROM (" + """
    SELECT 'city_severity' AS metric_type, city, county, state, severity_label AS category, accident_count,
           avg_risk_score, weather_related_count, infrastructure_related_count, cast(NULL AS varchar) AS detail
    FROM safety_city
    UNION ALL SELECT 'weather_condition', NULL, NULL, NULL, weather_main, accident_count, avg_risk_score,
                     accident_count, 0, weather_description FROM safety_conditions
    UNION ALL SELECT 'time_pattern', NULL, NULL, NULL,
                     day_name || CASE WHEN accident_hour < 10 THEN ' 0' ELSE ' ' END || accident_hour || ':00',
                     accident_count, avg_risk_score, weather_related_count, 0, sunrise_sunset FROM safety_times
    UNION ALL SELECT 'high_risk_location', city, county, state, street, accident_count, avg_risk_score,
                     weather_related_accidents, junction_accidents + traffic_signal_accidents, max_risk_category
              FROM safety_spots)""", ("safety_city", "safety_conditions", "safety_times", "safety_spots"))
def safety_mart_query(spark: SparkSession, sf: str) -> DataFrame:
    mart = safety_mart.safety_mart(correlated(spark, sf), AS_OF)
    return safety_mart.ordered_mart(mart)


@query("heat_map", """
    SELECT cast(floor(temperature_f / 10) * 10 AS int) AS temperature_from,
           cast(floor(wind_speed_mph / 5) * 5 AS int) AS wind_from, count(*) AS accident_count,
           avg(severity) AS avg_severity, count(*) FILTER (severity > 2) AS severe_accident_count
    FROM correlation GROUP BY 1, 2""", ("correlation",))
def heat_map(spark: SparkSession, sf: str) -> DataFrame:
    return trends.heat_map(correlated(spark, sf))


def _diff(name: str, average: str) -> str:
    return rnd(f"{name} - {average}", 1)


_FACT = f"""
    SELECT *, {_diff("temperature_f", "region_avg_temp")} AS temp_diff_from_region_avg,
           {_diff("temperature_f", "state_avg_temp")} AS temp_diff_from_state_avg,
           {_diff("humidity_pct", "region_avg_humidity")} AS humidity_diff_from_region_avg,
           {_diff("wind_speed_mph", "region_avg_wind_speed")} AS wind_diff_from_region_avg
    FROM (SELECT *, avg(temperature_f) OVER r AS region_avg_temp, max(temperature_f) OVER r AS region_max_temp,
                 min(temperature_f) OVER r AS region_min_temp, avg(humidity_pct) OVER r AS region_avg_humidity,
                 max(humidity_pct) OVER r AS region_max_humidity, min(humidity_pct) OVER r AS region_min_humidity,
                 avg(wind_speed_mph) OVER r AS region_avg_wind_speed,
                 max(wind_speed_mph) OVER r AS region_max_wind_speed,
                 avg(temperature_f) OVER () AS state_avg_temp, max(temperature_f) OVER () AS state_max_temp,
                 min(temperature_f) OVER () AS state_min_temp, avg(humidity_pct) OVER () AS state_avg_humidity,
                 {", ".join(f"row_number() OVER ({part} ORDER BY {column} DESC NULLS FIRST, record_id) "
                            f"AS {scope}_{short}_rank"
                            for scope, part in (("region", "PARTITION BY region"), ("state", ""))
                            for short, column in weather_fact.RANKED.items())}
          FROM current_metrics WINDOW r AS (PARTITION BY region))"""


@query("weather_fact", f"SELECT *, {NOW} AS mart_created_at FROM ({_FACT})", ("current_metrics",))
def weather_fact_query(spark: SparkSession, sf: str) -> DataFrame:
    return weather_fact.weather_fact(staging.stage_weather_current(current(spark, sf)), AS_OF)


# --- forecast ----------------------------------------------------------------------------------------------------------


@query("daily_accidents", "SELECT * FROM daily_accidents", ("daily_accidents",))
def daily_accidents(spark: SparkSession, sf: str) -> DataFrame:
    return features.daily_accidents(cleaned_accidents(spark, sf), AS_OF)


@query("daily_accidents_all", """
    SELECT cast(start_time AS date) AS date, city, count(*) AS accident_count, sum(severity) / count(*) AS avg_severity,
           count(*) FILTER (severity IN (3, 4)) AS severe_accident_count
    FROM accidents_clean WHERE start_time IS NOT NULL AND city IS NOT NULL GROUP BY ALL""", ("accidents_clean",))
def daily_accidents_all(spark: SparkSession, sf: str) -> DataFrame:
    """The whole history."""
    return features.daily_accidents(cleaned_accidents(spark, sf), AS_OF, days=None)


@query("daily_weather", "SELECT * FROM daily_weather", ("daily_weather",))
def daily_weather(spark: SparkSession, sf: str) -> DataFrame:
    return features.daily_weather(hourly(spark, sf), AS_OF)


@query("training_table", "SELECT * FROM training", ("training",))
def training_table(spark: SparkSession, sf: str) -> DataFrame:
    return training(spark, sf)


@query("training_view", "SELECT * FROM training_view ORDER BY city, date", ("training_view",))
def training_view(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_view(training(spark, sf), AS_OF).orderBy("city", "date")


_DENSE = """
    , days AS (SELECT city, cast(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date) AS date
               FROM daily_accidents GROUP BY city),
    dense AS (SELECT date, city, ifnull(accident_count, 0) AS accident_count, avg_severity,
                     ifnull(severe_accident_count, 0) AS severe_accident_count
              FROM days LEFT JOIN daily_accidents USING (city, date))"""


@query("daily_zero_filled", f"{_DENSE} SELECT * FROM dense", ("daily_accidents",))
def daily_zero_filled(spark: SparkSession, sf: str) -> DataFrame:
    """A row for every day of a city's history."""
    return features.zero_filled(features.daily_accidents(cleaned_accidents(spark, sf), AS_OF))


@query("training_zero_filled", f"""{_DENSE}
    SELECT date, city, accident_count, severe_accident_count, cast(dayofweek(date) AS int) AS day_of_week,
           ifnull(avg_temp_f, {fixed.DAILY_WEATHER_DEFAULTS["avg_temp_f"]}e0) AS avg_temp_f,
           {oracle.one("total_precipitation_mm > 10")} AS heavy_precipitation
    FROM dense LEFT JOIN daily_weather USING (date, city)""", ("daily_accidents", "daily_weather"))
def training_zero_filled(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.training_table(cleaned_accidents(spark, sf), hourly(spark, sf), AS_OF, zero_fill=True)
    return rows.select("date", "city", "accident_count", "severe_accident_count", "day_of_week", "avg_temp_f",
                       "heavy_precipitation")


@query("rolling_7d_zero_filled", f"""{_DENSE}
    SELECT d.city, d.date, d.accident_count, sum(e.accident_count) / count(*) AS rolling_7d_accidents,
           count(*) AS days_in_window
    FROM dense d JOIN dense e ON e.city = d.city AND e.date BETWEEN d.date - 6 AND d.date
    GROUP BY d.city, d.date, d.accident_count""", ("daily_accidents",))
def rolling_7d_zero_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Means over seven calendar days with the days without accidents in them."""
    return trends.rolling_week(features.zero_filled(features.daily_accidents(cleaned_accidents(spark, sf), AS_OF)))


@query("latest_weather_6h", "SELECT * FROM weather_6h", ("weather_6h",))
def latest_weather_6h(spark: SparkSession, sf: str) -> DataFrame:
    return features.latest_weather_for_features(current(spark, sf), AS_OF)


@query("latest_weather_24h", "SELECT * FROM weather_24h", ("weather_24h",))
def latest_weather_24h(spark: SparkSession, sf: str) -> DataFrame:
    return features.latest_weather_for_adjustment(current(spark, sf), AS_OF)


@query("latest_traffic_24h", "SELECT * FROM traffic_24h", ("traffic_24h",))
def latest_traffic_24h(spark: SparkSession, sf: str) -> DataFrame:
    return features.latest_traffic(flow(spark, sf), AS_OF)


@query("future_features", "SELECT * FROM future ORDER BY city, date", ("future",))
def future_features(spark: SparkSession, sf: str) -> DataFrame:
    return coming(spark, sf, training(spark, sf)).orderBy("city", "date")


_BOUNDS = ("forecast", "lower_bound", "upper_bound")


@query("forecast_ols", f"SELECT series, ts, {', '.join(f'{rnd(n, 6)} AS {n}' for n in _BOUNDS)} FROM forecast",
       ("forecast",))
def forecast_ols(spark: SparkSession, sf: str) -> DataFrame:
    trained = shared.written(training(spark, sf), "training")
    return rounded(trend_forecast(spark, sf, trained), 6, *_BOUNDS)


@query("forecast_skipped", """
    SELECT city, count(*) AS n,
           CASE WHEN count(*) < 14 THEN 'fewer than 14 days' ELSE 'a single day' END AS reason
    FROM training_view GROUP BY city HAVING count(*) < 14 OR count(DISTINCT date) < 2""", ("training_view",))
def forecast_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """The cities without a trend, and why."""
    return forecast.skipped_series(features.training_view(training(spark, sf), AS_OF))


_T = "(1.96e0 + 2.372384e0 / df + {b} / (df * df) + {c} / (df * df * df))".format(
    b=(5 * 1.96**5 + 16 * 1.96**3 + 3 * 1.96) / 96, c=(3 * 1.96**7 + 19 * 1.96**5 + 17 * 1.96**3 - 15 * 1.96) / 384)
# Models by city and origin o, from groups g of a weekday's days up to the origin; the mean of a weekday, or else of all days.
_JOINT = f"""
    m AS (SELECT city, o, sum(n) AS n, sum(n) - count(*) - 1 AS df, sum(sxx) AS wxx, sum(sxy) / sum(sxx) AS slope,
                 sqrt(greatest(sum(syy) - sum(sxy) * sum(sxy) / sum(sxx), 0e0) / (sum(n) - count(*) - 1)) AS sigma,
                 sum(n * mx) / sum(n) AS ax, sum(n * my) / sum(n) AS ay
          FROM g GROUP BY city, o HAVING sum(n) >= 14 AND sum(sxx) > 1),
    said AS (SELECT t.*, ifnull(my, ay) + slope * (t.x - ifnull(mx, ax)) AS forecast,
                    {_T} * sigma * sqrt(1 + 1e0 / ifnull(g.n, m.n) + (t.x - ifnull(mx, ax)) * (t.x - ifnull(mx, ax)) / wxx) AS margin
             FROM asked t JOIN m USING (city, o) LEFT JOIN g ON g.city = t.city AND g.o = t.o AND g.dow = t.dow)"""
_GROUP = """count(*) AS n, avg(p.x) AS mx, avg(p.y) AS my, regr_sxx(p.y, p.x) AS sxx, regr_sxy(p.y, p.x) AS sxy,
               regr_syy(p.y, p.x) AS syy"""


@query("forecast_joint", f"""
    , g AS (SELECT city, 0 AS o, dow, {_GROUP} FROM points p GROUP BY city, dow),
    asked AS (SELECT city, 0 AS o, date, date_diff('day', {TODAY}, date) AS x, dayofweek(date) AS dow FROM future), {_JOINT}
    SELECT city AS series, cast(date AS timestamp) AS ts, {rnd("forecast", 6)} AS forecast,
           {rnd("forecast - margin", 6)} AS lower_bound, {rnd("forecast + margin", 6)} AS upper_bound FROM said""",
       ("points", "future"))
def forecast_joint_query(spark: SparkSession, sf: str) -> DataFrame:
    """Trend and weekdays fitted together, with bounds from spread, degrees of freedom and leverage."""
    trained = shared.written(training(spark, sf), "training")
    model = joint_forecast.fit_joint(features.training_view(trained, AS_OF), AS_OF)
    return rounded(joint_forecast.forecast_joint(model, coming(spark, sf, trained), AS_OF), 6, *_BOUNDS)


_ROLLED = f"""{_DENSE},
    points AS (SELECT city, date_diff('day', {TODAY}, date) AS x, accident_count AS y, dayofweek(date) AS dow FROM dense),
    g AS (SELECT p.city, a.x AS o, p.dow, {_GROUP} FROM points a JOIN points p ON p.city = a.city AND p.x <= a.x
          GROUP BY p.city, a.x, p.dow),
    asked AS (SELECT a.city, a.x - h AS o, h, a.x, a.dow, a.y FROM points a, (SELECT unnest(range(1, 8)) AS h)), {_JOINT}"""


@query("forecast_rolling", f"""{_ROLLED}
    SELECT city, {TODAY} + cast(o AS int) AS origin, cast(h AS int) AS horizon, {TODAY} + cast(x AS int) AS date, y AS actual,
           {rnd("forecast + 1e-9", 3)} AS forecast, {rnd("forecast - margin + 1e-9", 3)} AS lower_bound,
           {rnd("forecast + margin + 1e-9", 3)} AS upper_bound, y BETWEEN forecast - margin - 1e-9 AND forecast + margin + 1e-9 AS covered
    FROM said""", ("daily_accidents",))
def forecast_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """The forecasts of every past day next to what came."""
    view = features.zero_filled(features.daily_accidents(cleaned_accidents(spark, sf), AS_OF))
    rows = joint_forecast.rolling_origins(view, AS_OF)
    # Many means are halves of the last digit; off them both engines round alike.
    return rounded(rows.withColumns({name: F.col(name) + 1e-9 for name in _BOUNDS}), 3, *_BOUNDS)


@query("forecast_coverage", f"""{_ROLLED}
    SELECT cast(h AS int) AS horizon, count(*) AS forecasts,
           {rnd("avg(cast(y BETWEEN forecast - margin - 1e-9 AND forecast + margin + 1e-9 AS int))", 6)} AS covered_share,
           {rnd("avg(abs(y - forecast))", 6)} AS mean_abs_error, {rnd("avg(2 * margin)", 6)} AS mean_width
    FROM said GROUP BY h""", ("daily_accidents",))
def forecast_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """How often the bounds held on days the models had not seen."""
    view = features.zero_filled(features.daily_accidents(cleaned_accidents(spark, sf), AS_OF))
    return rounded(joint_forecast.coverage(joint_forecast.rolling_origins(view, AS_OF)), 6, "covered_share",
                   "mean_abs_error", "mean_width")


@query("forecast_city_ridge", "SELECT city, count(*) AS n, true AS solved FROM training_view GROUP BY city",
       ("training_view",))
def forecast_city_ridge(spark: SparkSession, sf: str) -> DataFrame:
    """Each city's regression, with its residuals times each feature against what the penalty makes of them."""
    view = shared.written(features.training_view(training(spark, sf), AS_OF), "training")
    gaps = forecast.ridge_residuals(view, forecast.fit_city_ridge(view))
    return gaps.select("city", "n", (F.col("gap") < 1e-6).alias("solved"))


@query("forecast_ml")
def forecast_ml(spark: SparkSession, sf: str) -> DataFrame:
    """Iterative fit: no SQL form.  ``tests/test_forecast.py`` bounds its distance from ``forecast_ols``."""
    trained = shared.written(training(spark, sf), "training")
    model, spread = forecast.fit_features(features.training_view(trained, AS_OF))
    return forecast.forecast_features(model, spread, coming(spark, sf, trained))


@query("forecast_adjusted", "SELECT * REPLACE (" + rnd("risk_multiplier", 6) + " AS risk_multiplier) FROM final",
       ("final",))
def forecast_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(final(spark, sf), 6, "risk_multiplier").orderBy("city", "date")


@query("forecast_report", f"""
    SELECT data_type, count(*) AS records, count(DISTINCT city) AS cities, min(date) AS start_date,
           max(date) AS end_date, {rnd("avg(risk_multiplier)", 6)} AS avg_risk_multiplier
    FROM final GROUP BY data_type""", ("final",))
def forecast_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forecast.forecast_report(final(spark, sf)), 6, "avg_risk_multiplier")


@query("forecast_top", f"""
    SELECT city, date, forecasted_accident_count, current_temp_f, current_congestion_pct,
           {rnd("risk_multiplier", 6)} AS risk_multiplier
    FROM final WHERE data_type = 'FORECAST'
    ORDER BY forecasted_accident_count DESC NULLS FIRST, city, date LIMIT 10""", ("final",))
def forecast_top(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forecast.top_forecasts(final(spark, sf)), 6, "risk_multiplier")


@query("risk_assessment", f"""
    SELECT city, date, f AS forecasted_accident_count, lower_bound, upper_bound, current_temp_f,
           current_congestion_pct, {rnd("risk_multiplier", 6)} AS risk_multiplier,
           {oracle.reached("f", fixed.FORECAST_RISK)} AS risk_level,
           CASE WHEN {oracle.yes("current_temp_f < 32")} THEN 'FREEZING'
                WHEN {oracle.yes("current_temp_f > 95")} THEN 'EXTREME_HEAT' ELSE 'NORMAL' END AS temperature_risk,
           ([ 'NORMAL_FLOW', 'MODERATE_CONGESTION', 'SEVERE_CONGESTION'])[ifnull(1
               + cast(current_congestion_pct > 20 AS int) + cast(current_congestion_pct > 40 AS int), 1)]
               AS traffic_risk,
           left(dayname(date), 3) AS day_of_week, isodow(date) > 5 AS is_weekend,
           CASE WHEN f IS NOT NULL
                THEN least(100e0, {rnd("f / 50e0 * 50 + ifnull(risk_multiplier - 1, 0) * 50", 0)}) END
               AS combined_risk_score
    FROM (SELECT *, forecasted_accident_count AS f FROM final WHERE data_type = 'FORECAST')
    ORDER BY f DESC""", ("final",))
def risk_assessment(spark: SparkSession, sf: str) -> DataFrame:
    rows = forecast.ordered_assessment(forecast.risk_assessment(final(spark, sf)))
    return rounded(rows, 6, "risk_multiplier")


# --- trends ------------------------------------------------------------------------------------------------------------------


@query("rolling_7d", """
    SELECT d.city, d.date, d.accident_count, avg(e.accident_count) AS rolling_7d_accidents, count(*) AS days_in_window
    FROM daily_accidents d JOIN daily_accidents e
         ON e.city = d.city AND e.date BETWEEN d.date - 6 AND d.date
    GROUP BY d.city, d.date, d.accident_count""", ("daily_accidents",))
def rolling_7d(spark: SparkSession, sf: str) -> DataFrame:
    return trends.rolling_week(features.daily_accidents(cleaned_accidents(spark, sf), AS_OF))


@query("weather_corr", f"""
    SELECT measure, city_days, {rnd("r", 6)} AS correlation
    FROM (SELECT measure, count(*) AS city_days,
                 covar_pop(accident_count, value)
                     / nullif(stddev_pop(accident_count) * stddev_pop(value), 0) AS r
          FROM (UNPIVOT training ON avg_temp_f, avg_humidity_pct, avg_wind_speed_mph, total_precipitation_mm
                INTO NAME measure VALUE value) GROUP BY measure)""", ("training",))
def weather_corr(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(trends.weather_correlation(training(spark, sf)), 6, "correlation")


def _held(variable: int) -> str:
    """One step of the recursion for partial correlations: variable ``variable`` is held in the matrix of every other measure."""
    return f"""h{variable} AS (
        SELECT a.m, a.i, a.j, CASE WHEN a.m = {variable} OR b.v IS NULL OR c.v IS NULL THEN a.v
                                   ELSE (a.v - b.v * c.v) / sqrt((1 - b.v * b.v) * (1 - c.v * c.v)) END AS v
        FROM h{variable - 1} a JOIN h{variable - 1} b ON b.m = a.m AND b.i = least(a.i, {variable}) AND b.j = greatest(a.i, {variable})
             JOIN h{variable - 1} c ON c.m = a.m AND c.i = least(a.j, {variable}) AND c.j = greatest(a.j, {variable})
        WHERE a.m = {variable} OR (a.i <> {variable} AND a.j <> {variable}))"""


_VARIABLES = ("accident_count", *trends.MEASURES)


@query("weather_partial_corr", f"""
    , h0 AS (SELECT m, i, j, v FROM (SELECT unnest(range(1, 5)) AS m), ({" UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END AS v FROM training"
        for i, a in enumerate(_VARIABLES) for j, b in enumerate(_VARIABLES) if i <= j)})),
    {", ".join(_held(k) for k in range(1, 5))}
    SELECT ([{", ".join(f"'{name}'" for name in trends.MEASURES)}])[m] AS measure,
           (SELECT count(*) FROM training) AS city_days, {rnd("v", 6)} AS partial_correlation FROM h4 WHERE i = 0 AND j = m""",
       ("training",))
def weather_partial_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Daily accidents against each weather measure with the other measures held."""
    return rounded(trends.partial_correlations(training(spark, sf)), 6, "partial_correlation")


@query("seasonal_peaks", """
    SELECT *, accident_count = max(accident_count) OVER (PARTITION BY city) AS is_peak_month
    FROM (SELECT city, cast(quarter(date) AS int) AS quarter, cast(month(date) AS int) AS month,
                 cast(sum(accident_count) AS bigint) AS accident_count, max(accident_count) AS busiest_day_count
          FROM daily_accidents GROUP BY ALL)""", ("daily_accidents",))
def seasonal_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return trends.seasonal_peaks(features.daily_accidents(cleaned_accidents(spark, sf), AS_OF))


# --- sinks and statistics -------------------------------------------------------------------------------------------------------


@query("load_stats", """
    SELECT count(*) AS row_count, min(start_time) AS earliest, max(start_time) AS latest,
           count(DISTINCT city) AS distinct_city, count(DISTINCT county) AS distinct_county,
           count(DISTINCT state) AS distinct_state, avg(temperature_f) AS avg_temperature_f,
           max(temperature_f) AS max_temperature_f, min(temperature_f) AS min_temperature_f
    FROM accidents_clean""", ("accidents_clean",))
def load_stats(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.load_stats(cleaned_accidents(spark, sf), "start_time", ("city", "county", "state"), ("temperature_f",))


@query("training_stats", f"""
    SELECT count(DISTINCT date) AS days, count(DISTINCT city) AS cities, min(date) AS start_date,
           max(date) AS end_date, cast(sum(accident_count) AS bigint) AS total_accidents,
           {rnd("avg(avg_temp_f)", 6)} AS avg_temperature, sum(total_precipitation_mm) AS total_precipitation
    FROM training""", ("training",))
def training_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sinks.training_stats(training(spark, sf)), 6, "avg_temperature")


@query("count_guard", "SELECT count(*) > 0 AS has_rows FROM training", ("training",))
def count_guard(spark: SparkSession, sf: str) -> DataFrame:
    return quality.has_rows(features.require_rows(training(spark, sf), "training data"))


@query("sink_roundtrip", """
    SELECT unnest(['replaced', 'replaced again', 'refreshed', 'skipped same day', 'refreshed next day', 'appended',
                   'appended new only', 'view']) AS step,
           unnest([n, n, n, n, n, 2 * n, 2 * n, n]) AS records,
           unnest([true, true, true, false, true, true, true, true]) AS wrote
    FROM (SELECT count(*) AS n FROM stg_accidents)""", ("stg_accidents",))
def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every way to write a table, with the record count that is read back."""
    rows = shared.written(staged_accidents(spark, sf).drop("load_timestamp"), "accidents")
    root = shared.scratch_path(spark, "layers")
    out = None

    def note(step: str, stored: DataFrame, wrote: bool = True) -> None:
        nonlocal out
        line = stored.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(step).alias("step"), "records", F.lit(wrote).alias("wrote"))
        line = shared.written(line, "step")
        out = line if out is None else out.unionByName(line)

    def stored(layer: str, name: str) -> DataFrame:
        return tables.read_table(spark, root, layer, name)

    snapshot = tables.table_path(root, "staging", "accidents")
    sinks.replace(rows, snapshot, ["severity"])
    note("replaced", stored("staging", "accidents"))
    sinks.replace(rows, snapshot, ["severity"])
    note("replaced again", stored("staging", "accidents"))
    full = tables.table_path(root, "raw_archive", "accidents")
    for step, day in (("refreshed", AS_OF), ("skipped same day", AS_OF), ("refreshed next day", "2024-02-02")):
        wrote = sinks.refresh_once_a_day(rows, full, day)
        note(step, stored("raw_archive", "accidents"), wrote)
    log = tables.table_path(root, "raw", "accidents")
    sinks.append(rows, log)
    sinks.append(rows, log)
    note("appended", stored("raw", "accidents"))
    sinks.append(rows, log, new_by=["accident_id"])
    note("appended new only", stored("raw", "accidents"))
    note("view", sinks.publish_view(stored("staging", "accidents"), "staged_accidents"))
    return out


@query("sink_versions", """
    SELECT version, city, severity, count(*) AS accidents
    FROM (SELECT unnest([1, 2]) AS version, * FROM stg_accidents) WHERE version = 1 OR severity >= 3 GROUP BY ALL""",
       ("stg_accidents",))
def sink_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced twice, read at both versions; a writer that began at the first one loses against the second."""
    rows = shared.written(staged_accidents(spark, sf).select("city", "severity"), "accidents")
    path = shared.scratch_path(spark, "versions")
    first = sinks.replace(rows, path)
    second = sinks.replace(rows.where("severity >= 3"), path, based_on=first)
    try:
        sinks.replace(rows.where("false"), path, based_on=first)
    except sinks.TableChanged:
        pass
    return sinks.read(spark, path, version=first).withColumn("version", F.lit(first)).unionByName(
        sinks.read(spark, path).withColumn("version", F.lit(second))).groupBy("version", "city", "severity").agg(
        F.count(F.lit(1)).alias("accidents"))


@query("append_first_of_key", """
    SELECT user_id, ts, event_id, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2, ts, event_id) AS n FROM events) WHERE n = 1""")
def append_first_of_key(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads that hold many rows of a key: the first one of the key in the first load with it stays, whole."""
    path = shared.scratch_path(spark, "append")
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "props")
    for load in (rows.where("event_id % 2 = 0"), rows):
        sinks.append(load, path, new_by=["user_id"], order=["ts", "event_id"])
    return sinks.read(spark, path)


@query("catalog_table", "SELECT city, count(*) AS accidents FROM stg_accidents GROUP BY city", ("stg_accidents",))
def catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """A derived table of the session catalog, replaced when it is saved again; dropped once it has been read."""
    rows = staged_accidents(spark, sf).groupBy("city").agg(F.count(F.lit(1)).alias("accidents"))
    name = f"accidents_per_city_{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.save_table(rows, name)
    out = shared.written(spark.table(name), "catalog")
    spark.sql(f"DROP TABLE {name}")
    return out


# --- quality ------------------------------------------------------------------------------------------------------------------------


@query("dq_unique", """
    SELECT flow_id, count(*) AS n_records FROM stg_flow GROUP BY flow_id HAVING count(*) > 1""", ("stg_flow",))
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(staged_flow(spark, sf), "flow_id")


_NULLABLE = ("humidity_pct", "wind_speed_mph", "feels_like_f", "city", "region", "record_id")


@query("dq_not_null", " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) - count({n}) AS failures FROM stg_current" for n in _NULLABLE),
    ("stg_current",))
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(staging.stage_weather_current(current(spark, sf)), list(_NULLABLE))


@query("dq_accepted", """
    SELECT congestion_level AS value, count(*) AS n_records FROM stg_flow
    WHERE congestion_level = 'Unknown' GROUP BY 1""", ("stg_flow",))
def dq_accepted(spark: SparkSession, sf: str) -> DataFrame:
    check = quality.checks_of("stg_traffic_flow_realtime", "accepted_values")[0]
    return quality.unexpected_values(staged_flow(spark, sf), check.column, check.accepted)


_MODELS = {"stg_traffic_accidents": "stg_accidents", "stg_weather_historical": "stg_weather",
           "stg_traffic_flow_realtime": "stg_flow", "accident_weather_correlation": "correlation",
           "fct_weather_current": "current_metrics"}


def _check_sql(check: quality.Check) -> str:
    source, name = _MODELS[check.model], check.column
    counts = {
        "unique": f"(SELECT count(*) FROM (SELECT {name} FROM {source} WHERE {name} IS NOT NULL "
                  f"GROUP BY {name} HAVING count(*) > 1))",
        "not_null": f"(SELECT count(*) - count({name}) FROM {source})",
        "accepted_values": f"(SELECT count(*) FROM {source} WHERE {name}::varchar NOT IN "
                           f"({', '.join(repr(v) for v in check.accepted)}))",
    }
    return (f"SELECT '{check.model}' AS model, '{name}' AS column_name, '{check.kind}' AS \"check\", "
            f"{counts[check.kind]} AS failures")


@query("dq_report", " UNION ALL ".join(_check_sql(c) for c in quality.CHECKS), tuple(_MODELS.values()))
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """All 22 declared column checks."""
    models = {"stg_traffic_accidents": staged_accidents(spark, sf), "stg_weather_historical": staged_hourly(spark, sf),
              "stg_traffic_flow_realtime": staged_flow(spark, sf), "accident_weather_correlation": shared.written(
                  correlated(spark, sf).select("accident_id", "risk_category"), "correlation"),
              "fct_weather_current": weather_fact.weather_metrics(staging.stage_weather_current(current(spark, sf)))}
    reports = [quality.run_checks(rows, model) for model, rows in models.items()]
    first, *others = reports
    for other in others:
        first = first.unionByName(other)
    return first


@query("dq_dates", f"""
    SELECT accident_id, accident_date, city, severity,
           CASE WHEN accident_date > {TODAY} THEN 'Future date' ELSE 'Too old (>10 years)' END AS failure_reason
    FROM stg_accidents WHERE accident_date NOT BETWEEN {TODAY} - INTERVAL 10 YEAR AND {TODAY}""", ("stg_accidents",))
def dq_dates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.date_outliers(staged_accidents(spark, sf), AS_OF)


@query("dq_thresholds", """
    SELECT *, duplicate_rate <= 0.01 AS duplicates_ok, n_records >= 1000 AS volume_ok
    FROM (SELECT count(*) AS n_records, count(DISTINCT flow_id) AS n_keys,
                 1 - count(DISTINCT flow_id) / count(*) AS duplicate_rate FROM stg_flow)""", ("stg_flow",))
def dq_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return quality.volume_check(staged_flow(spark, sf), "flow_id")


_LOADED = (("traffic_flow_raw", flow), ("weather_historical_raw", hourly), ("weather_realtime_raw", current))


@query("dq_freshness", " UNION ALL ".join(f"""
    SELECT '{name}' AS source, max(load_timestamp) AS newest,
           CASE WHEN max(load_timestamp) >= {NOW} - to_hours(2) THEN 'pass'
                WHEN max(load_timestamp) >= {NOW} - to_hours(6) THEN 'warn' ELSE 'error' END AS status
    FROM {name}""" for name, _ in _LOADED), tuple(name for name, _ in _LOADED))
def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    parts = [quality.freshness(build(spark, sf), as_of=AS_OF).select(F.lit(name).alias("source"), "newest", "status")
             for name, build in _LOADED]
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


# --- streams ---------------------------------------------------------------------------------------------------------------------------


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    return landing.table_stream(spark, f"{sf}/events.parquet").select(
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("city"), "event_id", "ts", "props",
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("level"))


def _finish(query_handle) -> None:
    query_handle.awaitTermination()


ROWS_A_FILE = 1_000_000


@query("stream_snapshot", "SELECT * FROM traffic_mart", ("traffic_mart",))
def stream_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of the newest poll, which comes in several files and micro-batches after an older one."""
    root = shared.scratch_path(spark, "snapshot")
    lines = table(spark, sf, "lineitem")
    older = lines.where(F.col("l_linenumber") == 1).withColumn("poll", F.lit(1))
    # Four files, and more of them as the table grows, so that the share of a task does not; about four micro-batches either way.
    landed = max(4, lines.count() // ROWS_A_FILE)
    lines.withColumn("poll", F.lit(2)).unionByName(older).repartition(
        landed, "l_orderkey", "l_linenumber", "l_partkey").write.parquet(f"{root}/landed")

    def stage(poll: DataFrame) -> DataFrame:
        return staging.stage_flow(raw(poll.sparkSession, sf, "traffic_flow_raw", lineitem=poll.drop("poll")))

    landing.catch_up_snapshot(
        landing.table_stream(spark, f"{root}/landed", max_files=-(-landed // 4)),
        [(stage, f"{root}/staging"), (traffic_mart.traffic_mart, f"{root}/mart")], f"{root}/progress",
        f"{root}/polls", poll="poll")
    return sinks.read(spark, f"{root}/mart")


@query("stream_trailing", """
    SELECT pane_end + to_minutes(30 * i) - to_hours(24) AS window_start, pane_end + to_minutes(30 * i) AS window_end,
           city, cast(sum(n) AS bigint) AS readings, cast(sum(k) AS double) / sum(n) AS avg_level
    FROM (SELECT *, unnest(range(48)) AS i
          FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) + to_minutes(30) AS pane_end,
                       'NATION_' || (user_id % 25) AS city, count(*) AS n,
                       sum(cast(regexp_extract(props, '([0-9]+)', 1) AS int)) AS k
                FROM events GROUP BY ALL))
    GROUP BY ALL""")
def stream_trailing(spark: SparkSession, sf: str) -> DataFrame:
    """All windows up to the present, those that are still open included."""
    root = shared.scratch_path(spark, "trailing")
    _finish(panes.refresh_panes(_events_stream(spark, sf), "ts", "city", ["level"], f"{root}/panes",
                                f"{root}/progress"))
    return panes.trailing_now(spark, f"{root}/panes", "city", ["level"])


def _events_in_parts(spark: SparkSession, sf: str, root: str, parts: int) -> DataFrame:
    """A stream of the events in ``parts`` files, one micro-batch each: every file spans the whole time, so later ones hold late rows."""
    rows = table(spark, sf, "events").select(
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("city"), "event_id", "ts",
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("level"))
    for part in range(parts):
        share = F.col("event_id") % parts == part
        rows.where(share).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return landing.table_stream(spark, f"{root}/in", max_files=1)


# Rows of part i are late if their pane ended an hour before the latest time of the parts before.
_PARTS = """
    parts AS (SELECT *, event_id % 3 AS part, 'NATION_' || (user_id % 25) AS city,
                     cast(cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS double) AS level,
                     time_bucket(INTERVAL 30 MINUTE, ts) + to_minutes(30) AS pane_end FROM events),
    marks AS (SELECT p AS part, (SELECT max(ts) - to_hours(1) FROM parts WHERE part < p) AS watermark
              FROM (SELECT unnest(range(3)) AS p)),
    judged AS (SELECT *, ifnull(pane_end <= watermark, false) AS late FROM parts JOIN marks USING (part))"""


@query("stream_late", f"""
    WITH {_PARTS}
    SELECT city, event_id, ts, level, late, CASE WHEN late THEN 'behind the watermark' END AS reason,
           CASE WHEN late THEN watermark END AS watermark, CASE WHEN late THEN part END AS batch FROM judged""")
def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """All events: those in time, which the pane sums count, and the late ones with reason, watermark and batch."""
    root = shared.scratch_path(spark, "late")
    stream = _events_in_parts(spark, sf, root, 3)
    _finish(panes.refresh_panes(stream, "ts", "city", ["level"], f"{root}/panes", f"{root}/progress"))
    late = panes.late_rows(spark, f"{root}/panes", "city string, event_id long, ts timestamp_ntz, level double")
    rows = spark.read.schema(stream.schema).parquet(f"{root}/in")
    timely = rows.join(late.select("event_id"), "event_id", "left_anti")
    return late.withColumnRenamed("_batch", "batch").withColumn("late", F.lit(True)).unionByName(
        timely.withColumn("late", F.lit(False)), allowMissingColumns=True)


@query("stream_trailing_in_time", f"""
    WITH {_PARTS}
    SELECT pane_end + to_minutes(30 * i) - to_hours(6) AS window_start, pane_end + to_minutes(30 * i) AS window_end,
           city, cast(sum(n) AS bigint) AS readings, sum(k) / sum(n) AS avg_level
    FROM (SELECT *, unnest(range(12)) AS i
          FROM (SELECT pane_end, city, count(*) AS n, sum(level) AS k FROM judged WHERE NOT late GROUP BY ALL))
    GROUP BY ALL""")
def stream_trailing_in_time(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of six hours over the rows of several micro-batches that were in time."""
    root = shared.scratch_path(spark, "trailing")
    stream = _events_in_parts(spark, sf, root, 3)
    _finish(panes.refresh_panes(stream, "ts", "city", ["level"], f"{root}/panes", f"{root}/progress"))
    return panes.trailing_now(spark, f"{root}/panes", "city", ["level"], "6 hours")


@query("stream_first_of_key", """
    SELECT user_id, ts, event_id, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, ts, event_id) AS n FROM events) WHERE n = 1""")
def stream_first_of_key(spark: SparkSession, sf: str) -> DataFrame:
    """The first event of every user over several micro-batches that each span all days: later repeats never get in."""
    root = shared.scratch_path(spark, "first")
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "props")
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = landing.table_stream(spark, f"{root}/in", max_files=1)
    _finish(windows.keep_first(stream, ["user_id"], ["ts", "event_id"], f"{root}/out", f"{root}/progress"))
    return landing.kept_batches(spark, f"{root}/out", stream.schema).drop("_batch")


@query("stream_trailing_closed", """
    SELECT pane_end + to_minutes(30 * i) - to_hours(24) AS window_start, pane_end + to_minutes(30 * i) AS window_end,
           city, cast(sum(n) AS bigint) AS readings, cast(sum(k) AS double) / sum(n) AS avg_level
    FROM (SELECT *, unnest(range(48)) AS i
          FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) + to_minutes(30) AS pane_end,
                       'NATION_' || (user_id % 25) AS city, count(*) AS n,
                       sum(cast(regexp_extract(props, '([0-9]+)', 1) AS int)) AS k
                FROM events GROUP BY ALL))
    WHERE pane_end + to_minutes(30 * i) <= (SELECT date_trunc('milliseconds', max(ts)) - to_hours(1) FROM events)
    GROUP BY ALL""")
def stream_trailing_closed(spark: SparkSession, sf: str) -> DataFrame:
    """All windows that the watermark has closed, appended once each."""
    root = shared.scratch_path(spark, "trailing")
    means = windows.trailing_means(_events_stream(spark, sf), "ts", "city", ["level"])
    _finish(landing.append_stream(means, f"{root}/out", f"{root}/progress"))
    return spark.read.parquet(f"{root}/out")


@query("stream_dedupe", """
    SELECT DISTINCT 'NATION_' || (user_id % 25) || '_' || strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%Y%m%d_%H%M')
           AS flow_id, true AS of_its_slot FROM events""")
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """One reading per city and half hour, and whether the kept row is a reading of that city and half hour."""
    root = shared.scratch_path(spark, "dedupe")
    slot = F.window(F.col("ts").cast("timestamp"), "30 minutes").start
    rows = _events_stream(spark, sf).withColumn(
        "flow_id", F.concat_ws("_", "city", F.date_format(slot, "yyyyMMdd_HHmm")))
    kept = windows.first_of_each(rows.select("flow_id", "ts", "event_id"), ["flow_id"], "ts")
    _finish(landing.append_stream(kept, f"{root}/out", f"{root}/progress"))
    minute = F.floor(F.minute("ts") / 30) * 30
    again = F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string"), F.date_format("ts", "_yyyyMMdd_HH"),
                     F.lpad(minute.cast("string"), 2, "0"))
    source = table(spark, sf, "events").select("event_id", again.alias("again"))
    return spark.read.parquet(f"{root}/out").join(source, "event_id", "left").select(
        "flow_id", F.col("flow_id").eqNullSafe(F.col("again")).alias("of_its_slot"))


@query("stream_landed_json", "SELECT city, fetched_at, payload FROM landed_current", ("landed_current",))
def stream_landed_json(spark: SparkSession, sf: str) -> DataFrame:
    """Answers written as JSON lines in several files, streamed file by file into a table."""
    root = shared.scratch_path(spark, "landed")
    raw(spark, sf, "landed_current").repartition(3).write.json(f"{root}/files")
    _finish(landing.append_stream(landing.landed_stream(spark, f"{root}/files", max_files=1), f"{root}/out",
                                  f"{root}/progress"))
    return spark.read.parquet(f"{root}/out").select("city", "fetched_at", "payload")


@query("stream_quarantine", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                          ELSE cast(json_extract_string(props, '$.k') AS int) END AS k,
           CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) END AS broken
    FROM events""")
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of failed events are cut short; they land in quarantine, all others are parsed."""
    root = shared.scratch_path(spark, "quarantine")
    cut = F.expr("left(props, length(props) - 1)")
    stream = landing.table_stream(spark, f"{sf}/events.parquet").select(
        "event_id", F.when(F.col("event_type") == "error", cut).otherwise(F.col("props")).alias("payload"))
    _finish(landing.split_quarantine(stream, "payload", "k int", f"{root}/out", f"{root}/progress"))
    good = landing.of_status(spark, f"{root}/out", landing.GOOD).select(
        "event_id", F.col("parsed.k").alias("k"), F.lit(None).cast("string").alias("broken"))
    bad = landing.of_status(spark, f"{root}/out", landing.BROKEN).select(
        "event_id", F.lit(None).cast("int").alias("k"), F.col("_corrupt_record").alias("broken"))
    return good.unionByName(bad)
