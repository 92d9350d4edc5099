"""Declared schemas.  Sources never infer types."""

from __future__ import annotations

from .functions import fixed

_FLAGS_TEXT = ", ".join(f"{name} string" for name in fixed.ROAD_FLAGS)
_FLAGS_BOOL = ", ".join(f"{name} boolean" for name in fixed.ROAD_FLAGS)

_ACCIDENT_PLACE = (
    "start_lat double, start_lng double, distance_mi double, description string, street string, city string, "
    "county string, state string, zipcode string, country string, timezone string"
)
_ACCIDENT_WEATHER = (
    "temperature_f double, wind_chill_f double, humidity_pct double, pressure_in double, visibility_mi double, "
    "wind_direction string, wind_speed_mph double, precipitation_in double, weather_condition string"
)
_ACCIDENT_LIGHT = (
    "sunrise_sunset string, civil_twilight string, nautical_twilight string, astronomical_twilight string"
)

ACCIDENTS_RAW = (
    f"accident_id string, severity int, start_time string, end_time string, {_ACCIDENT_PLACE}, "
    f"weather_timestamp string, {_ACCIDENT_WEATHER}, {_FLAGS_TEXT}, {_ACCIDENT_LIGHT}, load_timestamp timestamp_ntz"
)

ACCIDENTS_HISTORICAL = (
    f"accident_id string, severity int, start_time timestamp_ntz, end_time timestamp_ntz, {_ACCIDENT_PLACE}, "
    f"weather_timestamp timestamp_ntz, {_ACCIDENT_WEATHER}, {_FLAGS_BOOL}, {_ACCIDENT_LIGHT}, "
    "load_timestamp timestamp_ntz, data_source string"
)

WEATHER_HISTORICAL_RAW = (
    "record_id string, city string, state string, region string, county string, latitude double, longitude double, "
    "timestamp_utc timestamp_ntz, temperature_f double, relative_humidity_pct double, precipitation_mm double, "
    "rain_mm double, snowfall_mm double, cloud_cover_pct double, pressure_msl_hpa double, wind_speed_mph double, "
    "wind_direction_deg double, wind_gusts_mph double, weather_code int, load_timestamp timestamp_ntz, "
    "data_source string"
)

WEATHER_REALTIME_RAW = (
    "record_id string, city string, state string, region string, county string, latitude double, longitude double, "
    "timestamp_str string, date string, hour int, temperature_f double, feels_like_f double, temp_min_f double, "
    "temp_max_f double, pressure_msl_hpa double, surface_pressure_hpa double, humidity_pct double, "
    "wind_speed_mph double, wind_direction_deg double, wind_gusts_mph double, cloud_cover_pct double, "
    "precipitation_in double, rain_in double, snowfall_in double, weather_code int, weather_main string, "
    "weather_description string, weather_icon string, raw_json string, load_timestamp timestamp_ntz, "
    "data_source string"
)

TRAFFIC_FLOW_RAW = (
    "flow_id string, city string, state string, timestamp string, latitude double, longitude double, "
    "current_speed double, free_flow_speed double, current_travel_time int, free_flow_travel_time int, "
    "confidence double, road_closure boolean, road_name string, raw_json string, load_timestamp timestamp_ntz"
)

TRAFFIC_INCIDENTS_RAW = (
    "incident_id string, city string, state string, timestamp string, latitude double, longitude double, "
    "icon_category string, magnitude_of_delay int, description string, start_time string, end_time string, "
    "raw_json string, load_timestamp timestamp_ntz"
)

CITY_DIM = "name string, latitude double, longitude double, region string, county string"

# One landed service answer per line: the polled city, the poll time and the answer as text.
LANDED = "city string, fetched_at string, payload string"

# Payload shapes.  Fields of more than one JSON type stay text until they are cast.
FLOW_PAYLOAD = (
    "flowSegmentData struct<currentSpeed: double, freeFlowSpeed: double, currentTravelTime: double, "
    "freeFlowTravelTime: double, confidence: double, roadClosure: boolean, frc: string>"
)
INCIDENTS_PAYLOAD = "incidents array<string>"
INCIDENT = (
    "geometry struct<type: string, coordinates: string>, "
    "properties struct<id: string, iconCategory: string, magnitudeOfDelay: int, "
    "events: array<struct<description: string, code: int>>, startTime: string, endTime: string, delay: double>"
)
HOURLY_METRICS = {
    "temperature_2m": "temperature_f", "relative_humidity_2m": "relative_humidity_pct",
    "precipitation": "precipitation_mm", "rain": "rain_mm", "snowfall": "snowfall_mm",
    "cloud_cover": "cloud_cover_pct", "pressure_msl": "pressure_msl_hpa", "wind_speed_10m": "wind_speed_mph",
    "wind_direction_10m": "wind_direction_deg", "wind_gusts_10m": "wind_gusts_mph", "weather_code": "weather_code",
}
HOURLY_PAYLOAD = (
    "hourly struct<time: array<string>, "
    + ", ".join(f"{name}: array<string>" for name in HOURLY_METRICS) + ">"
)
CURRENT_METRICS = {
    "temperature_2m": "temperature_f", "apparent_temperature": "feels_like_f", "pressure_msl": "pressure_msl_hpa",
    "surface_pressure": "surface_pressure_hpa", "relative_humidity_2m": "humidity_pct",
    "wind_speed_10m": "wind_speed_mph", "wind_direction_10m": "wind_direction_deg",
    "wind_gusts_10m": "wind_gusts_mph", "cloud_cover": "cloud_cover_pct", "precipitation": "precipitation_in",
    "rain": "rain_in", "snowfall": "snowfall_in",
}
CURRENT_PAYLOAD = (
    "current struct<time: string, weather_code: double, "
    + ", ".join(f"{name}: double" for name in CURRENT_METRICS) + ">"
)
