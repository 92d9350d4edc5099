import datetime as dt

import pytest
from conftest import AS_OF, one

from roadrisk import schemas
from roadrisk.plans import staging, traffic_mart, weather_fact, weather_features

ACCIDENT = dict(accident_id="a", severity=2, start_time="2020-12-30 22:44:00.000000000", state="CA",
                start_lat=34.0, start_lng=-118.0)
HOUR = dict(record_id="r", city="X", state="CA", timestamp_utc=dt.datetime(2024, 1, 7, 5))
STATION = dict(record_id="s", city="X", region="R", state="CA", latitude=34.0, longitude=-118.0,
               timestamp_str="2024-01-31 10:00:00", date="2024-01-31", hour=10, temperature_f=70.0)


def flow(rows_of, free, current, **more):
    record = dict(flow_id="f", city="X", state="CA", timestamp="2024-01-31 10:00:00", current_speed=current,
                  free_flow_speed=free, **more)
    return staging.stage_flow(rows_of(schemas.TRAFFIC_FLOW_RAW, record))


@pytest.mark.parametrize("free, current, pct, level, score", [
    (60.0, 15.0, 75.0, "Severe", 100), (60.0, 30.0, 50.0, "Heavy", 80), (60.0, 45.0, 25.0, "Moderate", 50),
    (60.0, 54.0, 10.0, "Light", 25), (60.0, 66.0, -10.0, "Free Flow", 10), (0.0, 0.0, 0.0, "Unknown", 10),
    (100000.0, 25004.0, 75.0, "Heavy", 100),
])
def test_flow_levels(rows_of, free, current, pct, level, score):
    scored = traffic_mart.scored_flow(flow(rows_of, free, current))
    assert one(scored, "speed_reduction_pct", "congestion_level", "congestion_score") == (pct, level, score)


@pytest.mark.parametrize("free, current", [(None, 10.0), (60.0, None), (-1.0, 10.0), (60.0, -1.0)])
def test_flow_without_speeds_is_dropped(rows_of, free, current):
    assert flow(rows_of, free, current).count() == 0


def test_flow_delay_and_closure(rows_of):
    staged = flow(rows_of, 60.0, 30.0, current_travel_time=240, free_flow_travel_time=60)
    assert one(staged, "delay_sec", "road_closure") == (180, False)


def staged_accident(rows_of, **change):
    return staging.stage_accidents(rows_of(schemas.ACCIDENTS_RAW, {**ACCIDENT, **change}), AS_OF)


@pytest.mark.parametrize("change", [
    {"start_time": "bad"}, {"start_time": None}, {"severity": 5}, {"severity": None}, {"start_lat": 45.0},
    {"state": "NV"}, {"state": " CA"}, {"accident_id": None},
])
def test_invalid_accidents_are_dropped(rows_of, change):
    assert staged_accident(rows_of, **change).count() == 0


def test_accident_bounds_are_inclusive(rows_of):
    staged = staged_accident(rows_of, start_lat=32.5, start_lng=-114.0)
    assert one(staged, "accident_hour", "severity_label") == (22, "Moderate")


def test_accident_text_defaults_and_flags(rows_of):
    staged = staged_accident(rows_of, street="  ", city=" Fresno ", junction=" true ", bump="1")
    assert one(staged, "street", "city", "weather_condition", "sunrise_sunset", "has_junction", "has_bump",
               "has_stop") == ("Unknown", "Fresno", "Clear", "Day", True, False, False)


def test_accident_calendar(rows_of):
    staged = staged_accident(rows_of, start_time="2024-01-07T08:00:00")
    assert one(staged, "day_of_week", "day_name", "is_weekend") == (0, "Sun", True)
    assert len(staged.columns) == 47


def test_cleaned_accidents_fill_defaults(rows_of):
    raw = rows_of(schemas.ACCIDENTS_RAW, {**ACCIDENT, "state": "NV", "temperature_f": float("nan"), "bump": "True"},
                  {**ACCIDENT, "severity": None})
    cleaned = staging.clean_accidents(raw)
    assert one(cleaned, "temperature_f", "pressure_in", "visibility_mi", "street", "bump", "stop", "wind_chill_f",
               "start_time") == (70.0, 29.92, 10.0, "", True, False, None, dt.datetime(2020, 12, 30, 22, 44))


@pytest.mark.parametrize("change, columns, expected", [
    ({"temperature_f": 32.0}, ("temperature_category", "is_freezing"), ("Cold", False)),
    ({}, ("temperature_category", "wind_category", "precipitation_category"), ("Hot", "Very Strong", "None")),
    ({"wind_speed_mph": 30.0}, ("wind_category", "is_high_wind"), ("Strong", True)),
    ({"rain_mm": 2.54}, ("rain_1h_in", "is_heavy_rain"), (0.1, True)),
    ({"weather_code": 56}, ("weather_main", "weather_description", "weather_icon"), ("Unknown", "unknown", "01d")),
    ({"weather_code": 66}, ("weather_main", "weather_icon"), ("Freezing Rain", "01d")),
    ({"weather_code": 53}, ("weather_main", "weather_icon"), ("Rain", "09d")),
    ({"pressure_msl_hpa": 1013.25}, ("pressure_in", "visibility_mi", "visibility_category"), (29.92, None, "Unknown")),
])
def test_hourly_rules(rows_of, change, columns, expected):
    staged = staging.stage_weather_history(rows_of(schemas.WEATHER_HISTORICAL_RAW, {**HOUR, **change}), AS_OF)
    assert one(staged, *columns) == expected
    assert one(staged, "day_of_week", "day_name", "is_weekend") == (0, "Sunday", True)
    assert len(staged.columns) == 46


@pytest.mark.parametrize("change, columns, expected", [
    ({"temperature_f": 32.0}, ("temperature_category", "is_freezing"), ("Cold", True)),
    ({"wind_speed_mph": 30.0}, ("wind_category", "is_high_wind"), ("Moderate", False)),
    ({}, ("wind_category", "precipitation_category", "has_snow"), ("Calm", "None", False)),
    ({"precipitation_in": 0.3}, ("precipitation_category", "is_heavy_rain"), ("Heavy", True)),
])
def test_current_rules(rows_of, change, columns, expected):
    staged = staging.stage_weather_current(rows_of(schemas.WEATHER_REALTIME_RAW, {**STATION, **change}))
    assert one(staged, *columns) == expected
    assert len(staged.columns) == 38


@pytest.mark.parametrize("change, columns, expected", [
    ({"wind_direction_deg": 22.5}, ("wind_direction_cardinal",), "N"),
    ({"wind_direction_deg": 337.5}, ("wind_direction_cardinal",), "NW"),
    ({"wind_direction_deg": 340.0}, ("wind_direction_cardinal",), "N"),
    ({}, ("wind_direction_cardinal", "humidity_category"), ("N", "Very Humid")),
    ({"humidity_pct": 45.0, "wind_speed_mph": 5.0, "precipitation_in": 0.0}, ("comfort_index",), "Excellent"),
    ({"temperature_f": 50.0, "wind_speed_mph": 5.0, "precipitation_in": 0.2}, ("comfort_index",), "Fair"),
    ({"snowfall_in": 0.1}, ("has_precipitation", "comfort_index"), (True, "Poor")),
])
def test_fact_rules(rows_of, change, columns, expected):
    staged = staging.stage_weather_current(rows_of(schemas.WEATHER_REALTIME_RAW, {**STATION, **change}))
    assert one(weather_fact.weather_metrics(staged), *columns) == expected


@pytest.mark.parametrize("change, columns, expected", [
    ({"wind_direction_deg": 22.5}, ("wind_direction_cardinal",), "NE"),
    ({}, ("wind_direction_cardinal", "comfort_level", "humidity_pct"), ("Unknown", "Unknown", 0.0)),
    ({"temperature_f": 80.0, "humidity_pct": 60.0}, ("heat_index_f", "comfort_level"), (80.0, "Hot & Humid")),
    ({"temperature_f": 50.0, "wind_speed_mph": 20.0}, ("wind_chill_f",), 50.0),
    ({"temperature_f": 40.0, "wind_speed_mph": 3.0}, ("wind_chill_f",), 40.0),
    ({"pressure_msl_hpa": 1013.0, "humidity_pct": 50.0}, ("aqi_estimate",), "Moderate"),
    ({"weather_main": "Drizzle"}, ("is_rainy", "is_low_visibility", "time_of_day", "day_of_week"),
     (True, False, "Morning", 2)),
])
def test_cleaned_current_features(rows_of, change, columns, expected):
    features = weather_features.current_features(rows_of(schemas.WEATHER_REALTIME_RAW, {**STATION, **change}))
    assert one(features, *columns) == expected


def test_heat_index_polynomial(rows_of):
    t, h = 90.0, 60.0
    expected = (-42.379 + 2.04901523 * t + 10.14333127 * h - 0.22475541 * t * h - 0.00683783 * t * t
                - 0.05481717 * h * h + 0.00122874 * t * t * h + 0.00085282 * t * h * h - 0.00000199 * t * t * h * h)
    raw = rows_of(schemas.WEATHER_HISTORICAL_RAW, {**HOUR, "temperature_f": t, "relative_humidity_pct": h})
    assert one(weather_features.history_features(raw), "heat_index_f") == pytest.approx(expected, abs=1e-9)


def test_history_conditions(rows_of):
    raw = rows_of(schemas.WEATHER_HISTORICAL_RAW, *[{**HOUR, "record_id": str(c), "weather_code": c}
                                                   for c in (0, 56, 77, 81, 4, None)])
    found = {r.record_id: r.weather_condition for r in weather_features.history_features(raw).collect()}
    assert found == {"0": "Clear", "56": "Drizzle", "77": "Snow", "81": "Rain Showers", "4": "Other",
                     "None": "Unknown"}


def test_city_context_and_null_state(rows_of):
    base = dict(city="X", timestamp="2024-01-31 10:00:00", free_flow_speed=60.0)
    raw = rows_of(schemas.TRAFFIC_FLOW_RAW, {"flow_id": "a", "state": "CA", "current_speed": 15.0, **base},
                  {"flow_id": "b", "state": "CA", "current_speed": 60.0, "road_closure": True, **base},
                  {"flow_id": "c", "state": None, "current_speed": 60.0, **base})
    mart = {r.flow_id: r for r in traffic_mart.traffic_mart(staging.stage_flow(raw)).collect()}
    assert (mart["a"].city_avg_congestion, mart["a"].city_total_segments, mart["a"].city_closed_roads) == (55.0, 2, 1)
    assert [mart[k].relative_congestion_level for k in "abc"] == ["ABOVE_AVG", "BELOW_AVG", "AVERAGE"]
    assert mart["c"].city_avg_congestion is None
