import datetime as dt

import pytest
from conftest import AS_OF, one, plan_text
from pyspark.sql import functions as F

from roadrisk import schemas
from roadrisk.functions import fixed
from roadrisk.functions.risk import accident_category, accident_score
from roadrisk.operators.shared import written
from roadrisk.plans import correlation, safety_mart, staging

ACCIDENT = dict(state="CA", start_lat=34.0, start_lng=-118.0, city="X", severity=2)


def accidents(rows_of, *records):
    full = [{**ACCIDENT, "accident_id": f"a{i}", **r} for i, r in enumerate(records)]
    return staging.stage_accidents(rows_of(schemas.ACCIDENTS_RAW, *full), AS_OF)


def weather(rows_of, *records):
    full = [dict(record_id=f"w{i}", state="CA", city="X", **r) for i, r in enumerate(records)]
    return staging.stage_weather_history(rows_of(schemas.WEATHER_HISTORICAL_RAW, *full), AS_OF)


@pytest.mark.parametrize("severity, rain, snow, freezing, wind, light, score, category", [
    (1, False, False, False, False, "Day", 1, "Low Risk"), (4, False, False, False, False, "Day", 3, "Low Risk"),
    (3, True, False, False, False, "Night", 6, "Medium Risk"), (4, True, True, True, True, "Night", 10, "High Risk"),
])
def test_scores(spark, severity, rain, snow, freezing, wind, light, score, category):
    hazards = {"is_poor_visibility": False, "is_heavy_rain": rain, "has_snow": snow, "is_freezing": freezing,
               "is_high_wind": wind}
    value = accident_score(F.lit(severity), F.lit(light), {name: F.lit(v) for name, v in hazards.items()})
    assert one(spark.range(1).select(value.alias("s"), accident_category(value).alias("c"))) == (score, category)


def test_matched_and_unmatched(rows_of):
    hour = dt.datetime(2024, 1, 31, 8)
    found = correlation.accident_weather(
        accidents(rows_of, {"start_time": "2024-01-31 08:10:00", "sunrise_sunset": "Night", "severity": 4},
                  {"start_time": "2024-01-31 09:10:00", "junction": "True"}),
        weather(rows_of, {"timestamp_utc": hour, "temperature_f": 20.0, "rain_mm": 5.0, "wind_speed_mph": 30.0}), AS_OF)
    matched, default = found.orderBy("accident_id").collect()
    assert (matched.risk_score, matched.risk_category, matched.has_weather_hazard) == (8, "High Risk", True)
    assert (matched.visibility_mi, matched.visibility_category) == (10.0, "Unknown")
    assert (default.temperature_f, default.humidity_pct, default.weather_main, default.visibility_category) == (
        70.0, 50.0, "Clear", "Good")
    assert (default.risk_score, default.has_weather_hazard, default.has_infrastructure_risk) == (2, False, True)


def test_high_wind_alone_is_no_hazard(rows_of):
    found = correlation.accident_weather(
        accidents(rows_of, {"start_time": "2024-01-31 08:10:00"}),
        weather(rows_of, {"timestamp_utc": dt.datetime(2024, 1, 31, 8), "temperature_f": 50.0, "wind_speed_mph": 30.0}))
    assert one(found, "is_high_wind", "has_weather_hazard", "risk_score") == (True, False, 3)


def test_repeated_weather_key_repeats_the_accident(rows_of):
    hour = dt.datetime(2024, 1, 31, 8)
    found = correlation.accident_weather(accidents(rows_of, {"start_time": "2024-01-31 08:10:00"}),
                                         weather(rows_of, {"timestamp_utc": hour}, {"timestamp_utc": hour}))
    assert found.count() == 2


def test_no_weather_gives_no_rows(rows_of):
    found = correlation.accident_weather(accidents(rows_of, {"start_time": "2024-01-31 08:10:00"}),
                                         weather(rows_of).where("false"))
    assert found.count() == 0
    assert safety_mart.safety_mart(found).count() == 0


def scored(spark, *records):
    columns = {"city": "'X'", "county": "'Y'", "state": "'CA'", "street": "'S'", "severity": "2",
               "severity_label": "'Moderate'", "accident_date": "date'2024-01-31'", "accident_hour": "8",
               "day_name": "'Wed'", "is_weekend": "false", "sunrise_sunset": "'Day'", "weather_main": "'Clear'",
               "weather_description": "'clear sky'", "temperature_f": "70D", "visibility_mi": "10D",
               "wind_speed_mph": "0D", "humidity_pct": "50D", "risk_score": "2", "risk_category": "'Low Risk'",
               "has_weather_hazard": "false", "has_infrastructure_risk": "false", "has_junction": "true",
               "has_traffic_signal": "false"}
    selects = []
    for record in records:
        merged = {**columns, **record}
        selects.append("SELECT " + ", ".join(f"{v} AS {k}" for k, v in merged.items()))
    return written(spark.sql(" UNION ALL ".join(selects)), "scored")


def test_hot_spots_need_five_accidents(spark):
    rows = scored(spark, *[{"street": "'four'"}] * 4, *[{"street": "'five'"}] * 5)
    spots = safety_mart.hot_spots(rows)
    assert one(spots, "street", "accident_count", "junction_accidents") == ("five", 5, 5)
    assert "TakeOrderedAndProject" in plan_text(spots)


def test_worst_category_is_the_greatest_text(spark):
    rows = scored(spark, *[{"risk_category": f"'{c}'", "risk_score": s} for c, s in
                           (("High Risk", "9"), ("Low Risk", "1"), ("Medium Risk", "5"), ("Low Risk", "1"),
                            ("Low Risk", "1"))])
    assert one(safety_mart.hot_spots(rows), "max_risk_category") == "Medium Risk"
    assert one(safety_mart.hot_spots(rows, severity_order=True), "max_risk_category") == "High Risk"


def test_stacked_mart(spark):
    mart = safety_mart.safety_mart(scored(spark, *[{}] * 5), AS_OF)
    rows = {r.metric_type: r for r in mart.collect()}
    assert set(rows) == {"city_severity", "weather_condition", "time_pattern", "high_risk_location"}
    assert rows["time_pattern"].category == "Wed 08:00" and rows["time_pattern"].city is None
    assert rows["weather_condition"].weather_related_count == 5
    assert rows["high_risk_location"].detail == "Low Risk"
    assert [f.dataType.simpleString() for f in mart.schema][:5] == ["string"] * 5
    ordered = [r.metric_type for r in safety_mart.ordered_mart(mart).collect()]
    assert ordered == sorted(ordered)


def test_wide_plans_stay_in_the_jvm(rows_of):
    found = correlation.accident_weather(accidents(rows_of, {"start_time": "2024-01-31 08:10:00"}),
                                         weather(rows_of, {"timestamp_utc": dt.datetime(2024, 1, 31, 8)}))
    plan = plan_text(found)
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert set(fixed.WEATHER_MATCH_DEFAULTS) <= set(found.columns)
