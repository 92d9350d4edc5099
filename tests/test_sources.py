import datetime as dt
import json

from conftest import AS_OF, plan_text
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadrisk import schemas
from roadrisk.functions import fixed
from roadrisk.sources import accidents, cities, payloads, tables

FETCHED = "2024-01-31 10:30:00"
LINE = {"geometry": {"type": "LineString", "coordinates": [[-118.24, 34.05], [-118.25, 34.06]]},
        "properties": {"id": "i1", "iconCategory": 6, "magnitudeOfDelay": 2, "delay": 300,
                       "events": [{"description": "Stationary traffic", "code": 101}],
                       "startTime": "2024-01-31T10:00:00Z", "endTime": None}}
POINT = {"geometry": {"type": "Point", "coordinates": [-118.20, 34.00]}, "properties": {}}


def landed(rows_of, *answers, city="Los Angeles"):
    texts = [a if isinstance(a, str) else json.dumps(a) for a in answers]
    return rows_of(schemas.LANDED, *[{"payload": t} for t in texts], city=city, fetched_at=FETCHED)


def test_city_dimension(spark):
    table = cities.city_dimension(spark)
    assert table.count() == 55
    assert table.select("region").distinct().count() == 7
    box = cities.with_box(table).where("name = 'Fresno'").first()
    assert (round(box.min_lon, 4), round(box.max_lat, 4)) == (-119.8871, 36.8378)


def test_flow_payload(spark, rows_of):
    answer = {"flowSegmentData": {"currentSpeed": 15, "freeFlowSpeed": 60, "currentTravelTime": 240,
                                  "freeFlowTravelTime": 60, "confidence": 0.9, "roadClosure": False}}
    rows = landed(rows_of, answer, {"flowSegmentData": {}}, '{"flowSegmentData": {"curr')
    dimension = cities.city_dimension(spark)
    raw = payloads.flow_raw(rows, dimension).orderBy(F.col("current_speed").desc_nulls_last()).collect()
    assert len(raw) == 2
    assert raw[0].flow_id == "Los Angeles_2024-01-31_103000"
    assert (raw[0].road_name, raw[0].current_travel_time, json.loads(raw[0].raw_json)) == (
        "Unknown", 240, answer["flowSegmentData"])
    assert (raw[1].current_speed, raw[1].confidence, raw[1].road_closure) == (None, None, False)
    clean = payloads.flow_cleaned(rows, dimension).orderBy(F.col("current_speed_mph").desc()).collect()
    assert (clean[0].speed_reduction_pct, clean[0].delay_sec) == (75.0, 180)
    assert (clean[1].free_flow_speed_mph, clean[1].speed_reduction_pct, clean[1].confidence_level) == (0.0, 0.0, 0.5)
    assert payloads.unreadable(rows, schemas.FLOW_PAYLOAD).select("_corrupt_record").collect()[0][0].endswith("curr")


def test_payload_is_parsed_once(spark, rows_of):
    plan = plan_text(payloads.flow_raw(landed(rows_of, {}), cities.city_dimension(spark)))
    assert plan.count("from_json") == 1
    assert "BroadcastHashJoin" in plan


def test_incidents(spark, rows_of):
    no_place = {"properties": {"events": []}}
    polygon = {"geometry": {"type": "Polygon", "coordinates": [[-121.5, 37.25]]}, "properties": {"magnitudeOfDelay": 9}}
    rows = landed(rows_of, {"incidents": [LINE, POINT, no_place, polygon]}, {"incidents": []}, {})
    dimension = cities.city_dimension(spark)
    centre = (34.0522, -118.2437)
    raw = payloads.incidents_raw(rows, dimension).collect()
    assert [(r.latitude, r.longitude) for r in raw] == [(34.05, -118.24), (34.0, -118.2), centre, centre]
    assert [r.incident_id for r in raw] == ["i1", "INC_Los Angeles_1", "INC_Los Angeles_2", "INC_Los Angeles_3"]
    assert [r.description for r in raw] == ["Stationary traffic", None, None, None]
    assert json.loads(raw[0].raw_json) == LINE
    clean = payloads.incidents_cleaned(rows, dimension).collect()
    assert [(r.latitude, r.longitude) for r in clean] == [(34.05, -118.24), (34.0, -118.2), centre, (37.25, -121.5)]
    assert [r.severity for r in clean] == ["MAJOR", "MINOR", "MINOR", "CRITICAL"]
    assert [r.delay_minutes for r in clean] == [5, 0, 0, 0]
    assert clean[1].description == "No description" and clean[1].incident_type == "UNKNOWN"
    assert clean[0].start_time == dt.datetime(2024, 1, 31, 10)
    assert clean[1].start_time == dt.datetime(2024, 1, 31, 10, 30)


def test_hourly_arrays(spark, rows_of):
    answer = {"hourly": {"time": ["2024-01-31T00:00", "2024-01-31T01:00"], "temperature_2m": [55.4],
                         "rain": [0.0, "x"], "weather_code": [0, 61.0]}}
    rows = payloads.hourly_weather(landed(rows_of, answer), cities.city_dimension(spark)).collect()
    assert [r.record_id for r in rows] == ["Los_Angeles_20240131_0000", "Los_Angeles_20240131_0100"]
    assert [(r.temperature_f, r.rain_mm, r.weather_code, r.snowfall_mm) for r in rows] == [
        (55.4, 0.0, 0, None), (None, None, 61, None)]


def test_current_weather(spark, rows_of):
    rows = landed(rows_of, {"current": {"time": "2024-01-31T10:15", "temperature_2m": 68.0, "weather_code": 2}},
                  {"current": {"weather_code": 66}}, {"current": {}})
    found = payloads.current_weather(rows, cities.city_dimension(spark)).collect()
    assert [r.record_id for r in found] == ["Los_Angeles_20240131_1015"] + ["Los_Angeles_20240131_1030"] * 2
    assert [r.weather_main for r in found] == ["Clouds", "Unknown", "Clear"]
    assert (found[0].temp_min_f, found[0].temp_max_f, found[0].timestamp_str) == (68.0, 68.0, "2024-01-31 10:15:00")


def test_unknown_city_is_not_polled(spark, rows_of):
    assert payloads.flow_raw(landed(rows_of, {}, city="Elsewhere"), cities.city_dimension(spark)).count() == 0


def test_accident_csv(spark, tmp_path):
    headers = [h for h, _ in fixed.rows(fixed.ACCIDENT_COLUMNS, header=False)] + ["Airport_Code"]
    def line(**values):
        return ",".join(values.get(h.split("(")[0], "") for h in headers)
    text = "\n".join([",".join(headers),
                      line(ID="A-1", Severity="2", State="CA", Distance="0.5", Temperature="NaN", Street='"5th, ""N"""',
                           Bump="False", City="N/A"),
                      line(ID="A-2", Severity="3", State="NV"), line(ID="A-3", Severity="x", State="CA")])
    path = tmp_path / "accidents.csv"
    path.write_text(text + "\n")
    rows = accidents.read_csv(spark, str(path), as_of=AS_OF)
    assert "PushedFilters: [IsNotNull(State), EqualTo(State,CA)]" in plan_text(rows)
    assert "Airport_Code" not in plan_text(rows)
    first, third = rows.orderBy("accident_id").collect()
    assert (first.severity, first.distance_mi, first.temperature_f, first.street, first.bump, first.city) == (
        2, 0.5, None, '5th, "N"', "False", None)
    assert third.severity is None and first.load_timestamp == dt.datetime(2024, 2, 1)


def test_trailing_days_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT explode(sequence(timestamp_ntz'2024-01-20', timestamp_ntz'2024-02-10', interval 6 hour)) AS ts"
              ).write.parquet(path)
    rows = tables.trailing_days(spark.read.parquet(path), "ts", AS_OF)
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    assert (low, high) == (dt.datetime(2024, 1, 27), dt.datetime(2024, 2, 1, 18))
    assert "GreaterThanOrEqual(ts" in plan_text(rows)


def test_parsed_tables_match_the_declared_ones(spark, rows_of):
    dimension, empty = cities.city_dimension(spark), landed(rows_of, {})
    audit = {"load_timestamp", "data_source"}

    def declared(ddl):
        return {(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl) if f.name not in audit}

    for build, ddl in ((payloads.flow_raw, schemas.TRAFFIC_FLOW_RAW),
                       (payloads.incidents_raw, schemas.TRAFFIC_INCIDENTS_RAW),
                       (payloads.hourly_weather, schemas.WEATHER_HISTORICAL_RAW),
                       (payloads.current_weather, schemas.WEATHER_REALTIME_RAW)):
        assert set(build(empty, dimension).dtypes) == declared(ddl)
    assert set(dimension.dtypes) == declared(schemas.CITY_DIM)
    text = spark.createDataFrame([], ", ".join(
        f"`{header}` string" for header, _ in fixed.rows(fixed.ACCIDENT_COLUMNS, header=False)))
    assert set(accidents.project(text).dtypes) == declared(schemas.ACCIDENTS_RAW)
