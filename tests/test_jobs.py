"""All runs on a small landing folder, from files to marts and back."""

import datetime as dt
import json

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from roadrisk import jobs, schemas
from roadrisk.functions import fixed
from roadrisk.plans import features
from roadrisk.sources.tables import read_table

CITY = "Fresno"


def land(path, *answers, city=CITY):
    path.write_text("".join(
        json.dumps({"city": city, "fetched_at": "2024-01-31 20:00:00", "payload": json.dumps(a)}) + "\n" for a in answers))
    return str(path)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    headers = [h for h, _ in fixed.rows(fixed.ACCIDENT_COLUMNS, header=False)]
    lines = [",".join(headers)]
    for day in range(1, 41):
        start = dt.datetime(2024, 1, 31, 8, 10) - dt.timedelta(days=day - 1)
        for i in range(4 + day % 3):
            row = dict(ID=f"A{day}-{i}", Severity=str(1 + i % 4), Start_Time=str(start), State="CA", City=CITY,
                       Start_Lat="36.7", Start_Lng="-119.8", Street="Main", Junction="True")
            lines.append(",".join(row.get(h, "") for h in headers))
    (folder / "accidents.csv").write_text("\n".join(lines) + "\n")
    hours = land(folder / "hourly.json", {"hourly": {
        "time": ["2024-01-31T08:00", "2024-01-20T08:00"], "temperature_2m": [20.0, 50.0], "weather_code": [71, 0]}})
    now = land(folder / "current.json", {"current": {
        "time": "2024-01-31T19:00", "temperature_2m": 30.0, "relative_humidity_2m": 50, "weather_code": 3}})
    flow = land(folder / "flow.json", {"flowSegmentData": {"currentSpeed": 20, "freeFlowSpeed": 60}})
    with open(flow, "a") as lines_:
        lines_.write(json.dumps({"city": CITY, "fetched_at": "2024-01-31 20:00:00", "payload": '{"flowSegm'}) + "\n")
    incidents = land(folder / "incidents.json", {"incidents": [{"properties": {"id": "i"}}]})

    out = str(tmp_path_factory.mktemp("lake"))
    assert jobs.load_accidents(spark, out, str(folder / "accidents.csv"), AS_OF)
    assert not jobs.load_accidents(spark, out, str(folder / "accidents.csv"), AS_OF)
    jobs.load_weather_history(spark, out, hours, AS_OF)
    jobs.load_current_weather(spark, out, now, AS_OF)
    jobs.load_traffic(spark, out, flow, incidents, AS_OF)
    jobs.build_safety(spark, out, AS_OF)
    return out


def test_loads(spark, root):
    raw = read_table(spark, root, "raw_archive", "traffic_accidents_raw")
    assert raw.count() == raw.select("accident_id").distinct().count() == 200
    assert read_table(spark, root, "raw_archive", "weather_california_historical_raw").count() == 1
    assert read_table(spark, root, "raw", "traffic_incidents_realtime").first().severity == "MINOR"
    assert read_table(spark, root, "marts", "fct_weather_current").first().state_temp_rank == 1
    mart = read_table(spark, root, "marts", "mart_realtime_traffic_dashboard").first()
    assert (mart.congestion_level, mart.relative_congestion_level) == ("Heavy", "AVERAGE")


def test_broken_answers_are_kept_apart(spark, root):
    (row,) = read_table(spark, root, "raw", "quarantine").collect()
    assert (row.source, row.city, row[4 - 1], row.reason) == ("flow", CITY, '{"flowSegm', "broken JSON")
    assert read_table(spark, root, "raw", "traffic_flow_raw").count() == 1


def test_safety(spark, root):
    table = read_table(spark, root, "analytics", "accident_weather_correlation")
    assert table.count() == 200
    assert table.where("has_snow OR is_freezing").select("accident_date").distinct().collect()[0][0] == dt.date(2024, 1, 31)
    kinds = read_table(spark, root, "marts", "mart_traffic_safety_dashboard").groupBy("metric_type").agg(
        F.sum("accident_count").alias("n")).collect()
    assert {(r.metric_type, r.n) for r in kinds} == {
        (k, 200) for k in ("city_severity", "weather_condition", "time_pattern", "high_risk_location")}


@pytest.mark.parametrize("method", ["trend", "features", "pooled"])
def test_forecast(spark, root, method):
    rows = jobs.build_forecast(spark, root, AS_OF, method).orderBy("date").collect()
    assert [r.date for r in rows] == [dt.date(2024, 2, 1) + dt.timedelta(days=i) for i in range(7)]
    for r in rows:
        assert r.risk_multiplier == pytest.approx(1.32) and r.temperature_risk == "FREEZING"
        assert 4 * 1.32 < r.forecasted_accident_count < 7 * 1.32
    assert spark.table("accident_risk_assessment_realtime").count() == 7


def test_trailing_reads_are_pruned_by_day(spark, root):
    for table, schema, build in (
            ("weather_california_realtime_raw", schemas.WEATHER_REALTIME_RAW, features.latest_weather_for_features),
            ("weather_california_realtime_raw", schemas.WEATHER_REALTIME_RAW, features.latest_weather_for_adjustment),
            ("traffic_flow_raw", schemas.TRAFFIC_FLOW_RAW, features.latest_traffic)):
        out = build(jobs._raw_by_day(spark, root, table, schema), AS_OF)
        filters = [line for line in out._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
        assert filters and all("event_date" in line.split("PartitionFilters")[1].split("]")[0] for line in filters)
        assert out.count() == 1


def test_unknown_method(spark, root):
    with pytest.raises(ValueError, match="unknown method"):
        jobs.build_forecast(spark, root, AS_OF, "guess")


def test_quality(spark, root):
    report = jobs.quality_report(spark, root, AS_OF)
    assert report.count() == 22
    assert report.where("failures > 0").count() == 0
