import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import AS_OF, one, plan_text
from pyspark.sql import functions as F

from roadrisk import schemas
from roadrisk.functions import fixed, risk
from roadrisk.plans import features, forecast, trends

TODAY = dt.date(2024, 2, 1)


def accidents(rows_of, *groups):
    """(city, day, number) groups as cleaned accidents."""
    records = []
    for city, day, number in groups:
        records += [dict(accident_id=f"{city}{day}{i}", city=city, severity=2 + i % 3,
                         start_time=dt.datetime.combine(day, dt.time(8))) for i in range(number)]
    return rows_of(schemas.ACCIDENTS_HISTORICAL, *records)


def weather(rows_of, *records):
    return rows_of(schemas.WEATHER_HISTORICAL_RAW, *records, state="CA")


def history(rows_of, cities=("A", "B"), days=60, base=10, seed=1):
    rng = random.Random(seed)
    groups = []
    for k, city in enumerate(cities):
        for d in range(1, days + 1):
            day = TODAY - dt.timedelta(days=d)
            groups.append((city, day, base + 4 * k + (5 if day.weekday() < 5 else 0) + rng.randrange(3)))
    return accidents(rows_of, *groups)


def current(rows_of, *records):
    return rows_of(schemas.WEATHER_REALTIME_RAW, *records)


def test_training_rows_need_three_accidents(rows_of):
    monday = dt.date(2024, 1, 8)
    table = features.training_table(
        accidents(rows_of, ("A", monday, 3), ("A", dt.date(2024, 1, 9), 2), ("A", dt.date(2020, 1, 1), 9)),
        weather(rows_of, dict(record_id="1", city="A", timestamp_utc=dt.datetime(2024, 1, 8, 1), temperature_f=20.0,
                              precipitation_mm=11.0)), AS_OF)
    row = table.first()
    assert table.count() == 1
    assert (row.accident_count, row.severe_accident_count, row.day_of_week, row.is_weekend) == (3, 2, 1, 1)
    assert (row.heavy_precipitation, row.freezing_temp, row.high_wind, row.max_wind_speed_mph) == (1, 1, 0, 10.0)
    assert len(table.columns) == 25
    assert features.training_view(table, AS_OF).columns == ["date", "city", "accident_count", *fixed.TRAINING_FEATURES]


def test_training_join_reuses_the_aggregates_shuffles(spark, rows_of, tmp_path):
    accidents(rows_of, ("A", TODAY, 3)).write.parquet(str(tmp_path / "a"))
    weather(rows_of, dict(record_id="1", city="A")).write.parquet(str(tmp_path / "w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(features.training_table(
            spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "w")), AS_OF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2
    assert "GreaterThanOrEqual(start_time" in plan and "description" not in plan


def test_calendar_weekend_on_request(rows_of):
    table = features.training_table(accidents(rows_of, ("A", dt.date(2024, 1, 7), 3)), weather(rows_of), AS_OF,
                                    weekend_dows=(0, 6))
    assert one(table, "is_weekend", "avg_temp_f", "avg_pressure_hpa") == (1, 65.0, 1013.0)


def test_no_training_rows_is_an_error(rows_of):
    with pytest.raises(ValueError, match="no training data"):
        features.require_rows(accidents(rows_of), "training data")


def test_future_features(rows_of):
    view = features.training_view(features.training_table(
        accidents(rows_of, ("A", dt.date(2024, 1, 8), 3), ("B", dt.date(2024, 1, 8), 3)), weather(rows_of), AS_OF), AS_OF)
    now = current(rows_of, dict(record_id="1", city="A", timestamp_str="2024-01-31 20:00:00", temperature_f=30.0,
                                precipitation_in=0.05), dict(record_id="2", city="A", timestamp_str="2024-01-31 17:59:00",
                                                             temperature_f=90.0))
    rows = features.future_features(view, now, AS_OF)
    assert [r.date for r in rows.where("city = 'A'").orderBy("date").collect()] == [
        TODAY + dt.timedelta(days=i) for i in range(7)]
    a = rows.where("city = 'A'").first()
    assert (a.avg_temp_f, a.freezing_temp, a.heavy_precipitation) == (30.0, 1, 1)
    assert a.total_precipitation_mm == pytest.approx(1.27)
    b = rows.where("city = 'B'").first()
    assert (b.avg_temp_f, b.freezing_temp, b.total_precipitation_mm) == (65.0, 0, 0.0)


def test_precipitation_thresholds_differ(rows_of):
    rain = [dict(record_id="1", city="A", timestamp_str="2024-01-31 22:00:00", precipitation_in=0.05)]
    assert one(features.latest_weather_for_features(current(rows_of, *rain), AS_OF), "has_precipitation") == 1
    assert one(features.latest_weather_for_adjustment(current(rows_of, *rain), AS_OF), "has_precipitation") == 0


def test_trend_recovers_line_and_weekday(rows_of, spark):
    days = [(TODAY - dt.timedelta(days=d)) for d in range(1, 71)]
    rows = [("A", day, 200 + 2 * (day - TODAY).days + (21 if day.weekday() == 6 else 0)) for day in days]
    rows += [("short", day, 5) for day in days[:5]]
    view = spark.createDataFrame(rows, "city string, date date, accident_count long")
    model = forecast.fit_trend(view, AS_OF)
    (row,) = model.collect()
    assert row.city == "A" and row.n == 70
    assert row.slope == pytest.approx(2, abs=0.05)
    assert row.effects[0] == pytest.approx(18, abs=0.5)  # 21 above the other days, whose mean takes 3 of it
    assert row.sigma < 1
    future = view.where("city = 'A'").limit(1).select("city", F.lit(TODAY).alias("date"))
    assert one(forecast.forecast_trend(model, future, AS_OF), "forecast") == pytest.approx(200, abs=2)


def test_skipped_cities_are_listed(spark):
    days = [TODAY - dt.timedelta(days=d) for d in range(1, 21)]
    rows = [("long", day, 5) for day in days] + [("short", day, 5) for day in days[:5]] + [("once", days[0], 5)] * 14
    view = spark.createDataFrame(rows, "city string, date date, accident_count long")
    assert {(r.city, r.n, r.reason) for r in forecast.skipped_series(view).collect()} == {
        ("short", 5, "fewer than 14 days"), ("once", 14, "a single day")}
    assert {r.city for r in forecast.fit_trend(view, AS_OF).collect()} == {"long"}


def test_city_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for city, n in (("A", 60), ("B", 30), ("C", 1)):
        x = np.round(rng.normal(3, 1, (n, len(fixed.TRAINING_FEATURES))), 3)
        y = np.round(x @ np.arange(x.shape[1]) + rng.normal(0, 1, n)).astype(int)
        rows += [(city, TODAY - dt.timedelta(days=i + 1), int(y[i]), *map(float, x[i])) for i in range(n)]
        full = np.concatenate([np.ones((n, 1)), x], axis=1)
        want[city] = np.linalg.solve(full.T @ full + forecast.PENALTY * np.diag([0.0] + [1.0] * x.shape[1]), full.T @ y)
    schema = "city string, date date, accident_count long, " + ", ".join(f"{f} double" for f in fixed.TRAINING_FEATURES)
    view = spark.createDataFrame(rows, schema)
    model = forecast.fit_city_ridge(view)
    got = {r.city: r.beta for r in model.collect()}
    assert set(got) == set(want) and all(np.allclose(got[c], want[c], atol=1e-6) for c in want)
    assert all(r.gap < 1e-9 for r in forecast.ridge_residuals(view, model).collect())
    future = view.where("city = 'A'").limit(3).drop("accident_count")
    for r in forecast.forecast_city_ridge(model, future).collect():
        assert r.lower_bound < r.forecast < r.upper_bound


def test_bounds_are_symmetric(rows_of):
    view = features.training_view(features.training_table(history(rows_of), weather(rows_of), AS_OF), AS_OF)
    future = features.future_features(view, current(rows_of), AS_OF)
    rows = forecast.forecast_trend(forecast.fit_trend(view, AS_OF), future, AS_OF).collect()
    assert len(rows) == 14
    for r in rows:
        assert r.lower_bound < r.forecast < r.upper_bound
        assert r.forecast - r.lower_bound == pytest.approx(r.upper_bound - r.forecast)


def test_feature_model_is_close_to_the_trend(rows_of):
    view = features.training_view(features.training_table(history(rows_of), weather(rows_of), AS_OF), AS_OF)
    future = features.future_features(view, current(rows_of), AS_OF)
    trend = {(r.series, r.ts): r.forecast
             for r in forecast.forecast_trend(forecast.fit_trend(view, AS_OF), future, AS_OF).collect()}
    model, spread = forecast.fit_features(view)
    rows = forecast.forecast_features(model, spread, future).collect()
    assert len(rows) == len(trend) and spread < 2
    for r in rows:
        assert r.forecast == pytest.approx(trend[(r.series, r.ts)], abs=3)


def test_feature_model_with_one_city(rows_of):
    view = features.training_view(
        features.training_table(history(rows_of, cities=("A",)), weather(rows_of), AS_OF), AS_OF)
    model, spread = forecast.fit_features(view)
    future = features.future_features(view, current(rows_of), AS_OF)
    assert forecast.forecast_features(model, spread, future).count() == 7


def test_feature_model_with_a_blank_city(rows_of):
    def fitted(*names):
        table = features.training_table(history(rows_of, cities=names), weather(rows_of), AS_OF)
        view = features.training_view(table, AS_OF)
        future = features.future_features(view, current(rows_of), AS_OF)
        model, spread = forecast.fit_features(view)
        return {(r.series, r.ts): r.forecast for r in forecast.forecast_features(model, spread, future).collect()}

    blank, named = fitted("", "B"), fitted("A", "B")
    assert {series for series, _ in blank} == {"", "B"} and len(blank) == 14
    assert all(blank[series.replace("A", ""), ts] == pytest.approx(value) for (series, ts), value in named.items())


@pytest.mark.parametrize("value, rain, wind, cold, congestion, multiplier, adjusted, level, score", [
    (10.0, 0, 0, 0, 30.0, 1.0, 10.0, "LOW", 10), (10.0, 1, 1, 1, 31.0, 1.57, 15.7, "MEDIUM", 44),
    (40.0, None, None, None, None, 1.0, 40.0, "HIGH", 40), (200.0, 0, 0, 0, 0.0, 1.0, 200.0, "CRITICAL", 100),
    (None, 0, 0, 0, 0.0, 1.0, None, "LOW", None),
])
def test_adjustment_and_risk(spark, value, rain, wind, cold, congestion, multiplier, adjusted, level, score):
    number = lambda v: F.lit(v).cast("double")
    signals = {"has_precipitation": F.lit(rain).cast("int"), "has_high_wind": F.lit(wind).cast("int"),
               "has_freezing_temp": F.lit(cold).cast("int")}
    factor = risk.live_multiplier(signals, number(congestion))
    scaled = F.round(number(value) * factor, 2)
    got = one(spark.range(1).select(
        F.round(factor, 6), scaled, risk.forecast_level(scaled), risk.combined_score(scaled, factor)))
    assert got == (multiplier, adjusted, level, score)


def test_adjusted_table(rows_of, spark):
    table = features.training_table(history(rows_of, cities=("Los Angeles",), days=40), weather(rows_of), AS_OF)
    predicted = spark.createDataFrame(
        [('"Los Angeles"', dt.datetime(2024, 2, 1), 10.0, 8.0, 12.0)],
        "series string, ts timestamp_ntz, forecast double, lower_bound double, upper_bound double")
    now = current(rows_of, dict(record_id="1", city="Los Angeles", timestamp_str="2024-01-31 12:00:00",
                                temperature_f=20.0, wind_speed_mph=30.0))
    flow = rows_of(schemas.TRAFFIC_FLOW_RAW, dict(flow_id="f", city="Los Angeles", timestamp="2024-01-31 12:00:00",
                                                  current_speed=10.0, free_flow_speed=50.0))
    final = forecast.adjusted_forecast(table, predicted, now, flow, AS_OF)
    actual = final.where("data_type = 'ACTUAL'")
    assert actual.count() == 30 and actual.agg(F.min("date")).first()[0] == dt.date(2024, 1, 2)
    row = forecast.forecast_rows(final).first()
    assert (row.city, row.forecasted_accident_count, row.lower_bound, row.upper_bound) == (
        "Los Angeles", 14.2, 11.36, 17.04)
    assert row.risk_multiplier == pytest.approx(1.42) and row.current_congestion_pct == pytest.approx(80)
    assessed = forecast.risk_assessment(final).first()
    assert (assessed.risk_level, assessed.temperature_risk, assessed.traffic_risk, assessed.day_of_week,
            assessed.is_weekend, assessed.combined_risk_score) == (
        "LOW", "FREEZING", "SEVERE_CONGESTION", "Thu", False, 35.0)
    report = {r.data_type: r for r in forecast.forecast_report(final).collect()}
    assert report["ACTUAL"].records == 30 and report["ACTUAL"].avg_risk_multiplier is None
    assert report["FORECAST"].cities == 1
    assert "TakeOrderedAndProject" in plan_text(forecast.top_forecasts(final))


def test_rolling_week_spans_gaps(spark):
    rows = [("A", dt.date(2024, 1, d), n) for d, n in ((1, 10), (2, 20), (8, 30), (20, 40))]
    found = trends.rolling_week(spark.createDataFrame(rows, "city string, date date, accident_count long"))
    assert [(r.rolling_7d_accidents, r.days_in_window) for r in found.orderBy("date").collect()] == [
        (10.0, 1), (15.0, 2), (25.0, 2), (40.0, 1)]


def test_constant_measure_has_no_correlation(rows_of):
    table = features.training_table(history(rows_of, days=20), weather(rows_of), AS_OF)
    assert {r.correlation for r in trends.weather_correlation(table).collect()} == {None}


def test_peak_month(spark):
    rows = [("A", dt.date(2024, m, 1), n) for m, n in ((1, 3), (2, 9), (5, 4))]
    found = trends.seasonal_peaks(spark.createDataFrame(rows, "city string, date date, accident_count long"))
    assert [(r.month, r.quarter, r.is_peak_month) for r in found.orderBy("month").collect()] == [
        (1, 1, False), (2, 1, True), (5, 2, False)]
    assert not math.isnan(found.first().accident_count)
