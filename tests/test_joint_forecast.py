import datetime as dt

import numpy as np
import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from roadrisk.plans import features, joint_forecast, trends

TODAY = dt.date(2024, 2, 1)


def series(draw, days, city="a", level=20.0, slope=0.05, spread=3.0, skip=()):
    """City-days with a trend, weekday effects and noise."""
    out = []
    for back in range(days, 0, -1):
        date = TODAY - dt.timedelta(days=back)
        if date.isoweekday() not in skip:
            mean = level - slope * back + 4 * (date.isoweekday() % 3)
            out.append((date, city, max(0, int(round(mean + spread * draw.standard_normal())))))
    return out


def by_hand(rows, target, z=1.96):
    """The least-squares fit with a column per weekday, solved as a whole."""
    x = np.array([(d - TODAY).days for d, _, _ in rows], dtype=float)
    day = np.array([d.isoweekday() % 7 for d, _, _ in rows])
    seen = sorted(set(day))
    design = np.column_stack([x, *[(day == d).astype(float) for d in seen]])
    y = np.array([v for _, _, v in rows], dtype=float)
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    free = len(y) - design.shape[1]
    sigma = np.sqrt(((y - design @ beta) ** 2).sum() / free)
    at = np.array([(target - TODAY).days, *[float(target.isoweekday() % 7 == d) for d in seen]])
    h = at @ np.linalg.inv(design.T @ design) @ at
    t = sum(c / free**k for k, c in enumerate(
        [z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384]))
    return at @ beta, t * sigma * np.sqrt(1 + h)


@pytest.fixture
def view(spark):
    return lambda rows: spark.createDataFrame(rows, "date date, city string, accident_count long")


def test_the_fit_is_that_of_the_whole_system(spark, view):
    draw = np.random.default_rng(1)
    rows = series(draw, 90) + series(draw, 40, "b", skip=(3,)) + series(draw, 13, "c")
    model = joint_forecast.fit_joint(view(rows), AS_OF)
    days = [TODAY + dt.timedelta(days=i) for i in range(7)]
    future = spark.createDataFrame([(c, d) for c in "abc" for d in days], "city string, date date")
    got = {(r.series, r.ts.date()): r for r in joint_forecast.forecast_joint(model, future, AS_OF).collect()}
    assert {c for c, _ in got} == {"a", "b"}  # c has too few days
    for (city, date), r in got.items():
        if city == "b" and date.isoweekday() == 3:
            continue
        want, margin = by_hand([x for x in rows if x[1] == city], date)
        assert (r.forecast, r.upper_bound - r.forecast, r.forecast - r.lower_bound) == pytest.approx((want, margin, margin))
    # A weekday that never was: the mean of all days, and wide bounds all the same.
    wednesday = next(d for d in days if d.isoweekday() == 3)
    assert got["b", wednesday].lower_bound < got["b", wednesday].forecast < got["b", wednesday].upper_bound


def test_failing_series_are_named(view):
    weekly = [(TODAY - dt.timedelta(days=i), "c", 3) for i in range(1, 8)]
    rows = view(series(np.random.default_rng(0), 30) + weekly + [(d, "d", v) for d, _, v in weekly[:1] * 20])
    got = {(r.city, r.n, r.reason) for r in joint_forecast.skipped_joint(rows, AS_OF).collect()}
    assert got == {("c", 7, "fewer than 14 days"), ("d", 20, joint_forecast.NO_SLOPE)}
    assert joint_forecast.skipped_joint(rows, AS_OF, 5).where("city = 'c'").first().reason == joint_forecast.NO_SLOPE
    assert [r.city for r in joint_forecast.fit_joint(rows, AS_OF).collect()] == ["a"]
    assert joint_forecast.fit_joint(rows.where("false"), AS_OF).count() == 0


@pytest.mark.parametrize("freedom, want", [(5, 2.5706), (10, 2.2281), (30, 2.0423), (1000, 1.9623)])
def test_quantile(spark, freedom, want):
    value = spark.range(1).select(joint_forecast.quantile(1.959964, F.lit(freedom))).first()[0]
    assert value == pytest.approx(want, rel=4e-3 if freedom < 10 else 4e-4)


def test_past_origins_equal_a_fit_of_each(spark, view):
    rows = series(np.random.default_rng(3), 45, skip=(7,))
    got = joint_forecast.rolling_origins(view(rows), AS_OF, horizon=3).collect()
    by_date = {d: v for d, _, v in rows}
    assert len(got) == sum(o + dt.timedelta(days=h) in by_date for i, (o, _, _) in enumerate(rows) if i >= 13 for h in (1, 2, 3))
    for r in got[::5]:
        want, margin = by_hand([x for x in rows if x[0] <= r.origin], r.date)
        assert r.date == r.origin + dt.timedelta(days=r.horizon) and r.actual == by_date[r.date]
        assert (r.forecast, r.lower_bound, r.upper_bound) == pytest.approx((want, want - margin, want + margin))
        assert r.covered == (r.lower_bound <= r.actual <= r.upper_bound)


def test_bounds_hold_as_often_as_they_say(view):
    draw = np.random.default_rng(11)
    rows = [r for c in range(12) for r in series(draw, 120, f"c{c}", level=60.0, spread=6.0)]
    for r in joint_forecast.coverage(joint_forecast.rolling_origins(view(rows), AS_OF)).collect():
        assert r.forecasts > 1000 and 0.92 < r.covered_share < 0.98 and r.mean_abs_error < r.mean_width


def test_zero_filled_days(spark, rows_of):
    days = [("2024-01-01", "a", 4), ("2024-01-04", "a", 1), ("2024-01-02", "b", 2)]
    daily = spark.createDataFrame([(dt.date.fromisoformat(d), c, n, 2.0, 0) for d, c, n in days],
                                  "date date, city string, accident_count long, avg_severity double, severe_accident_count long")
    got = {(str(r.date)[-2:], r.city): (r.accident_count, r.avg_severity, r.severe_accident_count)
           for r in features.zero_filled(daily).collect()}
    assert got == {("01", "a"): (4, 2.0, 0), ("02", "a"): (0, None, 0), ("03", "a"): (0, None, 0), ("04", "a"): (1, 2.0, 0),
                   ("02", "b"): (2, 2.0, 0)}
    means = {(str(r.date)[-2:], r.city): r for r in trends.rolling_week(features.zero_filled(daily)).collect()}
    assert means["04", "a"].rolling_7d_accidents == 1.25 and means["04", "a"].days_in_window == 4
    assert features.zero_filled(daily.where("false")).count() == 0


def test_partial_correlations(spark):
    draw = np.random.default_rng(5)
    base = draw.standard_normal((400, 4))
    base[:, 1] += base[:, 0]
    y = 2 * base[:, 0] + draw.standard_normal(400)
    rows = [("g", *map(float, (v, *row))) for v, row in zip(y, base)] + [("h", None, 1.0, 2.0, 3.0, 4.0), ("h", 1.0, 1.0, 2.0, 3.0, 4.0)]
    frame = spark.createDataFrame(rows, f"grp string, accident_count double, {', '.join(m + ' double' for m in trends.MEASURES)}")

    def residual(values, others):
        design = np.column_stack([np.ones(len(values)), others])
        return values - design @ np.linalg.lstsq(design, values, rcond=None)[0]

    got = {(r.grp, r.measure): r for r in trends.partial_correlations(frame, by=("grp",)).collect()}
    for i, measure in enumerate(trends.MEASURES):
        others = np.delete(base, i, axis=1)
        want = np.corrcoef(residual(y, others), residual(base[:, i], others))[0, 1]
        assert got["g", measure].partial_correlation == pytest.approx(want) and got["g", measure].city_days == 400
        assert got["h", measure].partial_correlation is None and got["h", measure].city_days == 1
    # The plain correlation takes the second measure for related; with the first one held it is not.
    assert abs(np.corrcoef(y, base[:, 1])[0, 1]) > 0.5 > 0.15 > abs(got["g", trends.MEASURES[1]].partial_correlation)
    flat = frame.where("grp = 'g'").withColumn(trends.MEASURES[3], F.lit(1.0))
    left = {r.measure: r.partial_correlation for r in trends.partial_correlations(flat).collect()}
    assert left[trends.MEASURES[3]] is None and left[trends.MEASURES[0]] > 0.5
    same = frame.where("grp = 'g'").withColumn(trends.MEASURES[3], F.col(trends.MEASURES[2]) * 2)
    assert {r.partial_correlation for r in trends.partial_correlations(same).collect()} == {None}
    assert trends.partial_correlations(frame.where("false")).count() in (0, 4)
