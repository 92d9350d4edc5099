"""Seven-day accident forecast per city (K2, K4) and its live adjustment."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, risk
from ..functions.bands import flag
from ..functions.times import Moment, short_day_name, sunday0, today
from .features import latest_traffic, latest_weather_for_adjustment

MIN_POINTS = 14
Z = 1.96
PENALTY = 1.0
WEEKDAYS = range(7)


def fit_trend(view: DataFrame, as_of: Moment = None, min_points: int = MIN_POINTS) -> DataFrame:
    """One model row per city: least-squares trend over days, plus a mean effect per day of week.

    Everything follows from integer sums, so one aggregate fits all cities at
    once and the result does not depend on the order of rows.  Cities with too
    few points or a single day are skipped.
    """
    x = F.datediff(F.col("date"), today(as_of)).cast("long")
    y = F.col("accident_count").cast("long")
    dow = sunday0(F.col("date"))

    def on(weekday: int, value):
        return F.coalesce(F.sum(F.when(dow == weekday, value)), F.lit(0))

    sums = view.groupBy("city").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"), F.sum(y * y).alias("syy"),
        F.array(*[on(d, F.lit(1).cast("long")) for d in WEEKDAYS]).alias("n_dow"),
        F.array(*[on(d, x) for d in WEEKDAYS]).alias("sx_dow"),
        F.array(*[on(d, y) for d in WEEKDAYS]).alias("sy_dow"))
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = n * F.col("sxx") - sx * sx
    fitted = (sums.where((n >= min_points) & (spread > 0))
              .withColumn("slope", (n * F.col("sxy") - sx * sy).cast("double") / spread)
              .withColumn("intercept", (sy - F.col("slope") * sx) / n))
    slope, intercept = F.col("slope"), F.col("intercept")

    def effect(weekday: int):
        count, sum_x, sum_y = (F.col(name)[weekday] for name in ("n_dow", "sx_dow", "sy_dow"))
        return F.when(count > 0, (sum_y - intercept * count - slope * sum_x) / count).otherwise(F.lit(0.0))

    effects = fitted.withColumn("effects", F.array(*[effect(d) for d in WEEKDAYS]))
    explained = reduce(add, [F.col("n_dow")[d] * F.col("effects")[d] * F.col("effects")[d] for d in WEEKDAYS])
    squares = F.col("syy") - intercept * sy - slope * F.col("sxy") - explained
    return effects.select(
        "city", "n", "slope", "intercept", "effects",
        F.sqrt(F.greatest(squares, F.lit(0.0)) / F.greatest(n - 2, F.lit(1))).alias("sigma"))


def forecast_trend(model: DataFrame, future: DataFrame, as_of: Moment = None, z: float = Z) -> DataFrame:
    """``series, ts, forecast, lower_bound, upper_bound`` for every future row of a fitted city."""
    x = F.datediff(F.col("date"), today(as_of))
    effect = F.get("effects", sunday0(F.col("date")))
    estimate = F.col("intercept") + F.col("slope") * x + effect
    margin = F.col("sigma") * z
    return future.select("city", "date").join(model, "city").select(
        F.col("city").alias("series"), F.col("date").cast("timestamp_ntz").alias("ts"),
        estimate.alias("forecast"), (estimate - margin).alias("lower_bound"), (estimate + margin).alias("upper_bound"))


def skipped_series(view: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """The cities that ``fit_trend`` leaves out, with their days and the reason."""
    days = view.groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("date").alias("_dates"))
    reason = F.when(F.col("n") < min_points, F.lit(f"fewer than {min_points} days")).when(
        F.col("_dates") < 2, F.lit("a single day"))
    return days.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_dates")


def _design() -> list[Column]:
    return [F.lit(1.0), *[F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in fixed.TRAINING_FEATURES]]


def _solved(sums: pd.DataFrame, penalty: float) -> pd.DataFrame:
    """Coefficients and residual spread of each city from its sums; a few hundred numbers per city."""
    size = len(fixed.TRAINING_FEATURES) + 1
    upper = np.triu_indices(size)
    out = []
    for squares, products, yy, n in zip(sums["xx"], sums["xy"], sums["yy"], sums["n"]):
        normal = np.zeros((size, size))
        normal[upper] = squares
        normal += np.triu(normal, 1).T
        beta = np.linalg.solve(normal + penalty * np.diag([0.0] + [1.0] * (size - 1)), products)
        left = max(yy - 2 * beta @ products + beta @ normal @ beta, 0.0)
        out.append((beta.tolist(), float(np.sqrt(left / max(n - size, 1)))))
    return pd.DataFrame(out, columns=["beta", "sigma"])


_SOLUTION = T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType())])


def fit_city_ridge(view: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """One ridge regression per city on the thirteen features: city, n, coefficients (intercept first), spread.

    One grouped aggregate sums up the normal equations of all cities, with a map-side combine, and each city's few
    hundred sums are solved in a vectorized function.  The penalty, which spares the intercept, makes every system
    solvable, so no city is skipped.
    """
    x, y = _design(), F.col("accident_count").cast("double")
    pairs = [x[i] * x[j] for i in range(len(x)) for j in range(i, len(x))]
    sums = view.groupBy("city").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(p) for p in pairs]).alias("xx"),
        F.array(*[F.sum(v * y) for v in x]).alias("xy"), F.sum(y * y).alias("yy"))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        return _solved(rows, penalty)

    solved = F.pandas_udf(solve, _SOLUTION)(F.struct("xx", "xy", "yy", "n"))
    return sums.select("city", "n", solved.alias("s")).select("city", "n", "s.beta", "s.sigma")


def _estimate(beta: str) -> Column:
    return reduce(add, [F.col(beta)[i] * value for i, value in enumerate(_design())])


def forecast_city_ridge(model: DataFrame, future: DataFrame, z: float = Z) -> DataFrame:
    """``series, ts, forecast, lower_bound, upper_bound`` of every future row of a fitted city."""
    margin = F.col("sigma") * z
    return future.join(model, "city").withColumn("forecast", _estimate("beta")).select(
        F.col("city").alias("series"), F.col("date").cast("timestamp_ntz").alias("ts"), "forecast",
        (F.col("forecast") - margin).alias("lower_bound"), (F.col("forecast") + margin).alias("upper_bound"))


def ridge_residuals(view: DataFrame, model: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """Per city the greatest relative gap in the normal equations: residuals times features against the penalty."""
    x, y = _design(), F.col("accident_count").cast("double")
    met = view.join(model, "city").withColumn("_left", y - _estimate("beta"))
    sums = met.groupBy("city").agg(
        F.count(F.lit(1)).alias("n"), F.first("beta").alias("beta"),
        *[F.sum(F.col("_left") * v).alias(f"_r{i}") for i, v in enumerate(x)],
        *[F.sum(F.abs(y * v)).alias(f"_s{i}") for i, v in enumerate(x)])
    gaps = [F.abs(F.col(f"_r{i}") - (F.col("beta")[i] * penalty if i else F.lit(0.0))) / (F.col(f"_s{i}") + 1)
            for i in range(len(x))]
    return sums.select("city", "n", F.greatest(*gaps).alias("gap"))


def _labelled(rows: DataFrame) -> DataFrame:
    """Adds the labels that are encoded.  Spark names a slot by its label and takes no empty name, as a blank city would give."""
    return rows.withColumns({"city_label": F.concat(F.lit("="), "city"), "day_name": short_day_name(F.col("date"))})


def fit_features(view: DataFrame, min_points: int = MIN_POINTS) -> tuple[PipelineModel, float]:
    """One linear model over all cities with the exogenous features; a distributed fit.

    The assembled vector has one slot per city and feature.  Returns the model
    and its residual spread.
    """
    enough = view.groupBy("city").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_points).select("city")
    rows = _labelled(view.join(enough, "city").withColumn("accident_count", F.col("accident_count").cast("double")))
    # A label with a single value carries no information and cannot be one-hot encoded.
    levels = rows.agg(*[F.countDistinct(name).alias(name) for name in ("city_label", "day_name")]).first().asDict()
    labels = [name for name, count in levels.items() if count > 1]
    slots = [f"{name}_slots" for name in labels]
    encode = [
        StringIndexer(inputCols=labels, outputCols=[f"{name}_index" for name in labels], handleInvalid="skip"),
        OneHotEncoder(inputCols=[f"{name}_index" for name in labels], outputCols=slots),
    ] if labels else []
    stages = [
        *encode,
        VectorAssembler(inputCols=[*slots, *fixed.TRAINING_FEATURES], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol="accident_count", predictionCol="forecast", regParam=0.01),
    ]
    model = Pipeline(stages=stages).fit(rows)
    return model, float(model.stages[-1].summary.rootMeanSquaredError)


def forecast_features(model: PipelineModel, spread: float, future: DataFrame, z: float = Z) -> DataFrame:
    scored = model.transform(_labelled(future))
    return scored.select(
        F.col("city").alias("series"), F.col("date").cast("timestamp_ntz").alias("ts"), F.col("forecast"),
        (F.col("forecast") - z * spread).alias("lower_bound"), (F.col("forecast") + z * spread).alias("upper_bound"))


def adjusted_forecast(training: DataFrame, forecast: DataFrame, current: DataFrame, flow: DataFrame,
                      as_of: Moment = None) -> DataFrame:
    """Actuals of the last thirty days and the forecast, scaled by live weather and traffic."""
    number = F.lit(None).cast("double")
    actual = training.where(F.col("date") >= F.date_sub(today(as_of), fixed.ACTUAL_DAYS)).select(
        "city", "date", F.col("accident_count").alias("actual_accident_count"),
        *[number.alias(name) for name in ("forecasted_accident_count", "lower_bound", "upper_bound")],
        F.lit("ACTUAL").alias("data_type"), "avg_temp_f", "total_precipitation_mm", "avg_wind_speed_mph",
        *[number.alias(name) for name in ("current_temp_f", "current_congestion_pct", "risk_multiplier")])

    weather = latest_weather_for_adjustment(current, as_of)
    traffic = latest_traffic(flow, as_of).select("city", F.col("avg_congestion_pct").alias("current_congestion_pct"))
    # One row per city on either side, and seven forecast rows per city.
    series = forecast.withColumn("city", F.replace("series", F.lit('"'), F.lit("")))
    live = series.join(weather, "city", "left").join(traffic, "city", "left").withColumn(
        "risk_multiplier", risk.live_multiplier(
            {name: F.col(name) for name in fixed.RISK_FACTORS}, F.col("current_congestion_pct")))

    def scaled(source: str, name: str):
        return F.round(F.round(F.col(source), 2) * F.col("risk_multiplier"), 2).alias(name)

    predicted = live.select(
        "city", F.to_date("ts").alias("date"), F.lit(None).cast("long").alias("actual_accident_count"),
        scaled("forecast", "forecasted_accident_count"), scaled("lower_bound", "lower_bound"),
        scaled("upper_bound", "upper_bound"), F.lit("FORECAST").alias("data_type"),
        *[number.alias(name) for name in ("avg_temp_f", "total_precipitation_mm", "avg_wind_speed_mph")],
        "current_temp_f", "current_congestion_pct", "risk_multiplier")
    return actual.unionByName(predicted)


def forecast_rows(final: DataFrame) -> DataFrame:
    return final.where(F.col("data_type") == "FORECAST")


def forecast_report(final: DataFrame) -> DataFrame:
    """Rows, cities, dates and mean multiplier per kind of row."""
    return final.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("city").alias("cities"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.avg(F.when(F.col("data_type") == "FORECAST", F.col("risk_multiplier"))).alias("avg_risk_multiplier"))


def top_forecasts(final: DataFrame, rows: int = fixed.REPORT_TOP_ROWS) -> DataFrame:
    return forecast_rows(final).select(
        "city", "date", "forecasted_accident_count", "current_temp_f", "current_congestion_pct", "risk_multiplier",
    ).orderBy(F.col("forecasted_accident_count").desc_nulls_first(), "city", "date").limit(rows)


def risk_assessment(final: DataFrame) -> DataFrame:
    """Risk levels and the combined score of every forecast day."""
    count, temperature = F.col("forecasted_accident_count"), F.col("current_temp_f")
    name = short_day_name(F.col("date"))
    return forecast_rows(final).select(
        "city", "date", "forecasted_accident_count", "lower_bound", "upper_bound", "current_temp_f",
        "current_congestion_pct", "risk_multiplier",
        risk.forecast_level(count).alias("risk_level"),
        risk.temperature_risk(temperature).alias("temperature_risk"),
        risk.traffic_risk(F.col("current_congestion_pct")).alias("traffic_risk"),
        name.alias("day_of_week"), flag(name.isin("Sat", "Sun")).alias("is_weekend"),
        risk.combined_score(count, F.col("risk_multiplier")).alias("combined_risk_score"))


def ordered_assessment(assessment: DataFrame) -> DataFrame:
    return assessment.orderBy(F.col("forecasted_accident_count").desc_nulls_first(), "city", "date")
