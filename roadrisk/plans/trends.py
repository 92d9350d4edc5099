"""Rolling means, correlation, heat map and seasonal peaks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed


def rolling_week(daily: DataFrame) -> DataFrame:
    """Mean over the seven calendar days up to each day.

    The input has one row per city and day, so a window partition is no longer
    than the days of history, however many accidents there are.
    """
    day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
    week = Window.partitionBy("city").orderBy(day).rangeBetween(-6, 0)
    return daily.select(
        "city", "date", "accident_count", F.avg("accident_count").over(week).alias("rolling_7d_accidents"),
        F.count(F.lit(1)).over(week).alias("days_in_window"))


def weather_correlation(training: DataFrame) -> DataFrame:
    """Pearson correlation of the daily accident count with each weather measure, one row per measure."""
    target = F.col("accident_count").cast("double")

    def pearson(name: str):
        # Not F.corr, which raises under ANSI when a measure never changes.
        return F.try_divide(F.covar_pop(target, F.col(name)), F.stddev_pop(target) * F.stddev_pop(name))

    wide = training.agg(F.count(F.lit(1)).alias("city_days"), *[pearson(name).alias(name) for name in MEASURES])
    return wide.unpivot(["city_days"], list(MEASURES), "measure", "correlation")


MEASURES = ("avg_temp_f", "avg_humidity_pct", "avg_wind_speed_mph", "total_precipitation_mm")
# Matrices of correlations closer to singular than this have no partial correlations.
SINGULAR = 1e12


def _partial(covariances: pd.Series, measures: int) -> pd.Series:
    """The partial correlation of the first variable with each other one, from the upper halves of covariance matrices."""
    size = measures + 1
    upper = np.triu_indices(size)
    out = []
    for values in covariances:
        matrix = np.zeros((size, size))
        matrix[upper] = [np.nan if v is None else v for v in values]
        matrix += np.triu(matrix, 1).T
        spread = np.sqrt(np.diag(matrix))
        # A measure that never changes explains nothing and has no correlation.
        moving = np.flatnonzero(spread > 0)
        found: list[float | None] = [None] * measures
        if len(moving) and moving[0] == 0 and np.isfinite(matrix).all():
            scaled = (matrix / np.outer(np.where(spread > 0, spread, 1), np.where(spread > 0, spread, 1)))[np.ix_(moving, moving)]
            if np.linalg.cond(scaled) < SINGULAR:
                inverse = np.linalg.inv(scaled)
                for place, variable in enumerate(moving[1:], 1):
                    found[variable - 1] = float(-inverse[0, place] / np.sqrt(inverse[0, 0] * inverse[place, place]))
        out.append(found)
    return pd.Series(out)


def partial_correlations(training: DataFrame, measures: tuple[str, ...] = MEASURES, target: str = "accident_count",
                         by: tuple[str, ...] = ()) -> DataFrame:
    """Correlation of the daily count with each measure while the other measures are held, per group of ``by``.

    One aggregate makes the covariance matrix of all variables, with partial sums before the shuffle; the partial
    correlations come from its inverse, a few numbers per group.  Rows with a missing variable are left out.  A measure that never
    changes gets NULL and is not held; if the measures determine each other, all get NULL.
    """
    names = (target, *measures)
    known = training.dropna(subset=list(names)).select(*by, *[F.col(name).cast("double").alias(name) for name in names])
    pairs = [F.covar_pop(names[i], names[j]) for i in range(len(names)) for j in range(i, len(names))]
    sums = known.groupBy(*by).agg(F.count(F.lit(1)).alias("city_days"), F.array(*pairs).alias("covariances"))
    count = len(measures)

    def partial(covariances: pd.Series) -> pd.Series:
        return _partial(covariances, count)

    solved = sums.withColumn("partial", F.pandas_udf(partial, "array<double>")("covariances"))
    return solved.select(*by, "city_days", F.posexplode("partial").alias("place", "partial_correlation")).select(
        *by, F.get(F.array(*[F.lit(m) for m in measures]), F.col("place")).alias("measure"), "city_days", "partial_correlation")


def heat_map(correlation: DataFrame, temperature_step: int = 10, wind_step: int = 5) -> DataFrame:
    """Accidents per cell of a temperature × wind grid."""
    def cell(name: str, step: int):
        return (F.floor(F.col(name) / step) * step).cast("int")

    return correlation.groupBy(
        cell("temperature_f", temperature_step).alias("temperature_from"),
        cell("wind_speed_mph", wind_step).alias("wind_from"),
    ).agg(F.count(F.lit(1)).alias("accident_count"), F.avg("severity").alias("avg_severity"),
          F.sum(F.when(F.col("severity") >= fixed.SERIOUS_FROM, 1).otherwise(0)).alias("severe_accident_count"))


def seasonal_peaks(daily: DataFrame) -> DataFrame:
    """Accidents per city, quarter and month, and whether the month is the city's peak.

    At most twelve rows per city reach the window.
    """
    months = daily.groupBy("city", F.quarter("date").alias("quarter"), F.month("date").alias("month")).agg(
        F.sum("accident_count").alias("accident_count"), F.max("accident_count").alias("busiest_day_count"))
    top = F.max("accident_count").over(Window.partitionBy("city"))
    return months.withColumn("is_peak_month", F.col("accident_count") == top)
