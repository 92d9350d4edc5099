"""Trend and weekdays fitted together per city, with bounds that follow from the fit, and their test on past days (K2, K4).

The model of a city is a common slope over days and a level per weekday.  Taken apart by weekday, its normal equations
need counts and sums only, all of whole numbers, so one aggregate fits all cities and running sums fit every past
origin without a rescan.

A bound is the estimate ± t · sigma · sqrt(1 + h): sigma has the degrees of freedom that slope and levels leave, h is the
leverage of the day, from the inverse of the normal matrix, which here is one division.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import Moment, sunday0, today
from .forecast import MIN_POINTS, WEEKDAYS, Z

HORIZON = 7
NO_SLOPE = "days and weekdays cannot be told apart"


def _points(view: DataFrame, as_of: Moment) -> DataFrame:
    return view.select("city", "date", F.datediff("date", today(as_of)).cast("long").alias("x"),
                       F.col("accident_count").cast("long").alias("y"), sunday0(F.col("date")).alias("dow"))


def _sums(over=None) -> dict[str, Column]:
    """Counts and sums of a city, over a window if there is one."""
    x, y, one = F.col("x"), F.col("y"), F.lit(1).cast("long")

    def total(value: Column) -> Column:
        summed = F.sum(value)
        return F.coalesce(summed if over is None else summed.over(over), F.lit(0).cast("long"))

    def by_day(value: Column) -> Column:
        return F.array(*[total(F.when(F.col("dow") == d, value)) for d in WEEKDAYS])

    return {"n": total(one), "sx": total(x), "sy": total(y), "sxx": total(x * x), "sxy": total(x * y),
            "syy": total(y * y), "n_dow": by_day(one), "sx_dow": by_day(x), "sy_dow": by_day(y)}


def _within(sums: DataFrame) -> DataFrame:
    """Sums of squares and products around the means of the weekdays, and the degrees of freedom."""
    def around(total: str, left: str, right: str) -> Column:
        parts = [F.when(F.col("n_dow")[d] > 0, F.col(left)[d].cast("double") * F.col(right)[d] / F.col("n_dow")[d]).otherwise(0.0)
                 for d in WEEKDAYS]
        return F.col(total) - reduce(add, parts)

    days = reduce(add, [(F.col("n_dow")[d] > 0).cast("int") for d in WEEKDAYS])
    return sums.withColumns({"wxx": around("sxx", "sx_dow", "sx_dow"), "wxy": around("sxy", "sx_dow", "sy_dow"),
                             "wyy": around("syy", "sy_dow", "sy_dow"), "df": F.col("n") - days - 1})


def _solved(sums: DataFrame, min_points: int) -> DataFrame:
    # Two days of a weekday are a week apart at least, so a sum below 1 is that of no two.
    fit = _within(sums).where((F.col("n") >= min_points) & (F.col("wxx") > 1) & (F.col("df") > 0))
    fit = fit.withColumn("slope", F.col("wxy") / F.col("wxx"))
    left = F.greatest(F.col("wyy") - F.col("slope") * F.col("wxy"), F.lit(0.0))
    return fit.withColumn("sigma", F.sqrt(left / F.col("df"))).drop("sxx", "sxy", "syy", "wxy", "wyy")


def fit_joint(view: DataFrame, as_of: Moment = None, min_points: int = MIN_POINTS) -> DataFrame:
    """One row per city: slope, sums of its weekdays, spread and degrees of freedom.

    Cities with too few days, or with no weekday twice, are left out; ``skipped_joint`` names them.
    """
    sums = _sums()
    return _solved(_points(view, as_of).groupBy("city").agg(*[value.alias(name) for name, value in sums.items()]), min_points)


def skipped_joint(view: DataFrame, as_of: Moment = None, min_points: int = MIN_POINTS) -> DataFrame:
    """The cities that ``fit_joint`` leaves out, with their days and the reason."""
    sums = _points(view, as_of).groupBy("city").agg(*[value.alias(name) for name, value in _sums().items()])
    reason = F.when(F.col("n") < min_points, f"fewer than {min_points} days").when(F.col("wxx") <= 1, NO_SLOPE)
    return _within(sums).select("city", "n", reason.alias("reason")).where("reason IS NOT NULL")


def quantile(z: float, freedom: Column) -> Column:
    """The quantile of Student's t that belongs to ``z`` of the normal curve, by its series in 1 / degrees of freedom."""
    terms = (z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384)
    return reduce(add, [F.lit(term) / F.pow(freedom.cast("double"), F.lit(power)) for power, term in enumerate(terms)])


def _bounds(x: Column, dow: Column, z: float) -> dict[str, Column]:
    """Estimate and bounds at a day; a weekday that the city never had takes the mean of all days."""
    seen = F.get("n_dow", dow) > 0
    count = F.when(seen, F.get("n_dow", dow)).otherwise(F.col("n")).cast("double")
    mean_x = F.when(seen, F.get("sx_dow", dow)).otherwise(F.col("sx")) / count
    mean_y = F.when(seen, F.get("sy_dow", dow)).otherwise(F.col("sy")) / count
    away = x - mean_x
    estimate = mean_y + F.col("slope") * away
    margin = quantile(z, F.col("df")) * F.col("sigma") * F.sqrt(1 + 1 / count + away * away / F.col("wxx"))
    return {"forecast": estimate, "lower_bound": estimate - margin, "upper_bound": estimate + margin}


def forecast_joint(model: DataFrame, future: DataFrame, as_of: Moment = None, z: float = Z) -> DataFrame:
    """``series, ts, forecast, lower_bound, upper_bound`` for every future row of a fitted city."""
    bounds = _bounds(F.datediff("date", today(as_of)), sunday0(F.col("date")), z)
    return future.select("city", "date").join(model, "city").select(
        F.col("city").alias("series"), F.col("date").cast("timestamp_ntz").alias("ts"),
        *[value.alias(name) for name, value in bounds.items()])


def rolling_origins(view: DataFrame, as_of: Moment = None, horizon: int = HORIZON, min_points: int = MIN_POINTS,
                    z: float = Z) -> DataFrame:
    """What the model would have said on every past day: city, origin, horizon, date, actual, forecast, bounds, covered.

    The model of an origin knows the days up to it.  Its sums are running sums over the city's days, at most one row per
    day of history, so all origins cost one sort of the days and a join of each with the days it looks at.
    """
    points = _points(view, as_of)
    upto = Window.partitionBy("city").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    origins = points.select("city", F.col("date").alias("origin"), F.col("x").alias("from"),
                            *[value.alias(name) for name, value in _sums(upto).items()])
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon")
    asked = _solved(origins, min_points).select("*", ahead).withColumn("x", F.col("from") + F.col("horizon"))
    met = asked.join(points.select("city", "x", "date", "dow", F.col("y").alias("actual")), ["city", "x"])
    rows = met.withColumns(_bounds(F.col("x"), F.col("dow"), z))
    return rows.select("city", "origin", "horizon", "date", "actual", "forecast", "lower_bound", "upper_bound",
                       # Up to rounding, as a series without spread has bounds of no width.
                       F.col("actual").between(F.col("lower_bound") - 1e-9, F.col("upper_bound") + 1e-9).alias("covered"))


def coverage(rolled: DataFrame) -> DataFrame:
    """Per days ahead: forecasts made, the share inside their bounds, the mean error and the mean width of the bounds."""
    return rolled.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("forecasts"), F.avg(F.col("covered").cast("int")).alias("covered_share"),
        F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("mean_abs_error"),
        F.avg(F.col("upper_bound") - F.col("lower_bound")).alias("mean_width"))
