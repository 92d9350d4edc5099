"""Risk scores of single accidents and of forecast days."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .bands import indicator, reached


def accident_score(severity: Column, light: Column, hazards: dict[str, Column]) -> Column:
    """Severity, at most 3, plus the weight of every hazard that applies."""
    parts = [F.least(severity, F.lit(fixed.RISK_SEVERITY_CAP))]
    parts += [indicator(hazards[name]) * weight for name, weight in fixed.RISK_WEIGHTS.items()]
    parts.append(indicator(light == fixed.NIGHT) * fixed.RISK_NIGHT_WEIGHT)
    return F.when(severity.isNotNull(), reduce(add, parts))


def accident_category(score: Column) -> Column:
    low, medium, high = fixed.RISK_LABELS
    return (F.when(score <= fixed.LOW_RISK_UP_TO, F.lit(low))
            .when(score <= fixed.MEDIUM_RISK_UP_TO, F.lit(medium))
            .otherwise(F.lit(high)))


def live_multiplier(signals: dict[str, Column], congestion_pct: Column) -> Column:
    parts = [F.lit(1.0)]
    parts += [F.coalesce(signals[name] * weight, F.lit(0.0)) for name, weight in fixed.RISK_FACTORS.items()]
    parts.append(F.when(congestion_pct > fixed.CONGESTION_FACTOR_ABOVE_PCT, F.lit(fixed.CONGESTION_FACTOR))
                 .otherwise(F.lit(0.0)))
    return reduce(add, parts)


def forecast_level(forecast: Column) -> Column:
    return reached(forecast, fixed.FORECAST_RISK)


def temperature_risk(temperature: Column) -> Column:
    return (F.when(temperature < fixed.FREEZING_F, F.lit("FREEZING"))
            .when(temperature > fixed.EXTREME_HEAT_F, F.lit("EXTREME_HEAT"))
            .otherwise(F.lit("NORMAL")))


def traffic_risk(congestion_pct: Column) -> Column:
    return (F.when(congestion_pct > fixed.SEVERE_CONGESTION_PCT, F.lit("SEVERE_CONGESTION"))
            .when(congestion_pct > fixed.MODERATE_CONGESTION_PCT, F.lit("MODERATE_CONGESTION"))
            .otherwise(F.lit("NORMAL_FLOW")))


def combined_score(forecast: Column, multiplier: Column) -> Column:
    """At most 100; stays NULL without a forecast, which ``least`` alone would turn into 100."""
    raw = F.round(forecast / 50.0 * 50 + F.coalesce(multiplier - 1, F.lit(0.0)) * 50, 0)
    return F.when(raw.isNotNull(), F.least(F.lit(100.0), raw))
