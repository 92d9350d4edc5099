"""Traffic rules: speed reduction, congestion, delay, incident severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .bands import lookup, reached


def speed_loss(free_flow: Column, current: Column) -> Column:
    """Share of the free-flow speed that is lost; NULL without a free-flow speed."""
    return F.when(free_flow > 0, (free_flow - current) / free_flow)


def speed_reduction_pct(free_flow: Column, current: Column) -> Column:
    return F.when(free_flow > 0, F.round(speed_loss(free_flow, current) * 100, 2)).otherwise(F.lit(0.0))


def congestion_level(free_flow: Column, current: Column) -> Column:
    """Uses the unrounded ratio, unlike the score, which uses the rounded percentage."""
    return (F.when(free_flow == 0, F.lit(fixed.NO_FREE_FLOW_LEVEL))
            .otherwise(reached(speed_loss(free_flow, current), fixed.CONGESTION_LEVEL)))


def congestion_score(reduction_pct: Column) -> Column:
    return reached(reduction_pct, fixed.CONGESTION_SCORE)


def against_city(score: Column, city_average: Column) -> Column:
    margin = fixed.CITY_CONGESTION_MARGIN
    return (F.when(score >= city_average + margin, F.lit("ABOVE_AVG"))
            .when(score <= city_average - margin, F.lit("BELOW_AVG"))
            .otherwise(F.lit("AVERAGE")))


def incident_severity(magnitude: Column) -> Column:
    return lookup(F.coalesce(magnitude, F.lit(0)), fixed.INCIDENT_SEVERITY, fixed.INCIDENT_SEVERITY_REST)


def delay_minutes(seconds: Column) -> Column:
    return F.coalesce(seconds / 60, F.lit(0.0))
