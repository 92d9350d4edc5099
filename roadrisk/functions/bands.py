"""Column builders that read the band and code tables of ``fixed``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def below(value: Column, bands: Iterable[tuple]) -> Column:
    """Label of the first band whose bound is greater than ``value``.

    A NULL value is below nothing and takes the last label.
    """
    *bounded, (_, rest) = bands
    out = F
    for bound, label in bounded:
        out = out.when(value < bound, F.lit(label))
    return out.otherwise(F.lit(rest))


def reached(value: Column, bands: Iterable[tuple]) -> Column:
    """Label of the first band whose bound ``value`` reaches; NULL takes the last label."""
    *bounded, (_, rest) = bands
    out = F
    for bound, label in bounded:
        out = out.when(value >= bound, F.lit(label))
    return out.otherwise(F.lit(rest))


def lookup(key: Column, table: Mapping, default) -> Column:
    """Value of a literal map, or ``default`` for an unknown or NULL key."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.create_map(*entries)[key], F.lit(default))


def flag(condition: Column) -> Column:
    """Boolean that is false where the condition is NULL."""
    return F.coalesce(condition, F.lit(False))


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | flag(condition)
    return out
