"""Text cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def text_or(value: Column, default: str) -> Column:
    """Trimmed text; blank and NULL become ``default``."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))


def is_true_text(value: Column) -> Column:
    """True for any spelling of ``true``; everything else, NULL too, is false."""
    return F.coalesce(F.upper(F.trim(value)) == "TRUE", F.lit(False))


def missing_to_null(value: Column) -> Column:
    """NULL for the texts that stand for a missing CSV value."""
    return F.when(~value.isin(*fixed.MISSING_TEXT), value)


def nan_to_null(value: Column) -> Column:
    """NULL for NaN, because Spark orders NaN above every number."""
    return F.when(~F.isnan(value), value)


def city_key(city: Column, suffix: Column) -> Column:
    """``Los Angeles`` + ``20240131_0100`` -> ``Los_Angeles_20240131_0100``."""
    return F.concat_ws("_", F.replace(city, F.lit(" "), F.lit("_")), suffix)
