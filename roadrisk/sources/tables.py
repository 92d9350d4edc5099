"""Layered tables and extract windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.times import Moment, today
from ..operators import sinks

LAYERS = ("raw", "raw_archive", "staging", "analytics", "marts", "ml_predictions")


def table_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; one of {', '.join(LAYERS)}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, root: str, layer: str, table: str, schema: str | None = None) -> DataFrame:
    """A stored table, pinned to its newest version."""
    return sinks.read(spark, table_path(root, layer, table), schema)


def trailing_days(rows: DataFrame, time: str, as_of: Moment = None, days: int = fixed.EXTRACT_DAYS) -> DataFrame:
    """Rows of the last ``days`` days up to today, both ends included.

    Compares the stored time itself, not a function of it, so that the range
    reaches the file scan.
    """
    first = F.date_sub(today(as_of), days).cast("timestamp_ntz")
    after = F.date_add(today(as_of), 1).cast("timestamp_ntz")
    return rows.where((F.col(time) >= first) & (F.col(time) < after))
