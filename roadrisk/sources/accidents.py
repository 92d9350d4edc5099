"""Accident CSV files (A1–A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed
from ..functions.text import missing_to_null, nan_to_null
from ..functions.times import Moment, clock
from . import records

_TYPES = dict(column.split() for column in schemas.ACCIDENTS_RAW.split(", "))


def read_csv(spark: SparkSession, path: str | list[str], state: str | None = fixed.TARGET_STATE,
             as_of: Moment = None) -> DataFrame:
    """Raw accidents of one state, with the table's names and types.

    For files without line breaks inside fields, which are then scanned whole on the JVM; ``read_records`` takes any.
    The header gives the positions; every column is read as text, so no type
    is inferred.  The state filter and the 42 columns reach the CSV scan.
    """
    text = spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)
    if state is not None:
        text = text.where(F.col("State") == state)
    return project(text).withColumn("load_timestamp", clock(as_of))


def read_records(spark: SparkSession, path: str | list[str], state: str | None = fixed.TARGET_STATE,
                 as_of: Moment = None) -> DataFrame:
    """As ``read_csv`` for files whose fields may hold line breaks; unfit records are left to ``broken_records``."""
    good = records.parsed(spark, path).where("reason IS NULL")
    if state is not None:
        good = good.where(F.col("State") == state)
    return project(good).withColumn("load_timestamp", clock(as_of))


def broken_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The whole text of every record that ``read_records`` cannot take, of any state, with the reason."""
    return records.parsed(spark, path).where("reason IS NOT NULL").select(records.CORRUPT, "reason")


def project(text: DataFrame) -> DataFrame:
    """Rename the 42 used columns, turn missing-value texts into NULL, cast."""
    out = []
    for header, name in fixed.rows(fixed.ACCIDENT_COLUMNS, header=False):
        value = missing_to_null(F.col(f"`{header}`"))
        kind = _TYPES[name]
        if kind == "double":
            value = nan_to_null(value.try_cast("double"))
        elif kind != "string":
            value = value.try_cast("double").try_cast(kind)
        out.append(value.alias(name))
    return text.select(*out)
